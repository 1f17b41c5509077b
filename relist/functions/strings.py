from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters trimmed at both ends (U+0000..U+0020), the age pattern.
CONTROL_AND_SPACE = "".join(chr(c) for c in range(0x21))
AGE_PATTERN = r"^(\d+)\s*(second|minute|hour|day|week|month)s?\s*ago\z"


def trim_java(c: Column) -> Column:
    """Trim every character up to U+0020 from both ends; plain trim() drops blanks only."""
    return F.btrim(c, F.lit(CONTROL_AND_SPACE))


def strip_prefix(c: Column, prefix: str) -> Column:
    """Drop one leading literal where present."""
    return F.when(F.startswith(c, F.lit(prefix)), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def lower(c: Column) -> Column:
    return F.lower(c)


def regex_capture(c: Column, pattern: str, group: int) -> Column:
    """Captured group of a match, null (not '') where the pattern does not match."""
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, group))


def build_url(base: str | Column, *parts: str | Column) -> Column:
    """Concatenate literals and columns; null in, null out."""
    as_col = [p if isinstance(p, Column) else F.lit(p) for p in (base, *parts)]
    return F.concat(*as_col)


def parse_int(c: Column) -> Column:
    """Digits to int; overflow gives null so that only the one record is affected."""
    return c.try_cast("int")


def hex_id(*keys: Column) -> Column:
    """Deterministic 24-hex id: the same on replay and on task retry."""
    return F.substring(F.sha2(F.concat_ws("\u0001", *[k.cast("string") for k in keys]), 256), 1, 24)
