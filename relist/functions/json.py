"""Strictly typed reads of parsed JSON (VARIANT).

A plain variant_get coerces numbers to strings; here a value of another type counts as
missing, and a set with one element of another type is missing as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.strings import regex_capture


def json_list(text: Column) -> Column:
    """Text parsed as the only element of a list.

    The parser stops after the first complete value. Inside a list, anything left over
    breaks the list or makes a second element, see is_single.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def is_single(v: Column) -> Column:
    return json_path(v, "$[0]").isNotNull() & json_path(v, "$[1]").isNull()


def json_parse(text: Column) -> Column:
    """Text as one JSON value, null where it is not exactly one."""
    return F.when(is_single(json_list(text)), json_path(json_list(text), "$[0]"))


def json_path(v: Column, path: str, type_name: str = "variant") -> Column:
    return F.try_variant_get(v, path, type_name)


def _type_of(v: Column, path: str) -> Column:
    return F.schema_of_variant(json_path(v, path))


def json_string(v: Column, path: str) -> Column:
    return F.when(_type_of(v, path) == "STRING", json_path(v, path, "string"))


def json_long(v: Column, path: str) -> Column:
    """Whole numbers, also written as 5.0 or as text; anything else is missing."""
    kind = _type_of(v, path)
    text = json_path(v, path, "string")
    digits = regex_capture(text, r"^(-?\d+)(?:\.0*)?\z", 1)
    exponent = json_path(v, path, "double")
    return (
        F.when(kind == "BIGINT", json_path(v, path, "bigint"))  # read as it is; patterns are for the other forms
        .when((kind == "STRING") | F.startswith(kind, F.lit("DECIMAL")), digits.try_cast("bigint"))
        .when((kind == "DOUBLE") & (exponent == F.floor(exponent)), exponent.try_cast("bigint"))
    )


def json_string_set(v: Column, path: str) -> Column:
    kind = _type_of(v, path)
    items = json_path(v, path, "array<string>")
    ok = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(items, lambda x: x.isNull())
    return F.when(ok, F.array_distinct(items))


def json_object_encode(fields: Sequence[Column]) -> Column:
    """One compact JSON object per row, keys in the given order; empty arrays are kept."""
    return F.to_json(F.struct(*fields))
