from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relist import schemas as S
from relist.functions.arrays import array_all_empty
from relist.functions.strings import hex_id
from relist.sources.tables import lookup_postings_by_key


def required_fields(checks: Sequence[tuple[Column, Column | str]]) -> Column:
    """Ordered list of the messages whose condition holds."""
    messages = [F.when(bad, F.lit(m) if isinstance(m, str) else m) for bad, m in checks]
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def required_fields_check(extracted: DataFrame, reject_blank: bool = False) -> DataFrame:
    """Add `errors`: which required fields are missing, in a fixed order.

    Arrays also count as missing when empty; empty strings pass unless reject_blank. A
    page-level error replaces the field checks. The raw fragment is kept for rows with
    errors only, as evidence.
    """
    checks = []
    for name, message in S.REQUIRED_FIELDS:
        column = F.col(name)
        is_array = isinstance(extracted.schema[name].dataType, T.ArrayType)
        bad = array_all_empty(column) if is_array else column.isNull()
        if reject_blank and isinstance(extracted.schema[name].dataType, T.StringType):
            bad = bad | (column == "")
        checks.append((bad, message))
    fields = required_fields(checks)
    checked = extracted.withColumn(
        "errors", F.when(F.col("page_error").isNotNull(), F.array("page_error")).otherwise(fields))
    return checked.withColumn("raw_fragment", F.when(F.size("errors") > 0, F.col("raw_fragment")))


def route_valid(checked: DataFrame) -> DataFrame:
    """Listings without errors, as sightings to reconcile."""
    return checked.where(F.size("errors") == 0).select(
        "source", "url", "title", "tags", "posting_date", "company", "locations",
        "raw_page_id", "captured_at", "page", "ordinal")


def route_errors(checked: DataFrame) -> DataFrame:
    """Listings with errors: raw fragment, messages and page."""
    return checked.where(F.size("errors") > 0).select(
        hex_id(F.col("raw_page_id"), F.col("ordinal"), F.lit("error")).alias("error_id"),
        "raw_fragment", "errors", "raw_page_id")


def partition_split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds, and all others (a null counts as not holding)."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.where(holds), df.where(~holds)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail on the first duplicate key."""
    found = duplicate_keys(df, keys).head(1)
    if found:
        raise ValueError(f"duplicate key {found[0].asDict()}")


def bounded_lookup(postings: DataFrame, source: str, urls: DataFrame) -> DataFrame:
    """Postings of one source whose url is among `urls`, at most one for each.

    The bound is checked, not cut: a key with several postings fails the read, as dropping one of them would hide that the
    table is not unique.
    """
    found = lookup_postings_by_key(postings, source, urls)
    times = F.count(F.lit(1)).over(Window.partitionBy(*S.KEYS))
    several = F.raise_error(F.concat(F.lit("Several postings of one key: "), F.coalesce("url", F.lit("null")))).cast("boolean")
    return found.withColumn("_times", times).where(F.when(F.col("_times") == 1, F.lit(True)).otherwise(several)).drop("_times")
