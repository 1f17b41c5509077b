from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relist.schemas import KEYS, TABLES


def _typed(df: DataFrame, field: T.StructField) -> Column:
    value = F.col(field.name).try_cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
    if field.name == "other_posting_dates":
        value = F.coalesce(value, F.array().cast(field.dataType))
    return value


def violations(df: DataFrame, schema: T.StructType) -> Column:
    """Names of the required fields that are absent or of the wrong type."""
    missing = [F.when(_typed(df, f).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    return F.filter(F.array(*missing), lambda x: x.isNotNull()) if missing else F.array().cast("array<string>")


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring rows to a table schema; one bad required field fails the read.

    Optional fields become null, other_posting_dates becomes empty, unknown fields go.
    """
    bad = violations(df, schema)
    checked = df.where(
        F.when(F.size(bad) == 0, F.lit(True))
        .otherwise(F.raise_error(F.concat(F.lit("Missing or mistyped fields: "), F.array_join(bad, ", "))).cast("boolean")))
    return checked.select(*[_typed(df, f).alias(f.name) for f in schema.fields])


def split_conforming(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The lenient form: conforming rows, and the others with the list of bad fields."""
    marked = df.withColumn("violations", violations(df, schema))
    good = marked.where(F.size("violations") == 0).select(*[_typed(df, f).alias(f.name) for f in schema.fields])
    return good, marked.where(F.size("violations") > 0)


def scan_postings(spark: SparkSession, path: str, schema: T.StructType = TABLES["postings"]) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


#: So many keys at most are read to the driver and written into a scan as values, and so many in one IN list: Spark hands
#: longer lists to Parquet as a range only.
FEW_KEYS, LISTED = 1000, 10


def key_values(keys: DataFrame) -> list[tuple[str | None, str]] | None:
    """The (source, url) pairs of `keys` if it has at most FEW_KEYS rows, else None. No more rows than that are read."""
    rows = keys.select(*KEYS).limit(FEW_KEYS + 1).collect()
    return sorted({tuple(r) for r in rows if None not in r}) if len(rows) <= FEW_KEYS else None


def of_keys(df: DataFrame, values: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of these keys; the urls are tested against the statistics and Bloom filters of the files."""
    urls, sources = sorted({u for _, u in values}), sorted({s for s, _ in values})
    parts = [F.col("url").isin(*urls[k:k + LISTED]) for k in range(0, len(urls), LISTED)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1:]
    return df.where(F.col("source").isin(*sources) & parts[0]) if parts else df.where("false")


def lookup_postings_by_key(postings: DataFrame, source: str, urls: DataFrame) -> DataFrame:
    """Postings of one source whose url is among `urls`.

    A short key list reaches the scan as values, so that files and row groups without them are passed over. Otherwise a
    plain semi join: a key list is broadcast by its measured size, a large one is shuffled.
    """
    ours = postings.where(F.col("source") == source)
    values = key_values(urls.select(F.lit(source).alias("source"), "url"))
    return of_keys(ours, values) if values is not None else ours.join(urls.select("url"), "url", "left_semi")


def lookup_postings_project(postings: DataFrame, source: str, urls: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The same lookup, id and the requested columns only."""
    return lookup_postings_by_key(postings, source, urls).select("posting_id", *fields)


def latest_postings(postings: DataFrame) -> DataFrame:
    """The latest posting of every key, by posting date.

    The rank limit is applied before the shuffle as well, so a key with many
    postings sends one row per input partition.
    """
    return dedupe_last_by_key(postings, KEYS, ["posting_date", "posting_id"])


def dedupe_last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in the given total order."""
    latest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(latest_first)).where(F.col("_rank") == 1).drop("_rank")


def distinct_urls(batch: DataFrame) -> DataFrame:
    return batch.select("url").distinct()


def restore_snapshot(spark: SparkSession, root: str, date: str, table: str,
                     schema: T.StructType | None = None) -> DataFrame:
    """One table of a dated export, as its readers see it; tables without a schema of their own keep that of the copy."""
    reader = spark.read.schema(schema or TABLES[table]) if schema or table in TABLES else spark.read
    return reader.parquet(f"{root}/{date}/{table}")
