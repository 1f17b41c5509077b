from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relist.functions.dates import parse_bound, ts_to_epoch_ms
from relist.functions.strings import hex_id
from relist.schemas import RAW_PAGE, SOURCES

# The stored table carries the capture date as a second partition column.
RAW_PAGE_TABLE = T.StructType([*RAW_PAGE.fields, T.StructField("capture_date", T.DateType())])


def select_sources(df: DataFrame, sources: Sequence[str] = ()) -> DataFrame:
    """Keep the listed sources; an empty list keeps all."""
    return df.where(F.col("source").isin(*sources)) if sources else df


def page_range(df: DataFrame, start_page: int = 1, end_page: int | None = None) -> DataFrame:
    """Inclusive page range. The start page is kept even where end_page lies before it."""
    page = F.col("page")
    kept = page >= start_page
    if end_page is not None:
        kept = kept & ((page == start_page) | (page <= end_page))
    return df.where(kept)


def capture_time_range(df: DataFrame, start_ts: str | None = None, end_ts: str | None = None,
                       column: str = "captured_at") -> DataFrame:
    """Closed range on capture time; each end is optional, a malformed bound raises.

    Where the table is partitioned by capture_date the range prunes partitions too.
    """
    start, end = parse_bound(start_ts), parse_bound(end_ts)
    dated = "capture_date" in df.columns
    for bound, op in ((start, "__ge__"), (end, "__le__")):
        if bound is None:
            continue
        df = df.where(getattr(F.col(column), op)(bound))
        if dated:
            df = df.where(getattr(F.col("capture_date"), op)(F.to_date(bound)))
    return df


def read_raw_pages(spark: SparkSession, path: str, schema: T.StructType = RAW_PAGE_TABLE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_raw_pages(pages: DataFrame, source: str, start_ts: str | None = None,
                   end_ts: str | None = None) -> DataFrame:
    """Landed pages of one source within an optional capture-time range, all rows, no order."""
    return capture_time_range(pages.where(F.col("source") == source), start_ts, end_ts)


def _land(pages: DataFrame, source: str | Column, captured_at: Column | None) -> DataFrame:
    name = source if isinstance(source, Column) else F.lit(source)
    captured = F.col("captured_at") if captured_at is None else captured_at
    return (
        pages.withColumn("source", name)
        .withColumn("captured_at", F.date_trunc("millisecond", captured))
        .withColumn("raw_page_id", hex_id(F.col("source"), F.col("page"), ts_to_epoch_ms(F.col("captured_at"))))
    )


def land_html_list_page(pages: DataFrame, source: str | Column, captured_at: Column | None = None) -> DataFrame:
    """Give each (page, content) row the id, source and capture time of a landed HTML page."""
    return _land(pages, source, captured_at).select(
        "raw_page_id", F.col("page").cast("int").alias("page"), "source", "content", "captured_at")


def land_json_list_page(pages: DataFrame, source: str | Column, captured_at: Column | None = None) -> DataFrame:
    """Same for JSON responses. Pages count from 1 here and from 0 inside the payload."""
    return _land(pages, source, captured_at).select(
        "raw_page_id", F.col("page").cast("int").alias("page"), "source", "content", "captured_at",
        (F.col("page") - 1).cast("int").alias("payload_page"))


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files, one page each; the page number is the last number in the file name."""
    files = spark.read.text(path, wholetext=True).select("*", "_metadata.file_path", "_metadata.file_modification_time")
    return files.select(
        F.regexp_extract("file_path", r"(\d+)\D*\z", 1).try_cast("int").alias("page"),
        F.col("value").alias("content"),
        F.col("file_modification_time").alias("captured_at"),
    )


def stream_raw_pages(spark: SparkSession, path: str, files_per_batch: int = 1000,
                     schema: T.StructType = RAW_PAGE, glob: str | None = None) -> DataFrame:
    """Landed pages as a stream; files_per_batch paces how much one micro-batch takes."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_paced_pages(spark: SparkSession, path: str, paces: Mapping[str, int],
                       schema: T.StructType = RAW_PAGE) -> DataFrame:
    """Landed pages of several sources as one stream in which each source has a pace of its own.

    `path` holds a folder `source=<name>` per source, as a write partitioned by source leaves it; `paces` names the
    sources and the files a micro-batch takes of each. Every batch takes from all of them, so a source with a backlog
    does not hold up the others, and a source whose folder is not there yet is waited for. Folders of sources
    without a pace are not read.
    """
    if not paces or min(paces.values()) < 1:
        raise ValueError("paces needs a source, and at least one file a batch for each")
    names = schema.fieldNames()
    rest = T.StructType([f for f in schema.fields if f.name != "source"])

    def one(name: str, files: int) -> DataFrame:
        # The last letter as a class: a pattern may match nothing yet, a plain path must exist.
        folder = f"{path}/source={name[:-1]}[{name[-1]}]"
        pages = spark.readStream.schema(rest).option("maxFilesPerTrigger", files).parquet(folder)
        return pages.withColumn("source", F.lit(name)).select(*names)

    return reduce(DataFrame.unionByName, [one(name, files) for name, files in paces.items()])


def check_source_domain(df: DataFrame, domain: Sequence[str] = SOURCES) -> DataFrame:
    """Fail the query on a source outside the domain."""
    known = F.col("source").isin(*domain)
    message = F.concat(F.lit("Unknown source: "), F.coalesce(F.col("source"), F.lit("null")))
    return df.withColumn("source", F.when(known, F.col("source")).otherwise(F.raise_error(message)))


def unknown_sources(df: DataFrame, domain: Sequence[str] = SOURCES) -> DataFrame:
    """The rows check_source_domain would fail on, for quarantine."""
    return df.where(~F.coalesce(F.col("source").isin(*domain), F.lit(False)))
