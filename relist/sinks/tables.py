"""Stored tables as parquet folders that the commit log names.

Every batch writes folders of its own and reads only earlier batches; a batch that is run again replaces its own rows
and nothing else. What a batch writes in one phase appears in all tables at once, see sinks.commits. The postings
table is read as the latest version of each posting; compaction folds the batches so far into a base.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relist import schemas as S
from relist.operators.reconcile import upsert_postings
from relist.sinks import commits
from relist.sinks.commits import Batch, Folder, Log, Part, read_log
from relist.sources.tables import dedupe_last_by_key, key_values, of_keys

#: The column that tells the files of the postings apart; source has few values.
POSTING_KEY = ("url",)
BATCH = T.StructField("batch_id", T.LongType())
# Postings as stored: the list of other dates lives in its own table, one row per date,
# so that a posting seen very often never becomes one huge row.
POSTING_ROW = T.StructType([f for f in S.POSTING.fields if f.name != "other_posting_dates"])
POSTING_DATE_ROW = T.StructType([
    T.StructField("posting_id", T.StringType()), T.StructField("posting_date", T.TimestampType()),
    T.StructField("captured_at", T.TimestampType()), T.StructField("page", T.IntegerType()),
    T.StructField("ordinal", T.IntegerType()),
])
# A change as committed with its batch: the message, where it arrived, and whether it opened its posting.
CHANGE_ROW = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("captured_at", T.TimestampType()), T.StructField("page", T.IntegerType()), T.StructField("ordinal", T.IntegerType()),
    T.StructField("source", T.StringType()), T.StructField("url", T.StringType()), T.StructField("opened", T.BooleanType()),
])
# A message as handed on. The commit of its batch and its arrival there put the messages of a key in order.
MESSAGE_ROW = T.StructType([*CHANGE_ROW.fields[:5], T.StructField("commit_number", T.LongType())])
BACKLOG_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("posting_id", "source", "url")])
STORED = {
    **S.TABLES, "postings": POSTING_ROW, "posting_dates": POSTING_DATE_ROW, "published": MESSAGE_ROW, "changes": CHANGE_ROW,
    "run_page_events": S.RUN_PAGE, "page_runs": S.PAGE_RUN, "run_stops": S.RUN_STOP, "quarantined_pages": S.RAW_PAGE,
    "details_backlog": BACKLOG_ROW,
}
# The phases of a batch. Pages are landed before any work on them; all that comes of the work is saved together.
LANDED, SAVED, DETAILED, PUBLISHED, BASE = "landed", "saved", "detailed", "published", "base"
PHASE_OF = {"raw_pages": LANDED, "quarantined_pages": LANDED, "posting_details": DETAILED, "details_backlog": DETAILED, "published": PUBLISHED}


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_batch(df: DataFrame, root: str, table: str, batch_id: int, partition_by: Sequence[str] = (), phase: str | None = None) -> None:
    """Write and commit one table of a batch. Running the batch again replaces its rows of that phase."""
    batch = Batch(df.sparkSession, root, batch_id, phase or PHASE_OF.get(table, SAVED))
    batch.write(df, table, partition_by, POSTING_KEY if table == "postings" else ())
    batch.commit()


def read_table(spark: SparkSession, root: str, table: str, before: int | None = None, after: int | None = None, log: Log | None = None) -> DataFrame:
    """Committed rows of the batches in (after, before), with their batch_id; `log` fixes the moment."""
    schema = T.StructType([*STORED[table].fields, BATCH])
    folders = (log or read_log(spark, root)).folders(table, before, after)
    if not folders:
        # The filter tells the optimizer that there are no rows: joins with a table that is not there yet are left out of the plan.
        return spark.createDataFrame([], schema).where(F.lit(False))
    if table == "raw_pages":
        schema = T.StructType([*schema.fields, T.StructField("capture_date", T.DateType())])
    reader = spark.read.schema(schema).option("basePath", f"{root}/{table}")
    paths = [f"{root}/{table}/{f}" for f in folders]
    return (reader.json(paths) if table == "published" else reader.parquet(*paths)).drop("commit")


RAW_LAYOUT = ("source", "capture_date")


def raw_layout(pages: DataFrame) -> DataFrame:
    """Raw pages with the columns of their layout."""
    return pages.select(*[f.name for f in S.RAW_PAGE.fields]).withColumn("capture_date", F.to_date("captured_at"))


def append_raw_page(pages: DataFrame, root: str, batch_id: int) -> None:
    """Land pages, laid out by source and capture date."""
    write_batch(raw_layout(pages), root, "raw_pages", batch_id, RAW_LAYOUT)


def append_errors(errors: DataFrame, root: str, batch_id: int) -> None:
    write_batch(errors, root, "extract_errors", batch_id)


def append_details(details: DataFrame, root: str, batch_id: int) -> None:
    write_batch(details, root, "posting_details", batch_id)


def append_run_pages(events: DataFrame, root: str, batch_id: int, closing: bool = False) -> None:
    write_batch(events, root, "run_page_events", batch_id, phase=SAVED if closing else LANDED)


def prune_layout(df: DataFrame, keys: Sequence[str] = tuple(S.KEYS)) -> DataFrame:
    """Order rows for storage so that file statistics prune by source and url.

    Ranges split a source that holds much of the table; a hash of it would not.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def committed_bases(spark: SparkSession, root: str, log: Log | None = None) -> list[tuple[int, str]]:
    """(upto, folder name) of the bases that count, oldest first.

    A base in which a batch is not what it is now, as it was saved or run again after the base was made, does not count.
    """
    log = log or read_log(spark, root)
    found = []
    for e in log.entries("postings_base"):
        later = [p for p in log.entries("postings", before=e.part.batch_id + 1) if p.number > e.part.upto]
        found += [(e.part.batch_id, f) for f in e.part.tables["postings_base"] if not later]
    return sorted(found)


def current_postings(spark: SparkSession, root: str, before: int | None = None, log: Log | None = None, keys: DataFrame | None = None) -> DataFrame:
    """The postings table as of the batches before `before`; `log` fixes the moment.

    The base is only filtered against the ids changed since; it is not regrouped. If `keys` (source, url) are few, only
    their postings are read: their values reach the scans, which pass over files and row groups without them.
    """
    values = key_values(keys) if keys is not None else None
    few = (lambda df: of_keys(df, values)) if values is not None else (lambda df: df)
    log = log or read_log(spark, root)
    names = [f.name for f in POSTING_ROW.fields]
    bases = [b for b in committed_bases(spark, root, log) if before is None or b[0] < before]
    # All versions of a posting have its key, so they can be left out before the latest is taken.
    rows = few(read_table(spark, root, "postings", before=before, after=bases[-1][0] if bases else None, log=log))
    latest = dedupe_last_by_key(rows, ["posting_id"], ["batch_id"]).select(*names)
    if not bases:
        return latest
    base = few(spark.read.schema(POSTING_ROW).parquet(f"{root}/postings_base/{bases[-1][1]}"))
    return upsert_postings(base, latest).select(*names)


def compact_postings(spark: SparkSession, root: str, upto: int) -> None:
    """Write the table as of batch `upto` as a new base, in its pruning layout, and commit it.

    Always into a folder of its own: what is there is being read, and what a broken-off compaction left is in no commit.
    """
    log = read_log(spark, root)
    path, taken = f"{root}/postings_base/upto={upto}", 0
    while exists(spark, path):
        taken += 1
        path = f"{root}/postings_base/upto={upto}-{taken}"
    prune_layout(current_postings(spark, root, before=upto + 1, log=log)).write.options(**commits.bloom_filters(POSTING_KEY)).parquet(path)
    commits.commit(spark, root, [Part(upto, BASE, {"postings_base": [path.rsplit("/", 1)[1]]}, log.number)])


def posting_documents(postings: DataFrame, dates: DataFrame) -> DataFrame:
    """Postings with their other dates as arrays, one row for each page that brought dates.

    (captured_at, page) orders the rows of a posting and its place in the page the dates of a row, so
    no list is longer than a page, however often a posting is seen. A posting
    without other dates has one row with an empty list and neither time nor page.
    """
    by = ["posting_id", "captured_at", "page"]
    arrived = F.struct("ordinal", "posting_date")
    lists = dates.groupBy(*by).agg(F.sort_array(F.collect_list(arrived)).alias("_dates")).select(
        *by, F.col("_dates.posting_date").alias("other_posting_dates"))
    whole = postings.drop("other_posting_dates", "captured_at", "page").join(lists, "posting_id", "left")
    empty = F.array().cast(lists.schema["other_posting_dates"].dataType)
    return whole.withColumn("other_posting_dates", F.coalesce("other_posting_dates", empty))


SNAPSHOT = [t for t in STORED if t not in ("run_pages", "details_backlog")]
MANIFEST = "_snapshot.json"


def export_snapshot(spark: SparkSession, root: str, dest: str, date: str, as_of: int | None = None) -> int:
    """Dated copy of all tables as of one commit (the last, if not given), whatever is committed meanwhile.

    Rows keep the batch they were written by, postings that of their last version, so a copy can be
    worked on as the original can. An existing copy of that date is refused. Returns the commit number.
    """
    log = read_log(spark, root, as_of)
    for table in SNAPSHOT:
        rows = read_table(spark, root, table, log=log)
        if table == "postings":
            rows = dedupe_last_by_key(rows, ["posting_id"], ["batch_id"])
        rows.drop("capture_date").write.mode("errorifexists").parquet(f"{dest}/{date}/{table}")
    # The batches whose messages were not handed on at that moment.
    waiting = [e.part.batch_id for e in log.entries("changes", phase=SAVED) if e.number > log.position(PUBLISHED)]
    Folder(spark, f"{dest}/{date}").create(MANIFEST, {"as_of": log.number, "waiting": waiting})
    return log.number


def load_snapshot(spark: SparkSession, dest: str, date: str, root: str) -> None:
    """Working tables under a new `root` from a dated copy."""
    if read_log(spark, root).number:
        raise ValueError(f"{root} already exists")
    waiting = {(b, SAVED) for b in Folder(spark, f"{dest}/{date}").read(MANIFEST)["waiting"]}
    token = f"commit={uuid.uuid4().hex}"
    parts: dict[tuple[int, str], dict[str, list[str]]] = {}
    for table in SNAPSHOT:
        rows = spark.read.schema(T.StructType([*STORED[table].fields, BATCH])).parquet(f"{dest}/{date}/{table}")
        layout = ["batch_id"]
        if table == "raw_pages":
            rows, layout = rows.withColumn("capture_date", F.to_date("captured_at")), ["batch_id", *RAW_LAYOUT]
        writer = rows.hint("rebalance", *layout).write.mode("errorifexists").partitionBy(*layout)
        (writer.json if table == "published" else writer.parquet)(f"{root}/{table}/{token}")
        for name in batch_folders(spark, f"{root}/{table}/{token}"):
            parts.setdefault((int(name.removeprefix("batch_id=")), PHASE_OF.get(table, SAVED)), {})[table] = [f"{token}/{name}"]
    done = [Part(*key, tables) for key, tables in sorted(parts.items()) if key not in waiting]
    commits.commit(spark, root, [*done, Part(-1, PUBLISHED, {}, 1)])
    commits.commit(spark, root, [Part(*key, tables) for key, tables in sorted(parts.items()) if key in waiting])


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """The batch_id folders that a write laid out."""
    return [n for n in Folder(spark, path).names() if n.startswith("batch_id=")]
