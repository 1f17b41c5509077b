"""Writes to stored tables, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from relist.operators import details as D
from relist.operators import publish as P
from relist.operators import validate as V
from relist.operators import registry as R
from relist.session import scratch_path
from relist.operators.reconcile import NEW
from relist.sinks import feed
from relist.sinks import tables as T
from relist.sinks.commits import Batch, read_log
from relist.sources import tables as sources
from relist_queries.base import query, table
from relist_queries.frames import (
    ALL_LISTINGS, EVENT_PAGES, LINEITEM_SIGHTINGS, ORDER_POSTINGS, event_pages, flat, lineitem_sightings, list_pages,
    order_postings, order_sightings, sql_id,
)
from relist_queries.reconciliation import ATTACHED, MESSAGE, _detail_postings


@query("append_raw_page", f"""
WITH {EVENT_PAGES}
SELECT raw_page_id, page, source, content, epoch_us(captured_at) // 1000 AS captured_at, 1::BIGINT AS batch_id FROM raw_pages
UNION ALL SELECT raw_page_id, page, source, content, epoch_us(captured_at) // 1000, 2 FROM raw_pages""")
def append_raw_page(spark, sf):
    """Two batches, one of them written twice; read back from the partitioned table."""
    root = scratch_path(spark, "raw")
    pages = event_pages(spark, sf).withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    for batch in (1, 2, 2):
        T.append_raw_page(pages, root, batch)
    return flat(T.read_table(spark, root, "raw_pages").drop("capture_date"))


@query("append_errors", f"""
WITH {ALL_LISTINGS}
SELECT {sql_id('raw_page_id', 'ordinal', "'error'")} AS error_id, array_to_string(errors, '|') AS errors, raw_page_id, 1::BIGINT AS batch_id
FROM failures""")
def append_errors(spark, sf):
    root = scratch_path(spark, "errors")
    T.append_errors(V.route_errors(V.required_fields_check(R.extract_pages(list_pages(spark, sf)))), root, 1)
    return flat(T.read_table(spark, root, "extract_errors").drop("raw_fragment"))


@query("append_details", ATTACHED)
def append_details(spark, sf):
    root = scratch_path(spark, "details")
    pages = table(spark, sf, "pages").select("url", "html", "page_id")
    T.append_details(D.attach_details(_detail_postings(spark, sf), pages, "2024-03-01 00:00:00"), root, 1)
    return flat(T.read_table(spark, root, "posting_details").drop("batch_id"))


@query("publish_changes", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id AS key, {MESSAGE} AS value, 1 + CAST(substr(posting_id, 9) AS BIGINT) % 3 AS batch_id, 1 + CAST(substr(posting_id, 9) AS BIGINT) % 3 AS commit_number
FROM postings""")
def publish_changes(spark, sf):
    """Three batches: a try of the first was never committed, the jobs of the first two ended before they handed anything on,
    that of the third hands on what is behind the position; then there is nothing left."""
    root = scratch_path(spark, "published")
    tagged = order_sightings(spark, sf).withColumns({
        "posting_id": F.concat(F.lit("posting-"), F.col("page").cast("string")), "outcome": F.lit(NEW), "batch": 1 + F.col("page") % 3,
        "page": F.col("page").cast("int"), "captured_at": F.col("captured_at").cast("timestamp")})
    for batch_id, committed in ((1, False), (1, True), (2, True), (3, True)):
        batch = Batch(spark, root, batch_id, T.SAVED)
        batch.write(P.change_rows(tagged.where(F.col("batch") == batch_id)), "changes")
        if committed:
            batch.commit()
    feed.publish_changes(spark, root)
    feed.publish_changes(spark, root)
    return feed.read_published(spark, root).select("key", "value", "batch_id", "commit_number")


@query("prune_layout", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, source, url FROM postings WHERE source = '2-HIGH' AND url >= 'https://listings.example.com/customers/5'""")
def prune_layout(spark, sf):
    path = scratch_path(spark, "layout")
    T.prune_layout(order_postings(spark, sf)).write.parquet(path)
    stored = spark.read.parquet(path)
    wanted = (F.col("source") == "2-HIGH") & (F.col("url") >= "https://listings.example.com/customers/5")
    return stored.where(wanted).select("posting_id", "source", "url")


def _store(spark, sf, root):
    """Orders as postings: all of them in batch 1, the open ones changed in batch 2."""
    postings = order_postings(spark, sf)
    postings = postings.withColumns({c: F.col(c).cast("timestamp") for c in ("posting_date", "created_at")})
    rows = postings.withColumn("modified_at", F.col("created_at")).select(*[f.name for f in T.POSTING_ROW.fields])
    T.write_batch(rows, root, "postings", 1)
    T.write_batch(rows.where(F.col("tags")[0] == "O").withColumn("title", F.lit("changed")), root, "postings", 2)


CURRENT = f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, CASE WHEN tags[1] = 'O' THEN 'changed' ELSE title END AS title, source, url,
       epoch_ms(posting_date) AS posting_date FROM postings"""


@query("current_postings", CURRENT)
def current_postings(spark, sf):
    """Latest versions over a compacted base and the batches after it."""
    root = scratch_path(spark, "current")
    _store(spark, sf, root)
    T.compact_postings(spark, root, 1)
    return flat(T.current_postings(spark, root).select("posting_id", "title", "source", "url", "posting_date"))


@query("export_snapshot", CURRENT)
def export_snapshot(spark, sf):
    """The tables as of a commit, exported after a later batch was saved and while another one is being written."""
    root = scratch_path(spark, "export")
    _store(spark, sf, root)
    moment = read_log(spark, root).number
    later = T.read_table(spark, root, "postings").drop("batch_id").withColumn("title", F.lit("later"))
    T.write_batch(later, root, "postings", 3)
    Batch(spark, root, 4, T.SAVED).write(later, "postings")
    T.export_snapshot(spark, root, f"{root}-dump", "2024-02-02", as_of=moment)
    rows = sources.restore_snapshot(spark, f"{root}-dump", "2024-02-02", "postings", T.POSTING_ROW)
    return flat(rows.select("posting_id", "title", "source", "url", "posting_date"))


@query("posting_documents", f"""
WITH {LINEITEM_SIGHTINGS}
SELECT url AS posting_id, epoch_ms(captured_at) AS captured_at, page,
       array_to_string(list(epoch_ms(posting_date) ORDER BY ordinal, posting_date), '|') AS dates
FROM sightings GROUP BY ALL""")
def posting_documents(spark, sf):
    """Date lists per posting and page."""
    dates = lineitem_sightings(spark, sf).withColumn("posting_id", F.col("url"))
    documents = T.posting_documents(dates.select("posting_id").distinct(), dates)
    ms = F.transform("other_posting_dates", lambda d: F.unix_millis(d.cast("timestamp"))).cast("array<string>")
    return flat(documents.select("posting_id", "captured_at", "page", F.array_join(ms, "|").alias("dates")))
