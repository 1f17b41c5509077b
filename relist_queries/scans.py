"""Scans, lookups and routing filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as t

from relist import schemas as S
from relist.operators.reconcile import stamp_technical_fields
from relist.operators.validate import bounded_lookup, duplicate_keys, partition_split
from relist.functions.dates import same_local_date
from relist.session import scratch_path
from relist.sources import pages as P
from relist.sources import tables as T
from relist_queries.base import query, table
from relist_queries.frames import (
    CUSTOMER_URL, EVENT_PAGES, LINEITEM_SIGHTINGS, ORDER_POSTINGS, event_pages, flat, lineitem_sightings, order_postings,
    sql_id,
)


@query("scan_raw_pages", f"""
WITH {EVENT_PAGES}
SELECT raw_page_id, page, source, content, epoch_us(captured_at) // 1000 AS captured_at FROM raw_pages
WHERE source = 'click' AND captured_at >= TIMESTAMP '2024-01-05 00:00:00' AND captured_at <= TIMESTAMP '2024-01-20 12:30:00'""")
def scan_raw_pages(spark, sf):
    return flat(P.scan_raw_pages(event_pages(spark, sf), "click", "2024-01-05T00:00:00", "2024-01-20T12:30:00Z"))


@query("land_html_list_page", f"""
SELECT {sql_id("'ItViec'", "page_id + 1", "epoch_ms(TIMESTAMP '2024-01-01')")} AS raw_page_id, page_id + 1 AS page,
       'ItViec' AS source, html AS content, epoch_ms(TIMESTAMP '2024-01-01') AS captured_at FROM pages""")
def land_html_list_page(spark, sf):
    pages = table(spark, sf, "pages").select((F.col("page_id") + 1).alias("page"), F.col("html").alias("content"))
    return flat(P.land_html_list_page(pages, S.HTML_SOURCE, F.lit("2024-01-01").cast("timestamp")))


@query("land_json_list_page", f"""
WITH {EVENT_PAGES}
SELECT {sql_id("'VietnamWorks'", "page", "epoch_us(captured_at) // 1000")} AS raw_page_id, page, 'VietnamWorks' AS source, content,
       epoch_us(captured_at) // 1000 AS captured_at, page - 1 AS payload_page FROM raw_pages""")
def land_json_list_page(spark, sf):
    return flat(P.land_json_list_page(event_pages(spark, sf), S.JSON_SOURCE))


@query("scan_postings", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, url, title, array_to_string(tags, '|') AS tags, epoch_ms(posting_date) AS posting_date, company,
       array_to_string(locations, '|') AS locations, source, raw_page_id, epoch_ms(created_at) AS created_at FROM postings""")
def scan_postings(spark, sf):
    postings = order_postings(spark, sf)
    path = scratch_path(spark, "postings")
    postings.write.parquet(path)
    return flat(T.scan_postings(spark, path, postings.schema))


LOOKUP_URLS = f"""{ORDER_POSTINGS},
urls AS (SELECT DISTINCT '{CUSTOMER_URL}' || o_custkey AS url FROM orders WHERE o_orderstatus = 'F')"""


def _finished_customers(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit(CUSTOMER_URL), F.col("o_custkey").cast("string")).alias("url"))


@query("lookup_postings_by_key", f"""
WITH {LOOKUP_URLS}
SELECT posting_id, url, title, array_to_string(tags, '|') AS tags, epoch_ms(posting_date) AS posting_date, company,
       array_to_string(locations, '|') AS locations, source, raw_page_id, epoch_ms(created_at) AS created_at
FROM postings WHERE source = '1-URGENT' AND url IN (SELECT url FROM urls)""")
def lookup_postings_by_key(spark, sf):
    return flat(T.lookup_postings_by_key(order_postings(spark, sf), "1-URGENT", _finished_customers(spark, sf)))


@query("lookup_postings_project", f"""
WITH {LOOKUP_URLS}
SELECT posting_id, title, company FROM postings WHERE source = '5-LOW' AND url IN (SELECT url FROM urls)""")
def lookup_postings_project(spark, sf):
    return T.lookup_postings_project(
        order_postings(spark, sf), "5-LOW", _finished_customers(spark, sf), ["title", "company"])


@query("restore_snapshot", f"""
WITH {EVENT_PAGES}
SELECT raw_page_id, page, source, content, epoch_us(captured_at) // 1000 AS captured_at FROM raw_pages""")
def restore_snapshot(spark, sf):
    root = scratch_path(spark, "dump")
    T.conform_schema(event_pages(spark, sf), S.RAW_PAGE).write.parquet(f"{root}/2024-02-01/raw_pages")
    return flat(T.restore_snapshot(spark, root, "2024-02-01", "raw_pages"))


@query("conform_schema", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, url, title, array_to_string(tags, '|') AS tags, epoch_ms(posting_date) AS posting_date, 0::BIGINT AS n_other_dates,
       company, array_to_string(locations, '|') AS locations, source, raw_page_id, epoch_ms(created_at) AS created_at,
       modified_at IS NULL AS never_modified FROM (SELECT *, NULL AS modified_at FROM postings)""")
def conform_schema(spark, sf):
    stored = order_postings(spark, sf).withColumn("unknown_field", F.lit(1))
    rows = T.conform_schema(stored, S.POSTING)
    return flat(rows.withColumn("never_modified", F.col("modified_at").isNull())
                .withColumn("n_other_dates", F.size("other_posting_dates")).drop("modified_at", "other_posting_dates"))


@query("conform_schema_quarantine", """
SELECT d.doc_id, array_to_string([x FOR x IN [CASE WHEN l.quality IS NULL THEN 'quality' END,
       CASE WHEN try_cast(substring(d.source, 4) AS INTEGER) IS NULL THEN 'source' END] IF x IS NOT NULL], '|') AS violations
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NULL OR try_cast(substring(d.source, 4) AS INTEGER) IS NULL""")
def conform_schema_quarantine(spark, sf):
    schema = t.StructType([t.StructField("doc_id", t.LongType(), False), t.StructField("quality", t.IntegerType(), False),
                           t.StructField("source", t.IntegerType(), False), t.StructField("toxic", t.IntegerType(), True)])
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn(
        "source", F.substr("source", F.lit(4)))
    return flat(T.split_conforming(rows, schema)[1].select("doc_id", "violations"))


@query("check_source_domain", """
SELECT event_type AS source, count(*) AS n_pages FROM events GROUP BY event_type""")
def check_source_domain(spark, sf):
    types = ("click", "error", "purchase", "signup", "view")
    checked = P.check_source_domain(event_pages(spark, sf), types)
    return checked.groupBy("source").agg(F.count(F.lit(1)).alias("n_pages"))


@query("check_source_domain_quarantine", f"""
WITH {EVENT_PAGES} SELECT raw_page_id, source FROM raw_pages WHERE source NOT IN ('click', 'view')""")
def check_source_domain_quarantine(spark, sf):
    return P.unknown_sources(event_pages(spark, sf), ("click", "view")).select("raw_page_id", "source")


@query("select_sources", """
SELECT doc_id, source, 'listed' AS selection FROM documents WHERE source IN ('src1', 'src2', 'src3')
UNION ALL SELECT doc_id, source, 'all' FROM documents""")
def select_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    listed = P.select_sources(docs, ["src1", "src2", "src3"]).withColumn("selection", F.lit("listed"))
    return listed.unionByName(P.select_sources(docs, []).withColumn("selection", F.lit("all")))


@query("page_range", """
SELECT conv_id, turn AS page, 'closed' AS range FROM conversations WHERE turn BETWEEN 1 AND 3
UNION ALL SELECT conv_id, turn, 'open' FROM conversations WHERE turn >= 2
UNION ALL SELECT conv_id, turn, 'end before start' FROM conversations WHERE turn = 3""")
def page_range(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("page"))
    closed = P.page_range(turns, 1, 3).withColumn("range", F.lit("closed"))
    opened = P.page_range(turns, 2).withColumn("range", F.lit("open"))
    return closed.unionByName(opened).unionByName(P.page_range(turns, 3, 1).withColumn("range", F.lit("end before start")))


@query("capture_time_range", """
SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00'""")
def capture_time_range(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return flat(P.capture_time_range(events, "2024-01-10T06:00+07:00", None, column="ts"))


@query("stamp_technical_fields", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, 'update' AS kind, epoch_ms(created_at) AS created_at, epoch_ms(TIMESTAMP '2020-05-01 08:00:00') AS modified_at
FROM postings
UNION ALL
SELECT posting_id, 'insert', epoch_ms(TIMESTAMP '2020-05-01 08:00:00'), epoch_ms(TIMESTAMP '2020-05-01 08:00:00') FROM postings""")
def stamped(spark, sf):
    rows = order_postings(spark, sf).select("posting_id", F.col("created_at").cast("timestamp"))
    update = stamp_technical_fields(rows.withColumn("kind", F.lit("update")), "2020-05-01 08:00:00")
    insert = stamp_technical_fields(rows.drop("created_at").withColumn("kind", F.lit("insert")), "2020-05-01 08:00:00")
    return flat(update.unionByName(insert))


@query("same_local_date", """
SELECT l_orderkey AS order_key, l_linenumber AS line_number,
       CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE) AS same_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def same_date(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
        same_local_date(F.col("l_shipdate"), F.col("o_orderdate")).alias("same_date"))


@query("dedupe_last_by_key", """
SELECT event_type, user_id, event_id, epoch_us(ts) // 1000 AS ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_last(spark, sf):
    events = table(spark, sf, "events").drop("props")
    return flat(T.dedupe_last_by_key(events, ["event_type", "user_id"], ["ts", "event_id"]))


@query("distinct_urls", f"WITH {LINEITEM_SIGHTINGS} SELECT DISTINCT url FROM sightings")
def distinct_urls(spark, sf):
    return T.distinct_urls(lineitem_sightings(spark, sf))


@query("assert_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def unique_key(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("bounded_lookup", f"""
WITH {LOOKUP_URLS},
latest AS (SELECT * FROM postings QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY posting_date DESC, posting_id DESC) = 1)
SELECT posting_id, url, title FROM latest WHERE source = '1-URGENT' AND url IN (SELECT url FROM urls)""")
def bounded(spark, sf):
    """One posting for each key at most; the check fails the read otherwise."""
    found = bounded_lookup(T.latest_postings(order_postings(spark, sf)), "1-URGENT", _finished_customers(spark, sf))
    return found.select("posting_id", "url", "title")


@query("duplicate_keys", """
SELECT text, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicates(spark, sf):
    return duplicate_keys(table(spark, sf, "documents"), ["text"])


@query("partition_split", """
SELECT doc_id, coalesce(quality = 1, false) AS holds FROM documents LEFT JOIN labels USING (doc_id)""")
def split(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    yes, no = partition_split(rows, F.col("quality") == 1)
    return yes.select("doc_id", F.lit(True).alias("holds")).unionByName(no.select("doc_id", F.lit(False).alias("holds")))
