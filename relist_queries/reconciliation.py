"""A batch against stored postings, episodes and the frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from relist.functions.dates import ts_to_epoch_ms
from relist.operators import details as D
from relist.operators import episodes as E
from relist.operators import frontier as Fr
from relist.operators import publish as P
from relist.operators import reconcile as R
from relist.plans.jobs import changed_postings
from relist.session import materialize
from relist_queries.base import query, table
from relist_queries.frames import (
    LINEITEM_SIGHTINGS, ORDER_POSTINGS, ORDER_SIGHTINGS, STORED_AND_BATCH, flat, lineitem_sightings, order_postings,
    order_sightings, sql_fold, sql_id, stored_and_batch,
)

JOINED = """source, url, epoch_ms(posting_date) AS posting_date, stored_id, epoch_ms(stored_date) AS stored_date"""


def _shown(rows, *more):
    return flat(rows.select("source", "url", "posting_date", "stored_id", "stored_date", *more))


@query("reconcile_left_join", f"""
WITH {STORED_AND_BATCH}
SELECT source, url, epoch_ms(posting_date) AS posting_date, stored_id, coalesce(epoch_ms(stored_date), -1) AS stored_date FROM joined""")
def reconcile_left_join(spark, sf):
    batch, stored = stored_and_batch(spark, sf)[::-1]
    rows = R.reconcile_left_join(batch, stored)
    date = F.coalesce(ts_to_epoch_ms(F.col("stored_date")), F.lit(-1).cast("bigint"))
    return _shown(rows.withColumn("stored_date", date))


@query("new_postings", f"WITH {STORED_AND_BATCH} SELECT source, url, epoch_ms(posting_date) AS posting_date FROM joined WHERE stored_id IS NULL")
def new_postings(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return flat(R.new_postings(batch, stored))


@query("matched_postings", f"WITH {STORED_AND_BATCH} SELECT {JOINED} FROM joined WHERE stored_id IS NOT NULL")
def matched_postings(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return _shown(R.matched_postings(batch, stored))


@query("reposted_postings", f"WITH {STORED_AND_BATCH} SELECT {JOINED} FROM joined WHERE outcome = 'reposted'")
def reposted_postings(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return _shown(R.reposted_postings(batch, stored))


@query("within_window_postings", f"WITH {STORED_AND_BATCH} SELECT {JOINED} FROM joined WHERE outcome = 'existing'")
def within_window_postings(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return _shown(R.within_window_postings(batch, stored))


@query("classify_postings", f"""
WITH {STORED_AND_BATCH} SELECT source, url, epoch_ms(posting_date) AS posting_date, outcome FROM joined""")
def classify_postings(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return flat(R.classify_postings(batch, stored).select("source", "url", "posting_date", "outcome"))


@query("classify_every_sighting", f"""
WITH {LINEITEM_SIGHTINGS},
stored AS (SELECT l_returnflag AS source, 'https://listings.example.com/parts/' || l_partkey AS url, max(l_shipdate) AS stored_date
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2)
SELECT source, url, epoch_ms(posting_date) AS posting_date, page, ordinal,
       CASE WHEN stored_date IS NULL THEN 'new' WHEN posting_date >= stored_date + INTERVAL 365 DAY THEN 'reposted' ELSE 'existing' END AS outcome
FROM sightings LEFT JOIN stored USING (source, url)""")
def classify_every_sighting(spark, sf):
    """Row-level classification, also of rows dated before the stored posting."""
    stored, _ = stored_and_batch(spark, sf)
    rows = R.classify_postings(lineitem_sightings(spark, sf), stored, gap_days=365)
    return flat(rows.select("source", "url", "posting_date", "page", "ordinal", "outcome"))


@query("union_new_and_reposted", f"""
WITH {STORED_AND_BATCH} SELECT source, url, epoch_ms(posting_date) AS posting_date FROM joined WHERE outcome IN ('new', 'reposted')""")
def union_new_and_reposted(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return flat(R.union_new_and_reposted(batch, stored))


@query("union_changed", f"WITH {STORED_AND_BATCH} SELECT source, url, outcome FROM joined")
def union_changed(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return R.union_changed(R.classify_postings(batch, stored)).select("source", "url", "outcome")


@query("merge_existing", f"""
WITH {STORED_AND_BATCH}
SELECT stored_id AS posting_id, source, url, epoch_ms(stored_date) AS posting_date, epoch_ms(stored_date) AS created_at,
       array_to_string([epoch_ms(stored_date), epoch_ms(posting_date)], '|') AS other_posting_dates
FROM joined WHERE outcome = 'existing'""")
def merge_existing(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    merged = R.merge_existing(R.within_window_postings(batch, stored))
    dates = F.transform("other_posting_dates", ts_to_epoch_ms).cast("array<string>")
    return flat(merged.withColumn("other_posting_dates", dates))


@query("late_posting", f"""
WITH RECURSIVE {ORDER_SIGHTINGS},{sql_fold('sightings')}
SELECT source, url, page, epoch_ms(posting_date) AS posting_date, epoch_ms(episode_start) AS episode_start, outcome
FROM tagged WHERE posting_date < episode_start""")
def late_posting(spark, sf):
    tagged = E.posting_episodes(order_sightings(spark, sf))
    late = tagged.where(F.col("posting_date") < F.col("episode_start"))
    return flat(late.select("source", "url", "page", "posting_date", "episode_start", "outcome"))


@query("posting_episodes", f"""
WITH RECURSIVE {ORDER_SIGHTINGS},{sql_fold('sightings')}
SELECT source, url, page, epoch_ms(posting_date) AS posting_date, epoch_ms(episode_start) AS episode_start, repost_index, outcome,
       {sql_id('source', 'url', 'epoch_ms(episode_start)')} AS posting_id FROM tagged""")
def posting_episodes(spark, sf):
    tagged = E.posting_episodes(order_sightings(spark, sf))
    return flat(tagged.select("source", "url", "page", "posting_date", "episode_start", "repost_index", "outcome", "posting_id"))


@query("posting_episodes_lineitem", f"""
WITH RECURSIVE {LINEITEM_SIGHTINGS},{sql_fold('sightings')}
SELECT source, url, page, ordinal, epoch_ms(posting_date) AS posting_date, epoch_ms(episode_start) AS episode_start, repost_index, outcome
FROM tagged""")
def posting_episodes_lineitem(spark, sf):
    tagged = E.posting_episodes(lineitem_sightings(spark, sf))
    return flat(tagged.select("source", "url", "page", "ordinal", "posting_date", "episode_start", "repost_index", "outcome"))


@query("posting_episodes_stored", f"""
WITH RECURSIVE {ORDER_SIGHTINGS},
first AS (SELECT source, url, min(posting_date) AS d FROM sightings GROUP BY source, url),
seeded AS (SELECT source, url, d AS posting_date, TIMESTAMP '1900-01-01' AS captured_at, 0::BIGINT AS page, -1 AS ordinal FROM first
           UNION ALL SELECT source, url, posting_date, captured_at, page, ordinal FROM sightings),{sql_fold('seeded', 90)}
SELECT source, url, page, epoch_ms(episode_start) AS episode_start, outcome FROM tagged WHERE ordinal >= 0""")
def posting_episodes_stored(spark, sf):
    """The fold continued from a stored posting per key (its earliest date)."""
    sightings = order_sightings(spark, sf)
    stored = sightings.groupBy("source", "url").agg(F.min("posting_date").alias("posting_date")).withColumn(
        "posting_id", F.concat(F.lit("stored "), "url"))
    tagged = E.posting_episodes(sightings, stored, gap_days=90)
    return flat(tagged.select("source", "url", "page", "episode_start", "outcome"))


@query("posting_timeline", f"""
WITH RECURSIVE {LINEITEM_SIGHTINGS},{sql_fold('sightings', 365)}
SELECT source, url, repost_index, epoch_ms(episode_start) AS episode_start,
       {sql_id('source', 'url', 'epoch_ms(episode_start)')} AS posting_id,
       count(*) FILTER (outcome = 'existing') AS n_other_dates,
       coalesce(epoch_ms(max(posting_date) FILTER (outcome = 'existing')), -1) AS last_other_date
FROM tagged GROUP BY ALL""")
def posting_timeline(spark, sf):
    rows = E.posting_timeline(E.posting_episodes(lineitem_sightings(spark, sf), gap_days=365))
    last = F.coalesce(ts_to_epoch_ms(F.col("last_other_date")), F.lit(-1).cast("bigint"))
    return flat(rows.drop("first_other_date").withColumn("last_other_date", last))


EVENT_DAYS = """
first_seen AS (SELECT event_type, user_id, min(date_diff('day', TIMESTAMP '2024-01-01', ts)) AS first_day FROM events GROUP BY ALL),
days AS (SELECT event_type AS source, date_diff('day', TIMESTAMP '2024-01-01', ts) AS page, count(*) AS n_events FROM events GROUP BY ALL),
info AS (SELECT d.source, d.page, d.n_events, exists(SELECT 1 FROM first_seen f WHERE f.event_type = d.source AND f.first_day = d.page)
         AS found_new_info FROM days d)"""


def _event_days(spark, sf):
    """Event types as sources and days as pages; a day is informative if some user is first seen on it."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    events = table(spark, sf, "events").select(F.col("event_type").alias("source"), day.alias("page"), "user_id")
    first = events.groupBy("source", "user_id").agg(F.min("page").alias("page"))
    informative = first.select("source", "page").distinct().withColumn("found_new_info", F.lit(True))
    return (events.groupBy("source", "page").agg(F.count(F.lit(1)).alias("n_events"))
            .join(informative, ["source", "page"], "left")
            .withColumn("found_new_info", F.coalesce("found_new_info", F.lit(False))))


@query("frontier_cutoff", f"""
WITH {EVENT_DAYS},
stops AS (SELECT *, coalesce(sum(CASE WHEN NOT found_new_info OR page >= 20 THEN 1 ELSE 0 END) OVER (
          PARTITION BY source ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM info)
SELECT source, page, n_events, found_new_info FROM stops WHERE stopped = 0""")
def frontier_cutoff(spark, sf):
    return flat(Fr.frontier_cutoff(_event_days(spark, sf), end_page=20))


@query("found_new_info", f"""
WITH RECURSIVE {LINEITEM_SIGHTINGS},{sql_fold('sightings')},
pages AS (SELECT o_orderkey AS page FROM orders)
SELECT page, coalesce(bool_or(outcome IN ('new', 'reposted')), false) AS found_new_info
FROM pages LEFT JOIN tagged USING (page) GROUP BY page""")
def found_new_info(spark, sf):
    tagged = E.posting_episodes(lineitem_sightings(spark, sf)).withColumnRenamed("page", "raw_page_id")
    pages = table(spark, sf, "orders").select(F.col("o_orderkey").alias("raw_page_id"))
    return Fr.page_new_info(pages, tagged).withColumnRenamed("raw_page_id", "page")


DETAILS = f"""
postings AS (SELECT 'posting-' || page_id AS posting_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || '#gone' END AS url FROM pages),
captured AS (SELECT url, arg_max(html, page_id) AS html FROM pages GROUP BY url)"""


def _detail_postings(spark, sf):
    pages = table(spark, sf, "pages")
    url = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit("#gone")))
    return pages.select(F.concat(F.lit("posting-"), F.col("page_id").cast("string")).alias("posting_id"), url.alias("url"))


ATTACHED = f"""
WITH {DETAILS}
SELECT {sql_id('posting_id', "'2024-03-01 00:00:00'", "'detail'")} AS detail_id, posting_id,
       CASE WHEN contains(html, '</body>') THEN regexp_extract(html, '(?s)<body[^>]*>.*</body>')
            WHEN html IS NOT NULL THEN regexp_extract(html, '(?s)<body[^>]*>.*$') END AS html,
       CASE WHEN html IS NULL THEN 'No detail page captured' END AS error,
       epoch_ms(TIMESTAMP '2024-03-01') AS created_at
FROM postings LEFT JOIN captured USING (url)"""


@query("attach_details", ATTACHED)
def attach_details(spark, sf):
    pages = table(spark, sf, "pages").select("url", "html", "page_id")
    return flat(D.attach_details(_detail_postings(spark, sf), pages, "2024-03-01 00:00:00"))


@query("detail_lookup", f"""
WITH {DETAILS},
failed AS (SELECT url || '#gone' AS url, 'HTTP 404 for page ' || max(page_id) AS error FROM pages GROUP BY url)
SELECT posting_id, html IS NOT NULL AS found, CASE WHEN html IS NULL THEN coalesce(error, 'No detail page captured') END AS error
FROM postings LEFT JOIN captured USING (url) LEFT JOIN failed USING (url)""")
def detail_lookup(spark, sf):
    """Captured pages and failures come as one table; a failure is a value, not an exception."""
    pages = table(spark, sf, "pages").select("url", "html", "page_id", F.lit(None).cast("string").alias("error"))
    gone = table(spark, sf, "pages").select(
        F.concat("url", F.lit("#gone")).alias("url"), F.lit(None).cast("string").alias("html"), "page_id",
        F.concat(F.lit("HTTP 404 for page "), F.col("page_id").cast("string")).alias("error"))
    rows = D.attach_details(_detail_postings(spark, sf), pages.unionByName(gone), "2024-03-01 00:00:00")
    return rows.select("posting_id", F.col("html").isNotNull().alias("found"), "error")


@query("details_backlog", "SELECT doc_id AS posting_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def details_backlog(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("posting_id"))
    return D.details_backlog(docs, table(spark, sf, "labels").withColumnRenamed("doc_id", "posting_id"))


MESSAGE = """to_json({'_id': posting_id, 'url': url, 'title': title, 'tags': tags, 'postingDate': epoch_ms(posting_date),
                     'company': company, 'locations': locations, 'rawJobSourceName': source})::VARCHAR"""


@query("publish_projection", f"WITH {ORDER_POSTINGS} SELECT posting_id AS key, {MESSAGE} AS value FROM postings")
def publish_projection(spark, sf):
    return P.publish_projection(order_postings(spark, sf))


@query("record_encoder", f"""
WITH {ORDER_POSTINGS} SELECT posting_id AS key, to_json({{'link': url, 'n_tags': len(tags)}})::VARCHAR AS value FROM postings""")
def record_encoder(spark, sf):
    """Messages with fields of one's own."""
    return P.publish_projection(order_postings(spark, sf), [F.col("url").alias("link"), F.size("tags").alias("n_tags")])


CHANGES = f"""
WITH RECURSIVE {ORDER_SIGHTINGS},{sql_fold('sightings')},
versions AS (SELECT {sql_id('source', 'url', 'epoch_ms(episode_start)')} AS posting_id, url, title, episode_start, company, source, raw_page_id
             FROM tagged QUALIFY row_number() OVER (PARTITION BY source, url, episode_start ORDER BY captured_at DESC, page DESC) = 1)"""


@query("insert_postings", f"""
WITH {ORDER_SIGHTINGS}
SELECT {sql_id('source', 'url', 'epoch_ms(posting_date)')} AS posting_id, title, epoch_ms(TIMESTAMP '2020-01-01') AS created_at,
       epoch_ms(TIMESTAMP '2020-01-01') AS modified_at FROM sightings""")
def insert_postings(spark, sf):
    rows = R.insert_postings(order_sightings(spark, sf), "2020-01-01 00:00:00")
    return flat(rows.select("posting_id", "title", "created_at", "modified_at"))


@query("update_postings", f"""
WITH {ORDER_POSTINGS}
SELECT posting_id, 'changed ' || title AS title, epoch_ms(created_at) AS created_at, epoch_ms(TIMESTAMP '2020-01-01') AS modified_at
FROM postings WHERE source <> '5-LOW'""")
def update_postings(spark, sf):
    """Updates by id; those of postings that are not stored (the low priorities) do nothing."""
    postings = order_postings(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp"))
    changes = postings.withColumn("title", F.concat(F.lit("changed "), "title"))
    rows = R.update_postings(postings.where(F.col("source") != "5-LOW"), changes, "2020-01-01 00:00:00")
    return flat(rows.select("posting_id", "title", "created_at", "modified_at"))


@query("upsert_postings", f"""
{CHANGES}
SELECT posting_id, url, title, epoch_ms(episode_start) AS posting_date, company, source, raw_page_id,
       epoch_ms(TIMESTAMP '2020-01-01') AS created_at FROM versions
UNION ALL
SELECT 'kept ' || o_custkey, '{{}}', 'Customer', 0, 'c', 'stored', 'p', epoch_ms(TIMESTAMP '2019-01-01') FROM orders GROUP BY o_custkey""")
def upsert_postings(spark, sf):
    """The table after a save: untouched rows stay, touched postings get their new version."""
    tagged = materialize(E.posting_episodes(order_sightings(spark, sf)), "tagged")
    kept = table(spark, sf, "orders").groupBy("o_custkey").agg(F.lit(1).alias("x")).select(
        F.concat(F.lit("kept "), F.col("o_custkey").cast("string")).alias("posting_id"), F.lit("{}").alias("url"),
        F.lit("Customer").alias("title"), F.lit("1970-01-01").cast("timestamp_ntz").alias("posting_date"), F.lit("c").alias("company"),
        F.lit("stored").alias("source"), F.lit("p").alias("raw_page_id"), F.lit("2019-01-01").cast("timestamp").alias("created_at"))
    old = tagged.where(F.col("outcome") != "existing").select(
        "posting_id", "url", F.lit("old").alias("title"), F.col("episode_start").alias("posting_date"), "company", "source",
        "raw_page_id", F.lit("2020-01-01").cast("timestamp").alias("created_at"))
    stored = kept.unionByName(old)
    changed = changed_postings(tagged, stored, "2021-01-01 00:00:00").select(*stored.columns)
    return flat(R.upsert_postings(stored, changed))
