"""Counts, id lists and history per page and per run."""

from __future__ import annotations

from pyspark.sql import functions as F

from relist.functions.dates import ts_to_epoch_ms
from relist.functions.strings import hex_id
from relist.operators import accounting as A
from relist.operators import episodes as E
from relist_queries.base import query, table
from relist_queries.frames import PART_URL, flat, sql_fold, sql_id

# Orders are the pages: lineitem rows with tax are listings, those without are errors.
PAGES = f"""
good AS (SELECT l_returnflag AS source, '{PART_URL}' || l_partkey AS url, l_shipdate AS posting_date,
                l_shipdate AS captured_at, l_orderkey AS page, l_linenumber::BIGINT AS ordinal FROM lineitem WHERE l_tax > 0),{sql_fold('good')},
errors AS (SELECT l_orderkey AS page, {sql_id('l_orderkey', 'l_linenumber', 'l_partkey', 'epoch_ms(l_shipdate)')} AS error_id
           FROM lineitem WHERE l_tax = 0),
counts AS (SELECT page, coalesce(n_new, 0) AS n_new, coalesce(n_existing, 0) AS n_existing, coalesce(n_errors, 0) AS n_errors FROM
  (SELECT page, count(*) FILTER (outcome <> 'existing') AS n_new, count(*) FILTER (outcome = 'existing') AS n_existing FROM tagged GROUP BY page)
  FULL JOIN (SELECT page, count(*) AS n_errors FROM errors GROUP BY page) USING (page))"""


def _tagged_and_errors(spark, sf):
    rows = table(spark, sf, "lineitem")
    good = rows.where(F.col("l_tax") > 0).select(
        F.col("l_returnflag").alias("source"), F.concat(F.lit(PART_URL), F.col("l_partkey").cast("string")).alias("url"),
        F.col("l_shipdate").alias("posting_date"), F.col("l_shipdate").alias("captured_at"),
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("ordinal"))
    bad = rows.where(F.col("l_tax") == 0).select(
        F.col("l_orderkey").alias("page"),
        hex_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), ts_to_epoch_ms(F.col("l_shipdate"))).alias("error_id"))
    return E.posting_episodes(good), bad


@query("page_outcome_counts", f"WITH RECURSIVE {PAGES} SELECT * FROM counts")
def page_outcome_counts(spark, sf):
    return A.page_outcome_counts(*_tagged_and_errors(spark, sf), by="page")


@query("replay_totals", f"""
WITH RECURSIVE {PAGES}
SELECT sum(n_existing)::BIGINT AS n_updated, sum(n_new)::BIGINT AS n_inserted, sum(n_errors)::BIGINT AS n_errors FROM counts""")
def replay_totals(spark, sf):
    return A.replay_totals(A.page_outcome_counts(*_tagged_and_errors(spark, sf), by="page"))


@query("run_accumulate", f"""
WITH RECURSIVE {PAGES}
SELECT source, 1::BIGINT AS start_page, 1000000::BIGINT AS end_page, count(*) FILTER (outcome <> 'existing') AS n_new,
       count(*) FILTER (outcome = 'existing') AS n_existing FROM tagged GROUP BY source""")
def run_accumulate(spark, sf):
    return flat(A.run_accumulate(_tagged_and_errors(spark, sf)[0], 1, 1_000_000))


@query("run_records", f"""
WITH RECURSIVE {PAGES}
SELECT source, CASE WHEN outcome = 'existing' THEN 'existing' ELSE 'new' END AS list, page, ordinal,
       {sql_id('source', 'url', 'epoch_ms(episode_start)')} AS posting_id, url FROM tagged""")
def run_records(spark, sf):
    return flat(A.run_records(_tagged_and_errors(spark, sf)[0]))


IDS = f"""{PAGES},
ids AS (SELECT page, array_to_string(list_sort(list(id) FILTER (outcome <> 'existing')), '|') AS new_ids,
               array_to_string(list_sort(list(id) FILTER (outcome = 'existing')), '|') AS existing_ids
        FROM (SELECT *, {sql_id('source', 'url', 'epoch_ms(episode_start)')} AS id FROM tagged) GROUP BY page),
failed AS (SELECT page, array_to_string(list_sort(list(error_id)), '|') AS error_ids FROM errors GROUP BY page),
page_ids AS (SELECT page, coalesce(new_ids, '') AS new_ids, coalesce(existing_ids, '') AS existing_ids, coalesce(error_ids, '') AS error_ids
             FROM ids FULL JOIN failed USING (page))"""


@query("run_page_ids", f"WITH RECURSIVE {IDS} SELECT * FROM page_ids")
def run_page_ids(spark, sf):
    return flat(A.run_page_ids(*_tagged_and_errors(spark, sf), by="page"))


@query("run_page_summary", f"""
WITH RECURSIVE {PAGES}
SELECT o_orderkey AS raw_page_id, coalesce(n_new, 0) AS n_new, coalesce(n_existing, 0) AS n_existing,
       coalesce(n_errors, 0) AS n_errors, c.page IS NULL AS is_empty
FROM orders LEFT JOIN counts c ON o_orderkey = c.page""")
def run_page_summary(spark, sf):
    counts = A.page_outcome_counts(*_tagged_and_errors(spark, sf), by="page").withColumnRenamed("page", "raw_page_id")
    return A.run_page_summary(table(spark, sf, "orders").select(F.col("o_orderkey").alias("raw_page_id")), counts)


def _history_pages(spark, sf):
    """Orders as pages; those of pending orders failed to load."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("raw_page_id"), F.col("o_orderpriority").alias("source"), "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("content"))


RUN_ID = sql_id("o_orderkey", "'2024-03-01 03:00:00'", "'run'")
START, END = "TIMESTAMP '2024-03-01 03:00:00'", "TIMESTAMP '2024-03-01 03:00:12'"


@query("open_run_page", f"""
SELECT {RUN_ID} AS run_page_id, o_orderpriority AS source, epoch_ms({START}) AS start_time, '' AS new_ids, '' AS existing_ids,
       '' AS error_ids FROM orders""")
def open_run_page(spark, sf):
    opened = A.open_run_page(_history_pages(spark, sf), "2024-03-01 03:00:00")
    return flat(opened.drop("raw_page_id", "run_error", "end_time"))


def _closed(spark, sf):
    tagged, bad = _tagged_and_errors(spark, sf)
    ids = A.run_page_ids(tagged, bad, by="page").withColumn("raw_page_id", F.col("page").cast("string")).drop("page")
    return A.close_run_page(_history_pages(spark, sf), ids, "2024-03-01 03:00:00", "2024-03-01 03:00:12")


@query("close_run_page", f"""
WITH RECURSIVE {IDS}
SELECT {RUN_ID} AS run_page_id, o_orderpriority AS source, epoch_ms({START}) AS start_time, o_orderkey::VARCHAR AS raw_page_id,
       coalesce(new_ids, '') AS new_ids, coalesce(existing_ids, '') AS existing_ids, coalesce(error_ids, '') AS error_ids,
       CASE WHEN o_orderstatus = 'P' THEN 'Page has no content' END AS run_error, epoch_ms({END}) AS end_time
FROM orders LEFT JOIN page_ids ON page = o_orderkey""")
def close_run_page(spark, sf):
    return flat(_closed(spark, sf))


@query("run_page_status", f"""
SELECT {RUN_ID} AS run_page_id, CASE o_orderstatus WHEN 'P' THEN 'failed' WHEN 'O' THEN 'running' ELSE 'succeeded' END AS status FROM orders""")
def run_page_status(spark, sf):
    """Opening and closing events; the pages of open orders are not closed yet."""
    pages = _history_pages(spark, sf)
    opened = A.open_run_page(pages, "2024-03-01 03:00:00")
    none = F.array().cast("array<string>")
    ids = pages.select("raw_page_id", *[none.alias(c) for c in ("new_ids", "existing_ids", "error_ids")])
    closed = A.close_run_page(pages.where(F.col("o_orderstatus") != "O"), ids, "2024-03-01 03:00:00", "2024-03-01 03:00:12")
    return A.run_page_status(A.run_page_view(opened.unionByName(closed))).select("run_page_id", "status")
