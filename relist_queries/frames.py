"""The test tables read as pages, sightings and postings, in Spark and in SQL.

Every frame comes with a SQL text of the same rows, to be used as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.functions.dates import ts_to_epoch_ms
from relist.functions.strings import hex_id
from relist.schemas import HTML_SOURCE, JSON_SOURCE
from relist_queries.base import table

PART_URL = "https://listings.example.com/parts/"
CUSTOMER_URL = "https://listings.example.com/customers/"


def sql_id(*keys: str) -> str:
    return f"left(sha256(concat_ws(chr(1), {', '.join(keys)})), 24)"


def sql_fold(sightings: str, gap: int = 30) -> str:
    """Recursive CTEs `ranked` and `tagged` over a CTE of sightings."""
    same_key = "r.source = f.source AND r.url = f.url AND r.rn = f.rn + 1"
    opens = f"r.posting_date >= f.episode_start + INTERVAL {gap} DAY"
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY captured_at, page, ordinal, posting_date) AS rn
           FROM {sightings}),
tagged AS (
  SELECT *, posting_date AS episode_start, 0::BIGINT AS repost_index, 'new' AS outcome FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.*, CASE WHEN {opens} THEN r.posting_date ELSE f.episode_start END,
         CASE WHEN {opens} THEN f.repost_index + 1 ELSE f.repost_index END,
         CASE WHEN {opens} THEN 'reposted' ELSE 'existing' END
  FROM tagged f JOIN ranked r ON {same_key})"""


# --- sightings ---------------------------------------------------------------

def lineitem_sightings(spark: SparkSession, sf: str) -> DataFrame:
    """Return flag as source, part as url; they arrive in date order."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("source"),
        F.concat(F.lit(PART_URL), F.col("l_partkey").cast("string")).alias("url"),
        F.col("l_shipdate").alias("posting_date"),
        F.col("l_shipdate").alias("captured_at"),
        F.col("l_orderkey").alias("page"),
        F.col("l_linenumber").alias("ordinal"))


LINEITEM_SIGHTINGS = f"""
sightings AS (SELECT l_returnflag AS source, '{PART_URL}' || l_partkey AS url, l_shipdate AS posting_date,
                     l_shipdate AS captured_at, l_orderkey AS page, l_linenumber::BIGINT AS ordinal FROM lineitem)"""


def order_sightings(spark: SparkSession, sf: str) -> DataFrame:
    """Priority as source, customer as url; they arrive in order of their key, so many are
    dated before one that came earlier."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.concat(F.lit(CUSTOMER_URL), F.col("o_custkey").cast("string")).alias("url"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.col("o_orderdate").alias("posting_date"),
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("company"),
        F.array("o_orderstatus").alias("locations"),
        F.concat(F.lit("page-"), F.col("o_orderkey").cast("string")).alias("raw_page_id"),
        (F.lit("2002-01-01").cast("timestamp_ntz") + F.make_interval(secs=F.col("o_orderkey").cast("decimal(18,6)")))
        .alias("captured_at"),
        F.col("o_orderkey").alias("page"),
        F.lit(0).alias("ordinal"))


ORDER_SIGHTINGS = f"""
sightings AS (SELECT o_orderpriority AS source, '{CUSTOMER_URL}' || o_custkey AS url, 'Order ' || o_orderkey AS title,
                     [o_orderstatus, o_orderpriority] AS tags, o_orderdate AS posting_date,
                     'customer-' || o_custkey AS company, [o_orderstatus] AS locations, 'page-' || o_orderkey AS raw_page_id,
                     TIMESTAMP '2002-01-01' + to_seconds(o_orderkey) AS captured_at, o_orderkey AS page, 0 AS ordinal
              FROM orders)"""

SPLIT_DATE = "1999-01-01"


def stored_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Lineitem cut at a date: the postings per (flag, part) dated before it are stored,
    the first date per key from it on is the batch."""
    rows = lineitem_sightings(spark, sf)
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    stored = rows.where(F.col("posting_date") < cut).groupBy("source", "url").agg(F.max("posting_date").alias("posting_date"))
    batch = rows.where(F.col("posting_date") >= cut).groupBy("source", "url").agg(F.min("posting_date").alias("posting_date"))
    return (
        stored.withColumn("posting_id", hex_id(F.col("source"), F.col("url"), ts_to_epoch_ms(F.col("posting_date"))))
        .withColumn("created_at", F.col("posting_date"))
        .withColumn("other_posting_dates", F.array(F.col("posting_date"))),
        batch)


STORED_AND_BATCH = f"""{LINEITEM_SIGHTINGS},
stored AS (SELECT source, url, max(posting_date) AS stored_date,
                  {sql_id('source', 'url', 'epoch_ms(max(posting_date))')} AS stored_id
           FROM sightings WHERE posting_date < TIMESTAMP '{SPLIT_DATE}' GROUP BY source, url),
batch AS (SELECT source, url, min(posting_date) AS posting_date
          FROM sightings WHERE posting_date >= TIMESTAMP '{SPLIT_DATE}' GROUP BY source, url),
joined AS (SELECT b.source, b.url, b.posting_date, s.stored_id, s.stored_date,
                  CASE WHEN s.stored_id IS NULL THEN 'new'
                       WHEN b.posting_date >= s.stored_date + INTERVAL 30 DAY THEN 'reposted'
                       ELSE 'existing' END AS outcome
           FROM batch b LEFT JOIN stored s USING (source, url))"""


def order_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as one stored posting."""
    return order_sightings(spark, sf).select(
        F.concat(F.lit("posting-"), F.col("page").cast("string")).alias("posting_id"),
        "url", "title", "tags", "posting_date", "company", "locations", "source", "raw_page_id",
        F.col("captured_at").alias("created_at"))


ORDER_POSTINGS = f"""{ORDER_SIGHTINGS},
postings AS (SELECT 'posting-' || page AS posting_id, url, title, tags, posting_date, company, locations, source, raw_page_id,
                    captured_at AS created_at FROM sightings)"""


def event_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed JSON responses."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("raw-"), F.col("event_id").cast("string")).alias("raw_page_id"),
        (F.col("event_id") + 1).cast("int").alias("page"),
        F.col("event_type").alias("source"),
        F.col("props").alias("content"),
        F.col("ts").alias("captured_at"))


EVENT_PAGES = """
raw_pages AS (SELECT 'raw-' || event_id AS raw_page_id, event_id + 1 AS page, event_type AS source, props AS content,
                     ts AS captured_at FROM events)"""

# --- list pages --------------------------------------------------------------

UNITS = ("second", "minute", "hour", "day", "week", "month", "year", "fortnight")


def _per_item(count: Column, item) -> Column:
    return F.transform(F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>")), item)


def captured_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as page captures: a source is captured on the first day of each month. The thin
    rows are spread over the tasks before the page texts are built from them."""
    return table(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism, "o_orderkey").withColumn(
        "captured", F.date_trunc("month", "o_orderdate").cast("timestamp"))


CAPTURED = "date_trunc('month', o_orderdate)::TIMESTAMP"


def html_list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One HTML list page per order with 0 to 3 cards; some cards lack a part."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    amount = cust % 60 + 1

    def card(i: Column) -> Column:
        lack = (key * 7 + i) % 11
        unit = F.element_at(F.array(*[F.lit(u) for u in UNITS]), ((key + i) % 8 + 1).cast("int"))
        age = F.concat(amount.cast("string"), F.lit(" "), unit, F.when(amount > 1, "s").otherwise(""), F.lit(" ago"))

        def part(when_lacking: int, *pieces) -> Column:
            text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in pieces])
            return F.when(lack == when_lacking, "").otherwise(text)

        return F.concat(
            F.lit('<div class="job hot"><div class="job_content">\n<div class="logo"><div class="logo-wrapper">'),
            part(2, '<a href="/companies/clerk-', (cust % 10).cast("string"), ' ">x</a>'),
            F.lit('</div></div><div class="job__description"><div class="job__body"><div class="details"><h2 class="title">'),
            part(0, '<a class=k href=" /it-jobs/', cust.cast("string"), "-", i.cast("string"),
                 '">Senior &amp; <b>role</b>\n ', cust.cast("string"), "<br>x</a>"),
            F.lit('</h2></div></div><div class="job-bottom"><div class="tag-list">'),
            part(1, "<a><span>", F.col("o_orderstatus"), "</span></a><a href='#'><span> SQL </span></a><a><span>",
                 F.col("o_orderstatus"), "</span></a>"),
            F.lit('</div></div></div><!-- <div class="job"> --><div class="city_and_posted_date"><div class="city">'),
            part(3, '<div class="address"><span class="text">', F.col("o_orderpriority"), "</span></div>"),
            F.lit('</div><div class="distance-time-job-posted"><span>\t'), F.when(i == 2, F.upper(age)).otherwise(age),
            F.lit("\n</span></div></div></div></div>"))

    cards = F.array_join(_per_item(cust % 4, card), "<p>ad")
    return captured_orders(spark, sf).select(
        F.concat(F.lit("html-"), key.cast("string")).alias("raw_page_id"),
        (key + 1).cast("int").alias("page"),
        F.lit(HTML_SOURCE).alias("source"),
        F.concat(
            F.lit('<!DOCTYPE html><html><head><title>Jobs</title><script>var t="<div class=job>";</script></head><body>'
                  '<div class="job">not a result</div><div id="search-results"><div id="jobs">'),
            cards, F.lit("</div></div></body></html>")).alias("content"),
        F.col("captured").alias("captured_at"))


# Expected cards: `lack` 0 no link, 1 no tags, 2 no company, 3 no city; k is the unit's index.
HTML_CARDS = f"""
card AS (SELECT *, (o_orderkey * 7 + i) % 11 AS lack, (o_orderkey + i) % 8 AS k, (o_custkey % 60 + 1)::INTEGER AS n
         FROM (SELECT *, {CAPTURED} AS captured, unnest(generate_series(1, o_custkey % 4)) AS i FROM orders)),
cards AS (SELECT 'html-' || o_orderkey AS raw_page_id, '{HTML_SOURCE}' AS source, o_orderkey + 1 AS page,
                 captured AS captured_at, i - 1 AS ordinal,
                 CASE WHEN lack <> 0 THEN 'https://itviec.com/it-jobs/' || o_custkey || '-' || i END AS url,
                 CASE WHEN lack <> 0 THEN 'Senior & role ' || o_custkey || ' x' END AS title,
                 CASE WHEN lack <> 1 THEN o_orderstatus || '|SQL' END AS tags,
                 CASE k WHEN 0 THEN captured - to_seconds(n) WHEN 1 THEN captured - to_minutes(n)
                        WHEN 2 THEN captured - to_hours(n) WHEN 3 THEN captured - to_days(n)
                        WHEN 4 THEN captured - to_weeks(n) WHEN 5 THEN captured - to_months(n) END AS posting_date,
                 CASE WHEN lack <> 2 THEN 'clerk-' || (o_custkey % 10) END AS company,
                 CASE WHEN lack <> 3 THEN o_orderpriority END AS locations,
                 [x FOR x IN [CASE WHEN lack = 0 THEN 'Missing url' END, CASE WHEN lack = 0 THEN 'Missing title' END,
                              CASE WHEN lack = 1 THEN 'Missing tags' END, CASE WHEN k > 5 THEN 'Missing posting date' END,
                              CASE WHEN lack = 2 THEN 'Missing company' END,
                              CASE WHEN lack = 3 THEN 'Missing locations' END] IF x IS NOT NULL] AS errors
          FROM card)"""


def json_list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON list page per order with 1 to 3 listings; some values have another type,
    and pages of some customers are cut short."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string")

    def hit(i: Column) -> Column:
        odd = (key * 5 + i) % 9
        alias = F.when(odd == 0, "12").otherwise(F.concat(F.lit('"role-'), cust.cast("string"), F.lit(' "')))
        skills = F.when(odd == 1, '["A",1]').otherwise(F.concat(F.lit('["A"," B","B ","'), F.col("o_orderstatus"), F.lit('"]')))
        online = (F.when(odd == 2, F.concat(F.lit(',"onlineDate":"'), seconds, F.lit('"')))
                  .when(odd == 3, "").otherwise(F.concat(F.lit(',"onlineDate":'), seconds)))
        places = F.when(odd == 4, "[]").otherwise(F.concat(F.lit('["'), F.col("o_orderpriority"), F.lit('"]')))
        return F.concat(F.lit('{"alias":'), alias, F.lit(',"jobId":'), i.cast("string"), F.lit(',"jobTitle":" Role \\u0041\\n","skills":'),
                        skills, online, F.lit(',"company":"co-'), (cust % 10).cast("string"), F.lit('","locations":'), places,
                        F.lit(',"jobSalary":0}'))

    hits = F.array_join(_per_item(cust % 3 + 1, hit), ",")
    whole = F.concat(F.lit('{"results":[{"hits":['), hits, F.lit('],"page":'), key.cast("string"), F.lit('},{"hits":[{}]}]}'))
    content = F.when(cust % 17 == 0, F.substr(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)
    return captured_orders(spark, sf).select(
        F.concat(F.lit("json-"), key.cast("string")).alias("raw_page_id"),
        (key + 1).cast("int").alias("page"),
        F.lit(JSON_SOURCE).alias("source"),
        content.alias("content"),
        (F.col("captured") + F.make_interval(hours=F.lit(1))).alias("captured_at"))


JSON_HITS = f"""
hit AS (SELECT *, (o_orderkey * 5 + i) % 9 AS odd
        FROM (SELECT *, unnest(generate_series(1, o_custkey % 3 + 1)) AS i FROM orders WHERE o_custkey % 17 <> 0)),
hits AS (SELECT 'json-' || o_orderkey AS raw_page_id, '{JSON_SOURCE}' AS source, o_orderkey + 1 AS page,
                {CAPTURED} + INTERVAL 1 HOUR AS captured_at, i - 1 AS ordinal,
                CASE WHEN odd <> 0 THEN 'https://www.vietnamworks.com/role-' || o_custkey || '-' || i || '-jv' END AS url,
                'Role A' AS title, CASE WHEN odd <> 1 THEN 'A|B|' || o_orderstatus END AS tags,
                CASE WHEN odd <> 3 THEN o_orderdate END AS posting_date, 'co-' || (o_custkey % 10) AS company,
                CASE WHEN odd <> 4 THEN o_orderpriority ELSE '' END AS locations,
                [x FOR x IN [CASE WHEN odd = 0 THEN 'Missing url' END, CASE WHEN odd = 1 THEN 'Missing tags' END,
                             CASE WHEN odd = 3 THEN 'Missing posting date' END,
                             CASE WHEN odd = 4 THEN 'Missing locations' END] IF x IS NOT NULL] AS errors
         FROM hit),
bad_json AS (SELECT 'json-' || o_orderkey AS raw_page_id, '{JSON_SOURCE}' AS source, o_orderkey + 1 AS page,
                    {CAPTURED} + INTERVAL 1 HOUR AS captured_at,
                    'Cannot parse job source as json. Failure message: malformed JSON' AS message
             FROM orders WHERE o_custkey % 17 = 0)"""

ALL_LISTINGS = f"""{HTML_CARDS},{JSON_HITS},
listings AS (SELECT * FROM cards UNION ALL SELECT * FROM hits),
sightings AS (SELECT source, url, title, tags, posting_date, company, locations, raw_page_id, captured_at, page, ordinal
              FROM listings WHERE len(errors) = 0),
failures AS (SELECT raw_page_id, source, page, ordinal, errors FROM listings WHERE len(errors) > 0
             UNION ALL SELECT raw_page_id, source, page, 0, [message] FROM bad_json)"""


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    return html_list_pages(spark, sf).unionByName(json_list_pages(spark, sf))


def flat(df: DataFrame) -> DataFrame:
    """Arrays as text and times as epoch milliseconds, so that any two engines agree."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f.name)
        if kind == "array<string>":
            c = F.array_join(c, "|")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = ts_to_epoch_ms(c)
        elif kind == "int":
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
