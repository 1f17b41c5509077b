"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from relist.functions import arrays as A
from relist.functions import dates as D
from relist.functions import json as J
from relist.functions import strings as X
from relist_queries.base import query, table
from relist_queries.frames import ORDER_POSTINGS, flat, order_postings, sql_id


@query("trim_java", f"""
SELECT conv_id, turn, regexp_replace(chr(9) || ' ' || text || chr(10) || chr(13) || chr(1), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')
       AS trimmed FROM conversations""")
def trim_java(spark, sf):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit("\n\r\x01"))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.trim_java(padded).alias("trimmed"))


@query("strip_prefix", """
SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substring(url, 9) ELSE url END AS stripped FROM pages""")
def strip_prefix(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_prefix(F.col("url"), "https://").alias("stripped"))


@query("lower", "SELECT p_partkey, lower(p_brand || ' ' || p_type) AS lowered FROM part")
def lower(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.lower(F.concat_ws(" ", "p_brand", "p_type")).alias("lowered"))


@query("regex_capture", """
SELECT page_id, CASE WHEN regexp_matches(url, '^(https?)://([^/]+)/([a-z]+)/') THEN
       regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/', 2) END AS host,
       CASE WHEN regexp_matches(url, '^(https?)://([^/]+)/([a-z]+)/') THEN
       regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/', 3) END AS lang FROM pages""")
def regex_capture(spark, sf):
    pattern = "^(https?)://([^/]+)/([a-z]+)/"
    return table(spark, sf, "pages").select(
        "page_id", X.regex_capture(F.col("url"), pattern, 2).alias("host"), X.regex_capture(F.col("url"), pattern, 3).alias("lang"))


@query("build_url", """
SELECT p_partkey, 'https://listings.example.com/' || p_name || '-' || p_partkey || '-jv' AS url FROM part""")
def build_url(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.build_url(
        "https://listings.example.com", "/", F.col("p_name"), "-", F.col("p_partkey").cast("string"), "-jv").alias("url"))


@query("parse_int", """
SELECT event_id, coalesce(try_cast(replace(replace(props, '{"k": ', ''), '}', '') || repeat('0', (event_id % 10)::INTEGER)
       AS INTEGER), -1)::BIGINT AS parsed FROM events""")
def parse_int(spark, sf):
    digits = F.concat(F.regexp_extract("props", r"(\d+)", 1), F.repeat(F.lit("0"), (F.col("event_id") % 10).cast("int")))
    return flat(table(spark, sf, "events").select("event_id", F.coalesce(X.parse_int(digits), F.lit(-1)).alias("parsed")))


@query("hex_id", f"SELECT o_orderkey, {sql_id('o_orderpriority', 'o_custkey', 'epoch_ms(o_orderdate)')} AS id FROM orders")
def hex_id(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.hex_id(
        F.col("o_orderpriority"), F.col("o_custkey"), D.ts_to_epoch_ms(F.col("o_orderdate"))).alias("id"))


@query("relative_age_to_ts", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
       epoch_ms(CASE l_linenumber WHEN 1 THEN l_shipdate - to_seconds(n) WHEN 2 THEN l_shipdate - to_minutes(n)
                WHEN 3 THEN l_shipdate - to_hours(n) WHEN 4 THEN l_shipdate - to_days(n) WHEN 5 THEN l_shipdate - to_weeks(n)
                WHEN 6 THEN l_shipdate - to_months(n) END) AS posted_ms
FROM (SELECT *, l_quantity::INTEGER AS n FROM lineitem) WHERE l_linenumber < 7
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, -1 FROM lineitem WHERE l_linenumber >= 7""")
def relative_age_to_ts(spark, sf):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("second", "Minutes", "hours", "DAYS", " weeks", "month", "years")]),
                        F.least(F.col("l_linenumber"), F.lit(7)))
    text = F.concat(F.lit("\t"), F.col("l_quantity").cast("int").cast("string"), unit, F.lit(" ago\n"))
    posted = D.relative_age_to_ts(text, F.col("l_shipdate"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        F.coalesce(D.ts_to_epoch_ms(posted), F.lit(-1).cast("bigint")).alias("posted_ms"))


@query("epoch_s_to_ts", """
SELECT o_orderkey, strftime(to_timestamp(epoch(o_orderdate)::BIGINT + o_custkey) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ts FROM orders""")
def epoch_s_to_ts(spark, sf):
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(D.epoch_s_to_ts(seconds), "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("ts_to_epoch_ms", "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events")
def ts_to_epoch_ms(spark, sf):
    return table(spark, sf, "events").select("event_id", D.ts_to_epoch_ms(F.col("ts")).alias("ts_ms"))


@query("epoch_ms_to_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts FROM events")
def epoch_ms_to_ts(spark, sf):
    back = D.epoch_ms_to_ts(D.ts_to_epoch_ms(F.col("ts")))
    return table(spark, sf, "events").select("event_id", F.date_format(back, "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"))


@query("parse_iso", "SELECT event_id, epoch_us(date_trunc('second', ts)) AS ts_us FROM events")
def parse_iso(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00[Asia/Ho_Chi_Minh]"))
    return table(spark, sf, "events").select(
        "event_id", F.unix_micros(D.parse_iso(text).cast("timestamp")).alias("ts_us"))


@query("try_parse_iso", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(date_trunc('minute', ts)) ELSE -1 END AS ts_us
FROM events""")
def try_parse_iso(spark, sf):
    kind = F.col("event_id") % 4
    text = (F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).when(kind == 2, F.date_format("ts", "yyyy-MM-dd"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    micros = F.unix_micros(D.try_parse_iso(text).cast("timestamp"))
    return table(spark, sf, "events").select("event_id", F.coalesce(micros, F.lit(-1).cast("bigint")).alias("ts_us"))


@query("now", """
SELECT event_id, epoch_ms(TIMESTAMP '2024-02-01 09:00:00.123') AS now_ms,
       epoch_ms(TIMESTAMP '2024-02-01 09:00:00.123') - epoch_us(ts) // 1000 AS age_ms FROM events""")
def now(spark, sf):
    now_ms = D.ts_to_epoch_ms(D.run_time("2024-02-01 09:00:00.123456"))
    return table(spark, sf, "events").select("event_id", now_ms.alias("now_ms"), (now_ms - D.ts_to_epoch_ms(F.col("ts"))).alias("age_ms"))


@query("now_ms", """
SELECT event_type, epoch_ms(TIMESTAMP '2024-02-01 09:00:00.123') AS now_ms, count(*) AS n_events FROM events GROUP BY event_type""")
def now_ms(spark, sf):
    """One clock reading for all rows of a run."""
    read = D.ts_to_epoch_ms(D.run_time("2024-02-01 09:00:00.123456")).alias("now_ms")
    return table(spark, sf, "events").select("event_type", read).groupBy("event_type", "now_ms").agg(F.count(F.lit(1)).alias("n_events"))


@query("at_least_n_days_after", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate >= o_orderdate + INTERVAL 30 DAY AS later
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def at_least_n_days_after(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        D.at_least_n_days_after(F.col("l_shipdate"), F.col("o_orderdate"), 30).alias("later"))


@query("array_to_set", """
SELECT doc_id, len(list_distinct(string_split(text, ' '))) AS n_words FROM documents""")
def array_to_set(spark, sf):
    return flat(table(spark, sf, "documents").select(
        "doc_id", F.size(A.array_to_set(F.split("text", " "))).alias("n_words")))


@query("map_trim_set", """
SELECT p_partkey, array_to_string(list_sort(list_distinct([p_brand, p_type, p_name])), '|') AS tags FROM part""")
def map_trim_set(spark, sf):
    raw = F.array(F.concat(F.lit(" "), "p_brand"), F.concat("p_type", F.lit("\t")), "p_name", F.concat("p_brand", F.lit("\n")))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(F.array_sort(A.map_trim_set(raw)), "|").alias("tags"))


@query("singleton_set", """
SELECT doc_id, quality IS NULL AS is_null, coalesce(quality, -1)::BIGINT AS first FROM documents LEFT JOIN labels USING (doc_id)""")
def singleton_set(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    one = A.singleton_set(F.col("quality"))
    return flat(rows.select("doc_id", one.isNull().alias("is_null"), F.coalesce(F.get(one, F.lit(0)), F.lit(-1)).alias("first")))


@query("array_append", """
SELECT posting_id, array_to_string(list_append(tags, tags[1]), '|') AS tags FROM (
WITH """ + ORDER_POSTINGS + " SELECT * FROM postings)")
def array_append(spark, sf):
    return flat(order_postings(spark, sf).select("posting_id", A.append(F.col("tags"), F.col("tags")[0]).alias("tags")))


@query("array_all_empty", """
SELECT doc_id, lang = 'en' OR length(text) < 100 AS is_empty FROM documents""")
def array_all_empty(spark, sf):
    words = F.when(F.col("lang") == "en", F.array().cast("array<string>")).when(F.length("text") >= 100, F.split("text", " "))
    return table(spark, sf, "documents").select("doc_id", A.array_all_empty(words).alias("is_empty"))


@query("flat_map_ids", """
SELECT doc_id, array_to_string([x FOR x IN [quality, toxic] IF x IS NOT NULL], '|') AS ids
FROM documents LEFT JOIN labels USING (doc_id)""")
def flat_map_ids(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return flat(rows.select("doc_id", A.flat_map_ids(F.array("quality", "toxic")).cast("array<string>").alias("ids")))


@query("array_exists", """
SELECT doc_id, len([w FOR w IN string_split(text, ' ') IF length(w) > 15]) > 0 AS has_long_word FROM documents""")
def array_exists(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", A.array_exists(F.split("text", " "), lambda w: F.length(w) > 15).alias("has_long_word"))


@query("json_parse", """
SELECT event_id, event_id % 5 IN (0, 4) AS ok FROM events""")
def json_parse(spark, sf):
    kind = F.col("event_id") % 5
    text = (F.when(kind == 0, F.col("props")).when(kind == 1, F.concat("props", F.lit(" x"))).when(kind == 2, F.concat("props", "props"))
            .when(kind == 3, F.substr("props", F.lit(1), F.length("props") - 1)).otherwise(F.lit("null")))
    return table(spark, sf, "events").select("event_id", J.json_parse(text).isNotNull().alias("ok"))


@query("json_path", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_path(spark, sf):
    return table(spark, sf, "events").select("event_id", J.json_path(J.json_parse(F.col("props")), "$.k", "bigint").alias("k"))


@query("json_get_typed", """
SELECT event_id, CASE WHEN event_id % 4 IN (0, 1, 2) THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE -1 END AS as_long,
       CASE WHEN event_id % 4 = 1 THEN json_extract_string(props, '$.k') ELSE '-' END AS as_string FROM events""")
def json_get_typed(spark, sf):
    k, kind = F.regexp_extract("props", r"(\d+)", 1), F.col("event_id") % 4
    text = F.concat(F.lit('{"k":'), F.when(kind == 0, k).when(kind == 1, F.concat(F.lit('"'), k, F.lit('"')))
                    .when(kind == 2, F.concat(k, F.lit(".0"))).otherwise(F.concat(k, F.lit(".5"))), F.lit("}"))
    value = J.json_parse(text)
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(J.json_long(value, "$.k"), F.lit(-1).cast("bigint")).alias("as_long"),
        F.coalesce(J.json_string(value, "$.k"), F.lit("-")).alias("as_string"))


@query("json_object_encode", """
SELECT o_orderkey, to_json({'id': o_orderkey, 'status': o_orderstatus, 'tags': [o_orderpriority, o_orderstatus]})::VARCHAR AS value
FROM orders""")
def json_object_encode(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", J.json_object_encode([
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags")]).alias("value"))
