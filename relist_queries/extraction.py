"""Pages to rows: HTML cards, JSON listings, validation and dispatch."""

from __future__ import annotations

from pyspark.sql import functions as F

from relist import schemas as S
from relist.operators import extract_html as H
from relist.operators import extract_json as J
from relist.operators import parsers
from relist.operators import registry as R
from relist.operators import validate as V
from relist_queries.base import query, table
from relist_queries.frames import (
    ALL_LISTINGS, HTML_CARDS, JSON_HITS, flat, html_list_pages, json_list_pages, list_pages,
)

FIELDS = ("raw_page_id", "source", "page", "captured_at", "ordinal", "url", "title", "tags", "posting_date", "company", "locations")
SQL_FIELDS = """raw_page_id, source, page, epoch_ms(captured_at) AS captured_at, ordinal, url, title, tags,
       coalesce(epoch_ms(posting_date), -1) AS posting_date, company, locations"""


def _shown(rows):
    ms = F.coalesce(F.unix_millis("posting_date"), F.lit(-1).cast("bigint"))
    return flat(rows.select(*FIELDS).withColumn("posting_date", ms))


def _page_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.col("html").alias("content"))


# The elements tested below are leaves, so patterns find them in SQL.
def _decoded(expr):
    for entity, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        expr = f"replace({expr}, '{entity}', '{char}')"
    return f"trim(regexp_replace({expr}, '[ \\t\\n\\f\\r]+', ' ', 'g'))"


@query("explode_html_cards", f"""
WITH {HTML_CARDS}
SELECT raw_page_id, ordinal, CASE WHEN lack <> 0 THEN ' /it-jobs/' || o_custkey || '-' || i END AS href_raw, title AS title_raw,
       CASE WHEN lack <> 1 THEN o_orderstatus || '|SQL|' || o_orderstatus END AS tags_raw,
       CASE WHEN lack <> 2 THEN '/companies/clerk-' || (o_custkey % 10) || ' ' END AS company_href_raw, locations AS city_raw
FROM cards JOIN (SELECT 'html-' || o_orderkey AS raw_page_id, i - 1 AS ordinal, lack, o_custkey, i, o_orderstatus FROM card)
     USING (raw_page_id, ordinal)""")
def explode_html_cards(spark, sf):
    return flat(H.only_cards(H.explode_html_cards(html_list_pages(spark, sf))).select(
        "raw_page_id", "ordinal", "href_raw", "title_raw", "tags_raw", "company_href_raw", "city_raw"))


@query("html_card_fields", f"WITH {HTML_CARDS} SELECT {SQL_FIELDS} FROM cards")
def html_card_fields(spark, sf):
    return _shown(H.only_cards(H.extract_html_pages(html_list_pages(spark, sf))))


@query("card_ordinal", f"WITH {HTML_CARDS} SELECT raw_page_id, ordinal, url FROM cards")
def card_ordinal(spark, sf):
    return flat(H.only_cards(H.extract_html_pages(html_list_pages(spark, sf))).select("raw_page_id", "ordinal", "url"))


@query("html_select_all", f"""
SELECT page_id, array_to_string([{_decoded('x')} FOR x IN regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)], '|') AS links FROM pages""")
def html_select_all(spark, sf):
    return _page_html(spark, sf).select(
        "page_id", F.array_join(H.html_select_all(F.col("content"), "nav > ul > li > a"), "|").alias("links"))


@query("html_select_first", f"""
SELECT page_id, {_decoded('''regexp_extract(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)''')} AS first_link FROM pages""")
def html_select_first(spark, sf):
    return _page_html(spark, sf).select("page_id", H.html_select_first(F.col("content"), "nav li a").alias("first_link"))


@query("first_result", f"""
SELECT page_id, {_decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS h1, '' AS h1_id FROM pages""")
def first_result(spark, sf):
    h1 = H.html_rows(F.col("content"), "body h1", [H.HtmlField("text"), H.HtmlField("id", None, "@id")])
    rows = _page_html(spark, sf).select("page_id", F.get(h1, F.lit(0)).alias("r"))
    return rows.select("page_id", F.col("r.text").alias("h1"), F.col("r.id").alias("h1_id"))


@query("html_attr", f"""
SELECT page_id, array_to_string([replace(x, '&amp;', '&') FOR x IN regexp_extract_all(html, '<li><a href="([^"]*)">', 1)], '|') AS hrefs,
       regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, '' AS missing FROM pages""")
def html_attr(spark, sf):
    rows = _page_html(spark, sf).select(
        "page_id", F.get(H.html_rows(F.col("content"), "html", [
            H.HtmlField("hrefs", "li a", "@href", every=True), H.HtmlField("lang", None, "@lang"), H.HtmlField("missing", None, "@dir")]), F.lit(0)).alias("page"))
    none = F.array().cast("array<string>")
    return flat(rows.select("page_id", F.coalesce("page.hrefs", none).alias("hrefs"), "page.lang", "page.missing"))


@query("html_text", f"""
SELECT page_id, {_decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS h1,
       {_decoded("regexp_extract(html, '<footer>([^<]*)</footer>', 1)")} AS footer FROM pages""")
def html_text(spark, sf):
    fields = [H.HtmlField("h1", "article > h1"), H.HtmlField("footer", "footer")]
    rows = _page_html(spark, sf).select("page_id", F.get(H.html_rows(F.col("content"), "body", fields), F.lit(0)).alias("r"))
    return rows.select("page_id", "r.*")


@query("html_outer", """
SELECT page_id, regexp_extract(html, '<h1>[^<]*</h1>') AS h1, regexp_extract(html, '<nav>.*</nav>') AS nav FROM pages""")
def html_outer(spark, sf):
    fields = [H.HtmlField("h1", "h1", "outer"), H.HtmlField("nav", "nav", "outer")]
    rows = _page_html(spark, sf).select("page_id", F.get(H.html_rows(F.col("content"), "body", fields), F.lit(0)).alias("r"))
    return rows.select("page_id", "r.*")


@query("html_body", r"""
SELECT page_id, CASE WHEN contains(html, '</body>') THEN regexp_extract(html, '(?s)<body[^>]*>.*</body>')
       ELSE regexp_extract(html, '(?s)<body[^>]*>.*$') END AS body FROM pages""")
def html_body(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.html_body(F.col("html")).alias("body"))


@query("explode_json_hits", f"""
WITH {JSON_HITS} SELECT raw_page_id, source, page, epoch_ms(captured_at) AS captured_at, ordinal FROM hits""")
def explode_json_hits(spark, sf):
    return flat(J.explode_json_hits(json_list_pages(spark, sf)).drop("hit"))


@query("json_hit_fields", f"WITH {JSON_HITS} SELECT {SQL_FIELDS} FROM hits")
def json_hit_fields(spark, sf):
    return _shown(J.json_hit_fields(J.explode_json_hits(json_list_pages(spark, sf))))


@query("json_invalid_page", f"""
WITH {JSON_HITS} SELECT raw_page_id, source, page, epoch_ms(captured_at) AS captured_at, '' AS raw_fragment, message AS page_error FROM bad_json""")
def json_invalid_page(spark, sf):
    return flat(J.json_invalid_page(json_list_pages(spark, sf)))


@query("json_fragment", f"""
WITH {JSON_HITS}
SELECT raw_page_id, ordinal, '{{"alias":' || CASE WHEN odd = 0 THEN '12' ELSE '"role-' || o_custkey || ' "' END || ',"company":"co-' || (o_custkey % 10)
       || '","jobId":' || i || ',"jobSalary":0,"jobTitle":" Role A\\n","locations":'
       || CASE WHEN odd = 4 THEN '[]' ELSE '["' || o_orderpriority || '"]' END
       || CASE WHEN odd = 2 THEN ',"onlineDate":"' || epoch(o_orderdate)::BIGINT || '"' WHEN odd = 3 THEN ''
               ELSE ',"onlineDate":' || epoch(o_orderdate)::BIGINT END
       || ',"skills":' || CASE WHEN odd = 1 THEN '["A",1]' ELSE '["A"," B","B ","' || o_orderstatus || '"]' END || '}}' AS fragment
FROM (SELECT 'json-' || o_orderkey AS raw_page_id, i - 1 AS ordinal, * FROM hit)""")
def json_fragment(spark, sf):
    return flat(J.explode_json_hits(json_list_pages(spark, sf)).select(
        "raw_page_id", "ordinal", J.json_fragment(F.col("hit")).alias("fragment")))


@query("required_fields_check", f"""
WITH {ALL_LISTINGS}
SELECT raw_page_id, ordinal, array_to_string(errors, '|') AS errors FROM listings
UNION ALL SELECT raw_page_id, 0, message FROM bad_json""")
def required_fields_check(spark, sf):
    checked = V.required_fields_check(R.extract_pages(list_pages(spark, sf)))
    return flat(checked.select("raw_page_id", "ordinal", "errors"))


@query("route_valid", f"""
WITH {ALL_LISTINGS}
SELECT {SQL_FIELDS} FROM listings WHERE len(errors) = 0""")
def route_valid(spark, sf):
    return _shown(V.route_valid(V.required_fields_check(R.extract_pages(list_pages(spark, sf)))))


@query("route_errors", f"""
WITH {ALL_LISTINGS}
SELECT left(sha256(concat_ws(chr(1), raw_page_id, ordinal, 'error')), 24) AS error_id, array_to_string(errors, '|') AS errors, raw_page_id
FROM failures""")
def route_errors(spark, sf):
    errors = V.route_errors(V.required_fields_check(R.extract_pages(list_pages(spark, sf))))
    return flat(errors.drop("raw_fragment"))


@query("empty_page_guard", f"""
WITH {HTML_CARDS}
SELECT 'html-' || o_orderkey AS page_key, o_custkey % 4 AS n_cards FROM orders
UNION ALL SELECT url, 0 FROM pages""")
def empty_page_guard(spark, sf):
    lists = html_list_pages(spark, sf).select(F.col("raw_page_id").alias("page_key"), "content")
    others = table(spark, sf, "pages").select(F.col("url").alias("page_key"), F.col("html").alias("content"))
    cards = F.size(H.html_rows(F.col("content"), S.CARD_PATH, [H.HtmlField("text")]))
    return flat(lists.unionByName(others).select("page_key", cards.alias("n_cards")))


@query("extractor_registry", f"""
WITH {ALL_LISTINGS}
SELECT source, count(*) AS n_rows, count(url) AS n_urls FROM
  (SELECT source, url FROM listings UNION ALL SELECT source, NULL FROM bad_json) GROUP BY source""")
def extractor_registry(spark, sf):
    return R.extract_pages(list_pages(spark, sf)).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("url").alias("n_urls"))


@query("source_spec", """
SELECT 'event ' || event_type AS source, 'https://' || event_type || '.example.com/' || CAST(json_extract(props, '$.k') AS BIGINT) AS url,
       event_id + 1 AS page FROM events""")
def source_spec(spark, sf):
    """Sources of one's own, one for each type of event, each with its base address and extractor."""
    def spec(name: str) -> S.SourceSpec:
        base = f"https://{name}.example.com"

        def extract(pages):
            k = F.try_variant_get(F.try_parse_json("content"), "$.k", "bigint").cast("string")
            values = {"ordinal": F.lit(0), "url": F.concat(F.lit(base + "/"), k)}
            return pages.select(*[values.get(f.name, F.col(f.name) if f.name in pages.columns else F.lit(None)).cast(f.dataType)
                                  .alias(f.name) for f in S.EXTRACTED.fields])
        return S.SourceSpec(f"event {name}", base, "json", extract)

    kinds = [r.event_type for r in table(spark, sf, "events").select("event_type").distinct().collect()]
    specs = {s.name: s for s in map(spec, sorted(kinds))}
    pages = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("raw_page_id"), (F.col("event_id") + 1).cast("int").alias("page"),
        F.concat(F.lit("event "), "event_type").alias("source"), F.col("props").alias("content"),
        F.col("ts").cast("timestamp").alias("captured_at"))
    return flat(R.extract_pages(pages, specs).select("source", "url", "page"))


def _feed_pages(spark, sf):
    """One page per customer, a line per order; where the order key is a multiple of 13 the line is cut short."""
    key = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 13 == 0, key).otherwise(F.concat_ws(
        ";", F.concat(F.lit("/o/"), key), F.concat(F.lit(" "), "o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.concat("o_orderstatus", F.lit(", x,x"))),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.lit("c"), F.col("o_custkey").cast("string"))))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"])
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(lines, "\n").alias("content")).select(
        F.col("o_custkey").cast("string").alias("raw_page_id"), F.col("o_custkey").cast("int").alias("page"), F.lit("Feed").alias("source"),
        "content", F.lit("2024-01-01").cast("timestamp").alias("captured_at"))


@query("extractor_table_function", """
WITH lines AS (SELECT *, row_number() OVER w - 1 AS ordinal,
                      coalesce(bool_or(o_orderkey % 13 = 0) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS behind
               FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey AS page, ordinal, CASE WHEN ok THEN 'https://feed.example.com/o/' || o_orderkey END AS url, CASE WHEN ok THEN o_orderpriority END AS title,
       CASE WHEN ok AND o_orderstatus <> 'F' THEN o_orderstatus || '|x' END AS tags, CASE WHEN ok THEN epoch_ms(o_orderdate) END AS posting_date,
       CASE WHEN ok THEN 'c' || o_custkey END AS company,
       concat_ws('|', CASE WHEN NOT ok THEN 'unreadable' END,
                 CASE WHEN ok AND o_orderstatus = 'F' THEN 'Missing tags' END) AS errors
FROM (SELECT *, o_orderkey % 13 <> 0 AS ok FROM lines WHERE NOT behind)""")
def extractor_table_function(spark, sf):
    """A third source: its parser is a table function, its pages go through extraction and the checks like all others."""
    def feed(content):
        """Listings of a feed page: a line each, its parts behind semicolons; an empty part is missing."""
        for line in content.split("\n"):
            path, title, tags, date, company = (x or None for x in line.split(";"))
            yield {"url": path, "title": title, "tags": tags and tags.split(","), "posting_date": date, "company": company, "locations": ["C"],
                   "raw_fragment": line}

    spark.udtf.register("parse_feed", parsers.table_parser(feed))
    base = "https://feed.example.com"
    specs = {"Feed": S.SourceSpec("Feed", base, "text", parsers.table_extractor("parse_feed", base))}
    rows = V.required_fields_check(R.extract_pages(_feed_pages(spark, sf), specs))
    errors = F.when(F.col("page_error").isNotNull(), F.array(F.lit("unreadable"))).otherwise(F.col("errors"))
    return flat(rows.select("page", "ordinal", "url", "title", "tags", "posting_date", "company", errors.alias("errors")))


@query("build_record", """
SELECT doc_id, array_to_string([x FOR x IN [CASE WHEN quality IS NULL THEN 'Missing quality' END,
       CASE WHEN lang <> 'en' THEN 'Not English: ' || lang END, CASE WHEN n_chars < 100 THEN 'Too short' END] IF x IS NOT NULL], '|') AS errors
FROM documents LEFT JOIN labels USING (doc_id)""")
def build_record(spark, sf):
    """The shared validation builder with checks of one's own."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    errors = V.required_fields([
        (F.col("quality").isNull(), "Missing quality"),
        (F.col("lang") != "en", F.concat(F.lit("Not English: "), "lang")),
        (F.col("n_chars") < 100, "Too short")])
    return flat(rows.select("doc_id", errors.alias("errors")))
