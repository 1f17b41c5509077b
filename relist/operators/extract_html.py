"""HTML list pages to rows. Python only finds elements; all cleaning is done by columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import relist
from relist import schemas as S
from relist.functions.arrays import map_trim_set, singleton_set
from relist.functions.dates import relative_age_to_ts
from relist.functions.strings import build_url, strip_prefix, trim_java
from relist.operators.html_elements import TOKEN, Element, Page, Walker

# The helper travels with the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(relist)


class HtmlField(NamedTuple):
    """A value read inside each matched element.

    path None reads the element itself. what: 'text', 'outer' or '@attribute' (an absent
    attribute reads as ''). every=True gives all matches as an array; an absent element
    gives null either way.
    """

    name: str
    path: str | None = None
    what: str = "text"
    every: bool = False


def html_rows(content: Column, root: str, fields: Sequence[HtmlField], error: str | None = None) -> Column:
    """All elements matching `root`, in page order, as an array of structs of the fields.

    With `error` the structs have a field of that name behind the others, null in all that is found; a page that cannot be read gives
    one struct with the reason in it and nothing else. Without it such a page fails the query, as no result would tell it from a page.
    """
    strings = T.ArrayType(T.StringType())
    row = T.StructType([T.StructField(f.name, strings if f.every else T.StringType()) for f in fields])
    kinds = [pa.list_(pa.string()) if f.every else pa.string() for f in fields]
    names = [f.name for f in fields]
    if error is not None:
        row, kinds, names = row.add(error, T.StringType()), [*kinds, pa.string()], [*names, error]
    rest = [] if error is None else [None]
    walker = Walker(root, [f.path for f in fields])

    def read(pieces: list[str], found: list[Element], field: HtmlField):
        if not found:
            return None
        if field.every:
            return [x.read(pieces, field.what, walker.seen) for x in found]
        return found[0].read(pieces, field.what, walker.seen)

    def read_page(page: Page, found: list[int], field: HtmlField):
        if not found:
            return None
        return [page.read(j, field.what) for j in found] if field.every else page.read(found[0], field.what)

    def rows(html: str) -> list[list]:
        try:
            pieces = TOKEN.split(html)
            found = walker.find(pieces)
            if found is not None:
                return [[read(pieces, x, f) for x, f in zip(each, fields)] + rest for each in found]
            page = Page(html, walker.seen)
            return [[read_page(page, x, f) for x, f in zip(each, fields)] + rest for _, each in walker.finder.find(page)]
        except Exception as e:  # whatever it was, it must not look like a listing
            message = f"{S.INVALID_HTML_PREFIX}{type(e).__name__}: {e}"
            if error is None:
                raise ValueError(message) from e
            return [[*[None] * len(fields), message]]

    @F.arrow_udf(T.ArrayType(row))
    def extract(contents: pa.Array) -> pa.Array:
        columns, ends = [[] for _ in names], [0]
        for html in contents.to_pylist():
            for values in [] if html is None else rows(html):
                for column, value in zip(columns, values):
                    column.append(value)
            ends.append(len(columns[0]))
        structs = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs, mask=contents.is_null())

    return extract(content)


def extract_html(df: DataFrame, root: str, fields: Sequence[HtmlField], content: str = "content", error: str | None = None) -> DataFrame:
    """One row per element matching `root`: position in the page plus the fields, and `error` as in html_rows.

    Only the page text crosses to Python; the other columns stay in the JVM. A page
    without a match gives no row.
    """
    others = [c for c in df.columns if c != content]
    found = df.select(*others, html_rows(F.col(content), root, fields, error).alias("_rows"))
    # The outer form with a filter behind it: for the inner form the optimizer adds a filter
    # on the array in front, and the extractor would run for that as well.
    return (found.select(*others, F.posexplode_outer("_rows").alias("ordinal", "_row"))
            .where(F.col("ordinal").isNotNull()).select(*others, "ordinal", "_row.*"))


def html_select_all(content: Column, css: str, what: str = "text") -> Column:
    """Texts (or an attribute) of all elements matching a path, empty where none does."""
    return F.transform(html_rows(content, css, [HtmlField("value", None, what)]), lambda r: r["value"])


def html_select_first(content: Column, css: str, what: str = "text") -> Column:
    return F.get(html_select_all(content, css, what), F.lit(0))


def html_body(html: Column) -> Column:
    """Body element of a page, up to the last closing tag or the end of the page.

    A page without a body tag gets one around whatever follows its head.
    """
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>.*</body\s*>|<body\b[^>]*>.*\z", 0)
    bare = F.regexp_replace(html, r"(?is)^.*</head\s*>|<!doctype[^>]*>|</?html\b[^>]*>", "")
    return F.when(F.length(body) > 0, body).otherwise(F.concat(F.lit("<body>"), bare, F.lit("</body>")))


CARD_FIELDS = (
    HtmlField("href_raw", S.CARD_TITLE_LINK, "@href"),
    HtmlField("title_raw", S.CARD_TITLE_LINK),
    HtmlField("tags_raw", S.CARD_TAGS, every=True),
    HtmlField("age_raw", S.CARD_AGE),
    HtmlField("company_href_raw", S.CARD_COMPANY_LINK, "@href"),
    HtmlField("city_raw", S.CARD_CITY),
    HtmlField("raw_fragment", None, "outer"),
)


def explode_html_cards(raw_pages: DataFrame) -> DataFrame:
    """One row per listing card of an HTML list page, with the raw strings of its parts; `page_error` is null.

    A page that cannot be read gives one row with the reason in `page_error` and no parts; see only_cards.
    """
    return extract_html(raw_pages, S.CARD_PATH, CARD_FIELDS, error="page_error")


def only_cards(rows: DataFrame) -> DataFrame:
    """`rows` without their page_error, for readers that have no place for it: a page that could not be read fails the query."""
    failed = F.raise_error(F.concat_ws(" ", "raw_page_id", "page_error")).cast("boolean")
    return rows.where(F.when(F.col("page_error").isNull(), F.lit(True)).otherwise(failed)).drop("page_error")


def html_card_fields(cards: DataFrame, base_url: str = S.BASE_URLS[S.HTML_SOURCE]) -> DataFrame:
    """Clean the raw strings of a card into posting fields (url is trimmed, then stripped of
    its slash; the company path is stripped, then trimmed)."""
    return cards.select(
        "raw_page_id", "source", "page", "captured_at", "ordinal",
        build_url(base_url, "/", strip_prefix(trim_java(F.col("href_raw")), "/")).alias("url"),
        trim_java(F.col("title_raw")).alias("title"),
        map_trim_set(F.col("tags_raw")).alias("tags"),
        relative_age_to_ts(F.col("age_raw"), F.col("captured_at")).alias("posting_date"),
        trim_java(strip_prefix(F.col("company_href_raw"), S.COMPANY_PREFIX)).alias("company"),
        singleton_set(trim_java(F.col("city_raw"))).alias("locations"),
        F.when(F.col("page_error").isNull(), F.col("raw_fragment")).otherwise("").alias("raw_fragment"),
        "page_error",
    )


def extract_html_pages(raw_pages: DataFrame) -> DataFrame:
    """Posting fields of all cards of a page table, where the pages are: their texts are not moved.

    Landing spreads them over files, see sinks.tables.write_batch.
    """
    return html_card_fields(explode_html_cards(raw_pages))
