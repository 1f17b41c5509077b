"""JSON list pages to rows, entirely with VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist import schemas as S
from relist.functions.arrays import map_trim_set
from relist.functions.dates import epoch_s_to_ts
from relist.functions.json import is_single, json_list, json_long, json_path, json_string, json_string_set
from relist.functions.strings import build_url, trim_java

# Keys of a listing.
HIT_KEYS = ("alias", "jobTitle", "skills", "onlineDate", "company", "locations", "jobId")
PAGE_COLUMNS = ["raw_page_id", "source", "page", "captured_at"]


def explode_json_items(raw_pages: DataFrame) -> DataFrame:
    """Listings of each page in order; an unreadable page gives one item with a null hit.

    Only the first result counts; absent, empty or mistyped hits give no rows, and so does
    a page without content. Each page is parsed once: filters of later steps are on the
    exploded columns, which keeps the optimizer from parsing again in front of them.
    """
    parsed = raw_pages.where(F.col("content").isNotNull()).select(*PAGE_COLUMNS, json_list(F.col("content")).alias("_list"))
    hits = json_path(F.col("_list"), S.HITS_PATH.replace("$", "$[0]"), "array<variant>")
    unreadable = F.array(F.lit(None).cast("variant"))
    items = F.when(is_single(F.col("_list")), hits).otherwise(unreadable)
    return (parsed.select(*PAGE_COLUMNS, F.posexplode_outer(items).alias("ordinal", "hit"))
            .where(F.col("ordinal").isNotNull()))


def explode_json_hits(raw_pages: DataFrame) -> DataFrame:
    return explode_json_items(raw_pages).where(F.col("hit").isNotNull())


def json_invalid_page(raw_pages: DataFrame) -> DataFrame:
    """One error per page that is not JSON: empty fragment, one message."""
    return explode_json_items(raw_pages).where(F.col("hit").isNull()).select(
        *PAGE_COLUMNS, F.lit("").alias("raw_fragment"), _invalid_message().alias("page_error"))


def _invalid_message():
    return F.lit(S.INVALID_JSON_PREFIX + "malformed JSON")


def json_hit_fields(items: DataFrame, base_url: str = S.BASE_URLS[S.JSON_SOURCE]) -> DataFrame:
    """Posting fields of each listing, strictly typed: a value of another type is missing."""
    hit = F.col("hit")
    # Each key is looked up once; its type and value are read from what was found.
    found = items.select(*PAGE_COLUMNS, "ordinal", "hit", *[json_path(hit, f"$.{k}").alias(f"_{k}") for k in HIT_KEYS])
    alias, title, skills, online, company, places, job = (F.col(f"_{k}") for k in HIT_KEYS)
    return found.select(
        *PAGE_COLUMNS, "ordinal",
        build_url(base_url, "/", trim_java(json_string(alias, "$")), "-", json_long(job, "$").cast("string"), "-jv").alias("url"),
        trim_java(json_string(title, "$")).alias("title"),
        map_trim_set(json_string_set(skills, "$")).alias("tags"),
        epoch_s_to_ts(json_long(online, "$")).alias("posting_date"),
        trim_java(json_string(company, "$")).alias("company"),
        map_trim_set(json_string_set(places, "$")).alias("locations"),
        F.coalesce(json_fragment(hit), F.lit("")).alias("raw_fragment"),
        F.when(hit.isNull(), _invalid_message()).alias("page_error"),
    )


def json_fragment(hit):
    """A listing as text, kept as evidence on error rows."""
    return F.to_json(hit)


def extract_json_pages(raw_pages: DataFrame) -> DataFrame:
    return json_hit_fields(explode_json_items(raw_pages))
