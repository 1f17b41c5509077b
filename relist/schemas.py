"""Table schemas and the values that are fixed by the data contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Stored source names and the base addresses listing urls are built from.
HTML_SOURCE = "ItViec"
JSON_SOURCE = "VietnamWorks"
SOURCES = (HTML_SOURCE, JSON_SOURCE)
BASE_URLS = {
    HTML_SOURCE: "https://itviec.com",
    JSON_SOURCE: "https://www.vietnamworks.com",
}
COMPANY_PREFIX = "/companies/"
HITS_PER_PAGE = 50
REPOST_GAP_DAYS = 30
# Messages kept on error rows, in the order the fields are checked.
REQUIRED_FIELDS = (
    ("url", "Missing url"),
    ("title", "Missing title"),
    ("tags", "Missing tags"),
    ("posting_date", "Missing posting date"),
    ("company", "Missing company"),
    ("locations", "Missing locations"),
)
INVALID_JSON_PREFIX = "Cannot parse job source as json. Failure message: "
INVALID_HTML_PREFIX = "Cannot parse page: "
# Element paths of an HTML list page.
CARD_PATH = "#search-results #jobs div.job"
CARD_TITLE_LINK = ".job_content > .job__description > .job__body > .details > .title > a"
CARD_TAGS = ".job_content > .job__description > .job-bottom > .tag-list > a > span"
CARD_AGE = ".job_content > .city_and_posted_date > .distance-time-job-posted > span"
CARD_COMPANY_LINK = ".job_content > .logo > .logo-wrapper > a"
CARD_CITY = ".job_content > .city_and_posted_date > .city > .address > .text"
# Keys of a JSON listing.
HITS_PATH = "$.results[0].hits"
# Keys of a published message, with the column each is filled from.
MESSAGE_KEYS = (
    ("_id", "posting_id"),
    ("url", "url"),
    ("title", "title"),
    ("tags", "tags"),
    ("postingDate", "posting_date"),
    ("company", "company"),
    ("locations", "locations"),
    ("rawJobSourceName", "source"),
)
# ----------------------------------------------------------------------------


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _I, _TS = T.StringType(), T.IntegerType(), T.TimestampType()
_STRINGS, _TIMES = T.ArrayType(T.StringType()), T.ArrayType(T.TimestampType())

# nullable=False marks a required field; conform_schema enforces it.
RAW_PAGE = _struct(
    ("raw_page_id", _S, False), ("page", _I, False), ("source", _S, False),
    ("content", _S, False), ("captured_at", _TS, False),
)
POSTING = _struct(
    ("posting_id", _S, False), ("url", _S, False), ("title", _S, False), ("tags", _STRINGS, False),
    ("posting_date", _TS, False), ("other_posting_dates", _TIMES, True), ("company", _S, False),
    ("locations", _STRINGS, False), ("source", _S, False), ("raw_page_id", _S, False),
    ("created_at", _TS, True), ("modified_at", _TS, True),
)
EXTRACT_ERROR = _struct(
    ("error_id", _S, False), ("raw_fragment", _S, False), ("errors", _STRINGS, False),
    ("raw_page_id", _S, False),
)
RUN_PAGE = _struct(
    ("run_page_id", _S, False), ("source", _S, False), ("start_time", _TS, False),
    ("raw_page_id", _S, True), ("new_ids", _STRINGS, False), ("existing_ids", _STRINGS, False),
    ("error_ids", _STRINGS, False), ("run_error", _S, True), ("end_time", _TS, True),
)
POSTING_DETAIL = _struct(
    ("detail_id", _S, False), ("posting_id", _S, False), ("html", _S, True),
    ("error", _S, True), ("created_at", _TS, False),
)
# Which run a landed page belongs to, and whether that run worked on it.
PAGE_RUN = _struct(
    ("raw_page_id", _S, False), ("source", _S, False), ("run_id", _S, False), ("page", _I, False),
    ("captured_at", _TS, False), ("has_content", T.BooleanType(), False), ("processed", T.BooleanType(), False),
)
# The first page of a run that brought nothing new; later batches of the run end there too.
RUN_STOP = _struct(("source", _S, False), ("run_id", _S, False), ("stop_page", _I, False))
TABLES = {
    "raw_pages": RAW_PAGE,
    "postings": POSTING,
    "extract_errors": EXTRACT_ERROR,
    "run_pages": RUN_PAGE,
    "posting_details": POSTING_DETAIL,
}

# What every extractor returns: one row per listing element, before validation.
EXTRACTED = _struct(
    ("raw_page_id", _S, False), ("source", _S, False), ("page", _I, False),
    ("captured_at", _TS, False), ("ordinal", _I, False), ("url", _S, True), ("title", _S, True),
    ("tags", _STRINGS, True), ("posting_date", _TS, True), ("company", _S, True),
    ("locations", _STRINGS, True), ("raw_fragment", _S, True), ("page_error", _S, True),
)

KEYS = ["source", "url"]
# Arrival order of listings: capture time, then page, then position in the page.
# posting_date only separates rows that are otherwise the same arrival.
ARRIVAL = ["captured_at", "page", "ordinal", "posting_date"]


@dataclass(frozen=True)
class SourceSpec:
    """What one source contributes: its name, base address, page format and extractor."""

    name: str
    base_url: str
    page_format: str
    extractor: object
