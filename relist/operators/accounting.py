"""What a run did, per page and in total."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.functions.dates import run_time
from relist.functions.strings import hex_id
from relist.operators.reconcile import EXISTING, NEW, REPOSTED
from relist.sources.tables import dedupe_last_by_key


def _count(condition):
    return F.count_if(F.coalesce(condition, F.lit(False)))


def outcome_counts(tagged: DataFrame, *by: str) -> DataFrame:
    outcome = F.col("outcome")
    return tagged.groupBy(*by).agg(
        _count(outcome.isin(NEW, REPOSTED)).alias("n_new"), _count(outcome == EXISTING).alias("n_existing"))


def page_outcome_counts(tagged: DataFrame, errors: DataFrame, by: str = "raw_page_id") -> DataFrame:
    """New, existing and error counts per page; a page with only errors is listed too.

    Both inputs are counted before they meet, so the join sees one row per page.
    """
    failed = errors.groupBy(by).agg(F.count(F.lit(1)).alias("n_errors"))
    zero = F.lit(0).cast("bigint")
    return outcome_counts(tagged, by).join(failed, by, "full").select(
        by, *[F.coalesce(c, zero).alias(c) for c in ("n_new", "n_existing", "n_errors")])


#: Updated, inserted and failed listings of a run.
TOTALS = ("n_updated", "n_inserted", "n_errors")


def replay_totals(page_counts: DataFrame) -> DataFrame:
    """Updated, inserted and failed listings over all pages."""
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    return page_counts.agg(total("n_existing").alias("n_updated"), total("n_new").alias("n_inserted"),
                           total("n_errors").alias("n_errors"))


def run_accumulate(tagged: DataFrame, start_page: int = 1, end_page: int | None = None,
                   by: tuple[str, ...] = ("source",)) -> DataFrame:
    """Result of a run per source: its parameters and how many new and existing postings
    it met. The records themselves stay rows, see run_records."""
    return outcome_counts(tagged, *by).select(
        *by, F.lit(start_page).alias("start_page"), F.lit(end_page).cast("int").alias("end_page"), "n_new", "n_existing")


def run_records(tagged: DataFrame) -> DataFrame:
    """The records of a run in long form: which list each belongs to, and its place."""
    return tagged.select(
        "source", F.when(F.col("outcome") == EXISTING, F.lit(EXISTING)).otherwise(F.lit(NEW)).alias("list"),
        "page", "ordinal", "posting_id", "url")


def run_page_ids(tagged: DataFrame, errors: DataFrame, by: str = "raw_page_id") -> DataFrame:
    """Id lists per page, sorted. A page is one stored text, so its lists are as small."""
    outcome, ident = F.col("outcome"), F.col("posting_id")
    ids = tagged.select(by, "outcome", "posting_id").repartition(by).groupBy(by).agg(
        F.sort_array(F.collect_list(F.when(outcome.isin(NEW, REPOSTED), ident))).alias("new_ids"),
        F.sort_array(F.collect_list(F.when(outcome == EXISTING, ident))).alias("existing_ids"))
    failed = errors.select(by, "error_id").repartition(by).groupBy(by).agg(F.sort_array(F.collect_list("error_id")).alias("error_ids"))
    empty = F.array().cast("array<string>")
    return ids.join(failed, by, "full").select(
        by, *[F.coalesce(c, empty).alias(c) for c in ("new_ids", "existing_ids", "error_ids")])


def run_page_summary(pages: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Every landed page with its counts; pages without listings count zero and are marked."""
    zero = F.lit(0).cast("bigint")
    counted = pages.join(page_counts, "raw_page_id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("n_new", "n_existing", "n_errors")})
    return counted.withColumn("is_empty", F.col("n_new") + F.col("n_existing") + F.col("n_errors") == 0)


#: Closing text of a page that was landed but lies behind the end of its run.
NOT_PROCESSED = "Behind the end of the run"


def run_page_id(*keys):
    return hex_id(*keys, F.lit("run"))


def open_run_page(pages: DataFrame, run_ts: datetime | str) -> DataFrame:
    """History row of each page when its work starts."""
    none, empty = F.lit(None), F.array().cast("array<string>")
    return pages.select(
        run_page_id(F.col("raw_page_id"), run_time(run_ts)).alias("run_page_id"), "source",
        run_time(run_ts).alias("start_time"), none.cast("string").alias("raw_page_id"),
        empty.alias("new_ids"), empty.alias("existing_ids"), empty.alias("error_ids"),
        none.cast("string").alias("run_error"), none.cast("timestamp").alias("end_time"))


def close_run_page(pages: DataFrame, page_ids: DataFrame, run_ts: datetime | str, end_ts: datetime | str) -> DataFrame:
    """The closing version of the same row: id lists and end, or the error text.

    A page without content failed to load. Its raw page id is recorded all the same. Where the
    text is stored elsewhere, `has_content` tells; `processed` is false for pages behind the
    end of their run.
    """
    empty = F.array().cast("array<string>")
    failed = ~F.col("has_content") if "has_content" in pages.columns else F.col("content").isNull()
    error = F.col("fetch_error") if "fetch_error" in pages.columns else F.lit("Page has no content")
    if "processed" in pages.columns:
        error = F.when(F.col("processed"), error).otherwise(F.lit(NOT_PROCESSED))
        failed = failed | ~F.col("processed")
    return pages.join(page_ids, "raw_page_id", "left").select(
        run_page_id(F.col("raw_page_id"), run_time(run_ts)).alias("run_page_id"), "source",
        run_time(run_ts).alias("start_time"), "raw_page_id",
        *[F.coalesce(c, empty).alias(c) for c in ("new_ids", "existing_ids", "error_ids")],
        F.when(failed, error).alias("run_error"), run_time(end_ts).alias("end_time"))


def run_page_view(events: DataFrame) -> DataFrame:
    """Current version of each history row: the closing event replaces the opening one."""
    versions = events.withColumn("_closed", F.col("end_time").isNotNull())
    return dedupe_last_by_key(versions, ["run_page_id"], ["_closed", "end_time", "start_time"]).drop("_closed")


def run_page_status(history: DataFrame) -> DataFrame:
    return history.withColumn(
        "status", F.when(F.col("run_error") == NOT_PROCESSED, F.lit("skipped"))
        .when(F.col("run_error").isNotNull(), F.lit("failed"))
        .when(F.col("end_time").isNull(), F.lit("running")).otherwise(F.lit("succeeded")))
