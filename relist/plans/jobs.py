from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relist import schemas as S
from relist.operators import accounting, details, episodes, frontier, publish, reconcile, registry, replay, skew, validate
from relist.session import configure, materialize, release, scratch_path
from relist.sinks import feed, tables
from relist.sinks.commits import Batch, Log, read_log
from relist.sources import pages as page_source
from relist.sources.tables import dedupe_last_by_key


class RunResult(NamedTuple):
    """What a job leaves behind. The frames read stage tables until release() removes them."""

    pages: DataFrame
    tagged: DataFrame
    errors: DataFrame
    totals: DataFrame
    stage: str

    def release(self) -> None:
        release(self.totals.sparkSession, self.stage)


def changed_postings(tagged: DataFrame, stored: DataFrame, run_ts: datetime | str) -> DataFrame:
    """New versions of the postings a batch touched.

    The last sighting supplies the fields, the episode supplies id and date, and a stored
    posting keeps its creation time.
    """
    last = dedupe_last_by_key(tagged, ["posting_id"], S.ARRIVAL)
    created = stored.select("posting_id", "created_at").join(last.select("posting_id"), "posting_id", "left_semi")
    rows = last.join(created, "posting_id", "left").withColumn("posting_date", F.col("episode_start"))
    stamped = reconcile.stamp_technical_fields(rows, run_ts)
    return stamped.select(*[f.name for f in tables.POSTING_ROW.fields])


def other_dates(tagged: DataFrame) -> DataFrame:
    """The dates a batch adds to stored or new postings, one row each."""
    return tagged.where(F.col("outcome") == reconcile.EXISTING).select(
        *[f.name for f in tables.POSTING_DATE_ROW.fields])


def _known_sources(sources: Sequence[str], specs: Mapping[str, S.SourceSpec]) -> None:
    """Refuse sources nothing is registered for."""
    unknown = sorted(set(sources) - set(specs))
    if unknown:
        raise ValueError(f"Unknown source: {', '.join(unknown)}")


def _checked(landed: DataFrame, specs: Mapping[str, S.SourceSpec], stage: str) -> DataFrame:
    """Extract once into a stage table."""
    return materialize(validate.required_fields_check(registry.extract_pages(landed, specs)), "extracted", stage)


def _save(batch: Batch, tagged: DataFrame, errors: DataFrame, run_ts: datetime | str, stored: DataFrame) -> DataFrame:
    """Write what a batch brings to the postings; it is seen when the batch is committed.

    Returns the totals, as `replay_totals` gives them. They are counted while errors and changes are written: the counts stand behind
    the last shuffle of these writes, where a task that is run again does not count twice.
    """
    failed, changed = Observation(), Observation()
    batch.write(errors.observe(failed, F.count(F.lit(1)).alias("n_errors")), "extract_errors")
    batch.write(other_dates(tagged), "posting_dates")
    batch.write(changed_postings(tagged, stored, run_ts), "postings", key=tables.POSTING_KEY)
    written = batch.spark.read.schema(tables.POSTING_ROW).parquet(batch.path("postings"))
    validate.assert_unique_key(written, ["posting_id"])
    batch.write(publish.change_rows(tagged).observe(
        changed, F.count_if(~F.col("opened")).alias("n_updated"), F.count_if("opened").alias("n_inserted")), "changes")
    seen = {**failed.get, **changed.get}
    return batch.spark.createDataFrame([tuple(seen.get(c, 0) for c in accounting.TOTALS)], ", ".join(f"{c} bigint" for c in accounting.TOTALS))


def _land(spark: SparkSession, root: str, batch_id: int, offered: DataFrame, specs: Mapping[str, S.SourceSpec],
          run_ts: datetime | str, stage: str) -> tuple[DataFrame, DataFrame]:
    """Store what arrived before any work on it: texts, strangers, opening rows of the history.

    Returns the landed texts as read back, and one row per page of a known source without its text.
    """
    batch = Batch(spark, root, batch_id, tables.LANDED)
    known = F.coalesce(F.col("source").isin(*specs), F.lit(False))
    batch.write(offered.where(~known).select(*S.RAW_PAGE.fieldNames()), "quarantined_pages")
    batch.write(tables.raw_layout(offered.where(known & F.col("content").isNotNull())), "raw_pages", tables.RAW_LAYOUT)
    pages = offered.where(known).withColumn("has_content", F.col("content").isNotNull()).drop("content")
    pages = materialize(frontier.with_run(pages), "pages", stage)
    batch.write(accounting.open_run_page(pages, run_ts), "run_page_events")
    batch.commit()
    return tables.read_table(spark, root, "raw_pages", before=batch_id + 1, after=batch_id - 1).drop("batch_id", "capture_date"), pages


def run_ingest(
    spark: SparkSession, root: str, pages: DataFrame, batch_id: int, run_ts: datetime | str, *,
    sources: Sequence[str] = (), start_page: int = 1, end_page: int | None = None,
    with_details: bool = False, detail_pages: DataFrame | None = None,
    gap_days: int = S.REPOST_GAP_DAYS, specs: Mapping[str, S.SourceSpec] = registry.DEFAULT_REGISTRY,
    end_ts: datetime | str | None = None,
) -> RunResult:
    """Land pages, extract, reconcile, end each run at its frontier, save, account, publish.

    `pages` has the raw page columns and optionally run_id, see frontier.with_run; content is null where a
    page failed to load. Every page is landed and opened in the history before anything is extracted, so a
    failure later on leaves a trace; pages of unknown sources are quarantined. Pages
    behind the end of their run are landed and marked, but not worked on; the end is
    stored, and later batches of the run know it, so a run may arrive in one batch or in many.

    What was landed is committed first, all that comes of the work in one commit at the end (see sinks.commits), and
    the messages are read from there: a job that fails shows none of its work, and what it saved is published by the next.
    """
    configure(spark)
    _known_sources(sources, specs)
    if with_details and detail_pages is None:
        raise ValueError("with_details needs detail_pages")
    stage = scratch_path(spark, "ingest")
    try:
        offered = page_source.page_range(page_source.select_sources(pages, sources), start_page, end_page)
        landed, index = _land(spark, root, batch_id, offered, specs, run_ts, stage)
        log = read_log(spark, root)
        known_stops = tables.read_table(spark, root, "run_stops", before=batch_id, log=log).groupBy(*frontier.RUN).agg(F.min("stop_page").alias("stop_page"))
        runs = frontier.run_times(index, tables.read_table(spark, root, "page_runs", before=batch_id, log=log))
        index = materialize(index.join(runs, list(frontier.RUN)), "page-index", stage)
        checked = _checked(landed, specs, stage)
        # Within a run pages arrive by number: the time of a listing's arrival is that of its run.
        place = index.groupBy("raw_page_id").agg(F.min("run_at").alias("captured_at"))
        valid = materialize(validate.route_valid(checked).drop("captured_at").join(place, "raw_page_id"), "valid", stage)
        stored = tables.current_postings(spark, root, before=batch_id, log=log, keys=valid)

        # A key that is not large in the batch is not in any part of it, so the folds need not count again.
        large = skew.larger_keys(valid, S.KEYS, stage=stage)

        def fold(rows: DataFrame) -> DataFrame:
            return episodes.posting_episodes(rows, stored, gap_days, stage=stage, counted=True, large=large)

        def walk(offered: DataFrame, rows: DataFrame) -> DataFrame | None:
            return replay.run_ends(offered, rows, stored, gap_days, end_page)

        marked, tagged, stops = frontier.settle_runs(index, valid, known_stops, fold, end_page, lambda df, name: materialize(df, name, stage), walk)
        marked = materialize(marked, "marked", stage)
        done = marked.where("processed").drop("run_at", "processed")
        errors = validate.route_errors(checked.join(done.select("raw_page_id"), "raw_page_id", "left_semi"))

        batch = Batch(spark, root, batch_id, tables.SAVED)
        totals = _save(batch, tagged, errors, run_ts, stored)
        batch.write(marked.select(*S.PAGE_RUN.fieldNames()), "page_runs")
        batch.write(stops.select(*frontier.RUN, "stop_page"), "run_stops")
        batch.write(accounting.close_run_page(marked, accounting.run_page_ids(tagged, errors), run_ts, end_ts or _ended(run_ts)), "run_page_events")
        batch.commit(based_on=log.number, guard=("postings",))
        feed.publish_changes(spark, root)
        if with_details:
            run_details(spark, root, detail_pages, batch_id, run_ts, sources or sorted(specs))
        return RunResult(done, tagged, errors, totals, stage)
    except BaseException:
        release(spark, stage)
        raise


def _ended(run_ts: datetime | str) -> datetime:
    """When the run ends: now, by the clock of the driver, but not before it began."""
    began = datetime.fromisoformat(run_ts) if isinstance(run_ts, str) else run_ts
    if began.tzinfo:
        began = began.astimezone(timezone.utc).replace(tzinfo=None)
    return max(datetime.now(timezone.utc).replace(tzinfo=None), began)


def run_replay(
    spark: SparkSession, root: str, source: str, batch_id: int, run_ts: datetime | str, *,
    start_ts: str | None = None, end_ts: str | None = None, gap_days: int = S.REPOST_GAP_DAYS,
    specs: Mapping[str, S.SourceSpec] = registry.DEFAULT_REGISTRY,
) -> RunResult:
    """Extract and reconcile landed pages of a time range again, in arrival order.

    Nothing is landed and no history is written; there is no frontier.
    """
    configure(spark)
    _known_sources([source], specs)
    stage = scratch_path(spark, "replay")
    try:
        log = read_log(spark, root)
        landed = page_source.scan_raw_pages(tables.read_table(spark, root, "raw_pages", before=batch_id, log=log), source, start_ts, end_ts)
        checked = _checked(landed, specs, stage)
        stored = tables.current_postings(spark, root, before=batch_id, log=log)
        tagged = materialize(episodes.posting_episodes(validate.route_valid(checked), stored, gap_days, stage=stage), "tagged", stage)
        errors = validate.route_errors(checked)
        batch = Batch(spark, root, batch_id, tables.SAVED)
        totals = _save(batch, tagged, errors, run_ts, stored)
        batch.commit(based_on=log.number, guard=("postings",))
        feed.publish_changes(spark, root)
        return RunResult(landed.drop("content"), tagged, errors, totals, stage)
    except BaseException:
        release(spark, stage)
        raise


def waiting_for_details(spark: SparkSession, root: str, batch_id: int, log: Log) -> DataFrame:
    """(posting_id, source, url) of the postings opened up to this batch that have no detail row by an earlier one.

    Kept, not computed anew: what the last run with details left over, and what the batches saved since have opened. Only for
    batches that were saved again behind a run with details are the stored details looked through.
    """
    earlier = log.entries("posting_details", before=batch_id)
    taken = [(e.part.batch_id, e.part.upto or 0) for e in earlier]
    fresh = [e for e in log.entries("changes", phase=tables.SAVED, before=batch_id + 1) if not any(b >= e.part.batch_id and u >= e.number for b, u in taken)]
    last = max((b for b, _ in taken), default=-1)
    again = {e.part.batch_id for e in fresh if e.part.batch_id <= last}
    left = tables.read_table(spark, root, "details_backlog", before=last + 1, after=last - 1, log=log).drop("batch_id")
    if not fresh:
        return left
    numbers = [e.part.batch_id for e in fresh]
    changes = tables.read_table(spark, root, "changes", before=max(numbers) + 1, after=min(numbers) - 1, log=log)
    opened = changes.where(F.col("opened") & F.col("batch_id").isin(numbers)).select(F.col("key").alias("posting_id"), *S.KEYS, "batch_id").dropDuplicates(["posting_id"])
    if again:
        done = tables.read_table(spark, root, "posting_details", before=batch_id, log=log)
        opened = opened.where(~F.col("batch_id").isin(*again)).unionByName(details.details_backlog(opened.where(F.col("batch_id").isin(*again)), done))
        left = left.join(opened.select("posting_id"), "posting_id", "left_anti")
    return left.unionByName(opened.drop("batch_id"))


def run_details(spark: SparkSession, root: str, detail_pages: DataFrame, batch_id: int, run_ts: datetime | str,
                sources: Sequence[str] = ()) -> DataFrame:
    """Detail rows for all postings of `sources` without one. What is left over is stored with them, so work
    left by an interrupted run is picked up by the next."""
    configure(spark)
    log = read_log(spark, root)
    batch = Batch(spark, root, batch_id, tables.DETAILED)
    stage = scratch_path(spark, "details")
    try:
        waiting = materialize(waiting_for_details(spark, root, batch_id, log), "backlog", stage)
        mine = page_source.select_sources(waiting, sources)
        batch.write(details.attach_details(mine.select("posting_id", "url"), detail_pages, run_ts), "posting_details")
        batch.write(waiting.join(mine.select("posting_id"), "posting_id", "left_anti").select(*tables.BACKLOG_ROW.fieldNames()), "details_backlog")
        batch.commit(upto=log.number)
    finally:
        release(spark, stage)
    return tables.read_table(spark, root, "posting_details", before=batch_id + 1, after=batch_id - 1)


def run_history(spark: SparkSession, root: str) -> DataFrame:
    """Current history row of every page, with its status."""
    return accounting.run_page_status(accounting.run_page_view(tables.read_table(spark, root, "run_page_events")))

