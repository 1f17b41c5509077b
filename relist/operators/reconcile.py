"""A batch of listings against the stored postings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist import schemas as S
from relist.functions.arrays import append
from relist.functions.dates import at_least_n_days_after, run_time, ts_to_epoch_ms
from relist.functions.strings import hex_id
from relist.operators.skew import join_unique
from relist.sources.tables import latest_postings

NEW, EXISTING, REPOSTED = "new", "existing", "reposted"


def posting_id(source: Column, url: Column, posting_date: Column) -> Column:
    """Id of the posting a key opens at a date; a repost opens another one."""
    return hex_id(source, url, ts_to_epoch_ms(posting_date))


def _stored_side(stored: DataFrame) -> DataFrame:
    extra = [F.col(c).alias(f"stored_{c}") for c in ("created_at", "other_posting_dates") if c in stored.columns]
    return latest_postings(stored).select(
        *S.KEYS, F.col("posting_id").alias("stored_id"), F.col("posting_date").alias("stored_date"), *extra)


def is_repost(gap_days: int) -> Column:
    return at_least_n_days_after(F.col("posting_date"), F.col("stored_date"), gap_days)


def reconcile_left_join(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Batch rows with the latest stored posting of their key, if any.

    The stored side holds one row per key; a key that fills the batch is taken apart.
    """
    return join_unique(batch, _stored_side(stored), S.KEYS, "left")


def new_postings(batch: DataFrame, stored: DataFrame) -> DataFrame:
    return batch.join(stored.select(*S.KEYS), S.KEYS, "left_anti")


def matched_postings(batch: DataFrame, stored: DataFrame) -> DataFrame:
    return join_unique(batch, _stored_side(stored), S.KEYS)


def reposted_postings(batch: DataFrame, stored: DataFrame, gap_days: int = S.REPOST_GAP_DAYS) -> DataFrame:
    """Matched rows dated at least gap_days after the stored date: these count as new."""
    return matched_postings(batch, stored).where(is_repost(gap_days))


def within_window_postings(batch: DataFrame, stored: DataFrame, gap_days: int = S.REPOST_GAP_DAYS) -> DataFrame:
    """The other matched rows, also those dated before the stored date."""
    return matched_postings(batch, stored).where(~is_repost(gap_days))


def classify_postings(batch: DataFrame, stored: DataFrame, gap_days: int = S.REPOST_GAP_DAYS) -> DataFrame:
    """The three cases in one pass: column `outcome` in (new, existing, reposted)."""
    return reconcile_left_join(batch, stored).withColumn(
        "outcome",
        F.when(F.col("stored_id").isNull(), F.lit(NEW))
        .when(is_repost(gap_days), F.lit(REPOSTED))
        .otherwise(F.lit(EXISTING)))


def union_new_and_reposted(batch: DataFrame, stored: DataFrame, gap_days: int = S.REPOST_GAP_DAYS) -> DataFrame:
    """What is inserted: unseen keys, then reposts."""
    columns = batch.columns
    return new_postings(batch, stored).select(columns).unionByName(
        reposted_postings(batch, stored, gap_days).select(columns))


def union_changed(classified: DataFrame) -> DataFrame:
    """What is published: existing and new alike."""
    return classified.where(F.col("outcome").isNotNull())


def merge_existing(matched: DataFrame) -> DataFrame:
    """A matched row as the updated posting: batch fields, but the stored id, date and
    creation time; the batch date goes to the end of the other dates."""
    kind = f"array<{matched.schema['posting_date'].dataType.simpleString()}>"
    dates = F.col("stored_other_posting_dates") if "stored_other_posting_dates" in matched.columns else F.array().cast(kind)
    kept = [c for c in matched.columns if not c.startswith("stored_") and c not in ("posting_date", "outcome")]
    created = [F.col("stored_created_at").alias("created_at")] if "stored_created_at" in matched.columns else []
    return matched.select(
        *[c for c in kept if c != "created_at" or not created],
        F.col("stored_id").alias("posting_id"),
        F.col("stored_date").alias("posting_date"),
        append(dates, F.col("posting_date")).alias("other_posting_dates"),
        *created)


def has_date_change(matched: DataFrame) -> DataFrame:
    """Optional reading of 'the stored posting changed': dates on different local days.

    The default notion of new information ignores it, see frontier.found_new_info.
    """
    return matched.withColumn("date_changed", F.to_date("posting_date") != F.to_date("stored_date"))


def stamp_technical_fields(rows: DataFrame, run_ts: datetime | str) -> DataFrame:
    """modified_at is the run time; created_at is kept where there is one."""
    now = run_time(run_ts)
    created = F.coalesce(F.col("created_at"), now) if "created_at" in rows.columns else now
    return rows.withColumn("created_at", created).withColumn("modified_at", now)


def insert_postings(rows: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Rows for postings that are not stored yet: id from key and date, both times set."""
    fresh = rows.drop("created_at", "modified_at").withColumn(
        "posting_id", posting_id(F.col("source"), F.col("url"), F.col("posting_date")))
    return stamp_technical_fields(fresh, run_ts)


def update_postings(stored: DataFrame, changes: DataFrame, run_ts: datetime | str) -> DataFrame:
    """New versions of stored postings, by id; ids that are not stored are ignored."""
    created = stored.select("posting_id", F.col("created_at").alias("_created"))
    versions = changes.drop("created_at", "modified_at").join(created, "posting_id", "inner")
    return stamp_technical_fields(versions.withColumnRenamed("_created", "created_at"), run_ts)


def upsert_postings(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """The table after a save: `changed` versions replace stored rows of the same id."""
    return stored.join(changed.select("posting_id"), "posting_id", "left_anti").unionByName(
        changed, allowMissingColumns=True)
