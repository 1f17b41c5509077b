"""Which posting every sighting of a key belongs to.

The sightings of a key, in arrival order, open a first episode; one dated at least
`gap_days` after the start of the current episode opens the next; all others (also those
dated earlier) belong to the current one. The gap counts from the episode start, not from
the previous sighting, so this is a fold and not a lag.

Keys of ordinary size are folded in one shuffle of their sightings, sorted by arrival: one walk over the rows of a task
marks them, whatever number of keys and dates it holds. A key with more
sightings than the limit is first reduced to the first arrival of each distinct date (only
those can start an episode), and if it is still too large its starts are found one after
the other by distributed minima. A key has at most one start per gap of calendar time, which
bounds what is kept per key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import relist

from relist import schemas as S
from relist.functions.dates import days
from relist.operators.reconcile import EXISTING, NEW, REPOSTED, posting_id
from relist.operators.skew import KEY_LIMIT, join_unique, larger_keys
from relist.session import materialize
from relist.sources.tables import latest_postings

# The helpers travel with the walk, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(relist)

#: What the walk needs beside the sightings, and what it leaves in their place.
_NEXT, _KNOWN, _KNOWN_DATE, _KNOWN_NEXT = "_next", "_known_id", "_known_date", "_known_next"
_OPENS, _INDEX, _START, _BY_STORED = "_opens", "repost_index", "episode_start", "_by_stored"


def _arrival() -> Column:
    return F.struct(*S.ARRIVAL)


def _start_type(df: DataFrame) -> str:
    """A start is the arrival that opened the episode; without arrival it is the stored one."""
    fields = {f: df.schema[f].dataType.simpleString() for f in S.ARRIVAL}
    arrival = ",".join(f"{n}:{t}" for n, t in fields.items())
    return f"array<struct<arrival:struct<{arrival}>,posting_date:{fields['posting_date']},posting_id:string>>"


def first_arrivals(sightings: DataFrame) -> DataFrame:
    """Per key and posting date, the arrival that brought it first."""
    return sightings.groupBy(*S.KEYS, "posting_date").agg(F.min(_arrival()).alias("arrival"))


def stored_starts(stored: DataFrame | None, sightings: DataFrame) -> DataFrame | None:
    """Latest stored posting of the keys in hand.

    The semi join comes first: for a batch small enough to broadcast its keys, the
    stored table is filtered where it is scanned and never shuffled.
    """
    if stored is None:
        return None
    keys = sightings.select(*S.KEYS).distinct()
    ours = stored.select(*S.KEYS, "posting_date", "posting_id").join(keys, S.KEYS, "left_semi")
    return latest_postings(ours).select(
        *S.KEYS, F.col("posting_date").alias("stored_date"), F.col("posting_id").alias("stored_id"))


def _arrivals(sightings: DataFrame) -> DataFrame:
    return sightings.select(*S.KEYS, _arrival().alias("arrival"))


def _fold(arrivals: DataFrame, stored: DataFrame | None, gap_days: int, kind: str) -> DataFrame:
    # Lists do not shrink before the shuffle, so the rows are moved as they are.
    per_key = arrivals.repartition(*S.KEYS).groupBy(*S.KEYS).agg(F.sort_array(F.collect_list("arrival")).alias("arrivals"))
    empty = F.array().cast(kind)
    before = empty
    if stored is not None:
        per_key = per_key.join(stored, S.KEYS, "left")
        before = F.when(F.col("stored_id").isNull(), empty).otherwise(F.array(F.struct(
            F.lit(None).alias("arrival"), F.col("stored_date").alias("posting_date"),
            F.col("stored_id").alias("posting_id"))).cast(kind))

    def step(starts: Column, arrival: Column) -> Column:
        current = F.element_at(starts, -1)["posting_date"]
        date = arrival["posting_date"]
        opened = F.array(F.struct(
            arrival.alias("arrival"), date.alias("posting_date"),
            F.lit(None).cast("string").alias("posting_id"))).cast(kind)
        return F.when(F.size(starts) == 0, opened).when(
            date >= current + days(gap_days), F.concat(starts, opened)).otherwise(starts)

    return per_key.select(*S.KEYS, F.aggregate("arrivals", before, step).alias("starts"))


def _walk(firsts: DataFrame, stored: DataFrame | None, gap_days: int, kind: str,
          stage: str | None) -> DataFrame:
    """The same starts for keys too large to bring together.

    Each round finds the next start of every such key with one partially aggregated
    minimum over its distinct dates, so no task holds a key; there are as many rounds as
    a key has starts.
    """
    def earliest(rows: DataFrame) -> DataFrame:
        found = rows.groupBy(*S.KEYS).agg(F.min("arrival").alias("arrival"))
        return materialize(found.select(
            *S.KEYS, "arrival", F.col("arrival.posting_date").alias("posting_date"),
            F.lit(None).cast("string").alias("posting_id")), "starts", stage)

    rounds, unseen = [], firsts
    if stored is not None:
        known = stored.join(firsts.select(*S.KEYS).distinct(), S.KEYS, "left_semi")
        rounds.append(materialize(known.select(
            *S.KEYS, F.lit(None).cast(firsts.schema["arrival"].dataType).alias("arrival"),
            F.col("stored_date").alias("posting_date"), F.col("stored_id").alias("posting_id")), "starts", stage))
        unseen = firsts.join(rounds[0].select(*S.KEYS), S.KEYS, "left_anti")
    rounds.append(earliest(unseen))
    current = reduce(DataFrame.unionByName, rounds)
    while not current.isEmpty():
        since = current.select(*S.KEYS, F.col("posting_date").alias("since"))
        beyond = firsts.join(since, S.KEYS).where(F.col("posting_date") >= F.col("since") + days(gap_days))
        current = earliest(beyond)
        rounds.append(current)
    start = F.struct("arrival", "posting_date", "posting_id")
    starts = reduce(DataFrame.unionByName, rounds).groupBy(*S.KEYS).agg(F.sort_array(F.collect_list(start)).alias("starts"))
    return starts.select(*S.KEYS, F.col("starts").cast(kind))


def _starts(sightings: DataFrame, stored: DataFrame | None, gap_days: int, fold_limit: int, stage: str | None,
            large: DataFrame | None) -> DataFrame:
    kind, latest = _start_type(sightings), stored_starts(stored, sightings)
    if large is None:
        return _fold(_arrivals(sightings), latest, gap_days, kind)
    starts = _fold(_arrivals(sightings.join(large, S.KEYS, "left_anti")), latest, gap_days, kind)
    firsts = materialize(first_arrivals(sightings.join(large, S.KEYS, "left_semi")), "first-arrivals", stage)
    still_large = larger_keys(firsts, S.KEYS, fold_limit, stage)
    if still_large is None:
        return starts.unionByName(_fold(firsts.select(*S.KEYS, "arrival"), latest, gap_days, kind))
    reduced = firsts.join(still_large, S.KEYS, "left_anti").select(*S.KEYS, "arrival")
    walked = _walk(firsts.join(still_large, S.KEYS, "left_semi"), latest, gap_days, kind, stage)
    return starts.unionByName(_fold(reduced, latest, gap_days, kind)).unionByName(walked)


def episode_starts(sightings: DataFrame, stored: DataFrame | None = None, gap_days: int = S.REPOST_GAP_DAYS,
                   fold_limit: int = KEY_LIMIT, stage: str | None = None) -> DataFrame:
    """Per key, the array of episode starts in order, the stored one first if there is one."""
    return _starts(sightings, stored, gap_days, fold_limit, stage, larger_keys(sightings, S.KEYS, fold_limit, stage))


#: Stands for a missing date among whole numbers; no date is stored as it.
_NO_DATE = -(2 ** 63)


def _same_as_before(column: pa.Array, last: pa.Array) -> np.ndarray:
    """Whether each value is that of the row before it; null is a value, `last` holds the row before the first."""
    both = pa.concat_arrays([last, column])
    before, now = both[:-1], both[1:]
    equal = pc.equal(before, now)
    if both.null_count:
        equal = pc.or_(pc.fill_null(equal, False), pc.and_(before.is_null(), now.is_null()))
    return equal.to_numpy(zero_copy_only=False)


def _instants(column: pa.Array) -> list[int]:
    """Dates or times as the whole numbers they are stored as."""
    whole = column.cast(pa.int32()).cast(pa.int64()) if pa.types.is_date32(column.type) else column.cast(pa.int64())
    return pc.fill_null(whole, _NO_DATE).to_numpy().tolist()


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fold over rows that come by key in the order of arrival.

    Held from row to row: the current start, the first instant that opens the next episode, and the last row's key and arrival.
    """
    last, opening, index, start, upto, stored = None, False, 0, _NO_DATE, _NO_DATE, False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n) for n in (*S.KEYS, *S.ARRIVAL)]
        same = [_same_as_before(c, c[:1] if last is None else last[k]) for k, c in enumerate(columns)]
        of_key = same[0] & same[1]
        if last is None:
            of_key[0] = False
        again = of_key & same[2] & same[3] & same[4] & same[5]
        last = [c[-1:] for c in columns]
        dates, known = batch.column("posting_date"), batch.column(_KNOWN)
        opens, indexes, starts, by_stored = [], [], [], []
        has = known.is_valid().to_numpy(zero_copy_only=False).tolist()
        none = [_NO_DATE] * batch.num_rows
        known_dates, known_nexts = (_instants(batch.column(_KNOWN_DATE)), _instants(batch.column(_KNOWN_NEXT))) if known.null_count < len(known) else (none, none)
        rows = zip(of_key.tolist(), again.tolist(), _instants(dates), _instants(batch.column(_NEXT)), has, known_dates, known_nexts)
        for same_key, copied, date, after, is_known, known_date, known_next in rows:
            if copied:
                pass  # A copy of the last arrival: it opens what that one opened.
            elif not same_key and not is_known:
                opening, index, start, upto, stored = True, 0, date, after, False
            else:
                if not same_key:
                    index, start, upto, stored = 0, known_date, known_next, True
                # Without a date there is no gap to measure, on either side.
                opening = date >= upto and date != _NO_DATE and upto != _NO_DATE
                if opening:
                    index, start, upto, stored = index + 1, date, after, False
            opens.append(opening)
            indexes.append(index)
            starts.append(start)
            by_stored.append(stored)
        begun = np.array(starts, dtype=np.int64)
        begun = pa.array(begun, mask=begun == _NO_DATE)
        begun = begun.cast(pa.int32()).cast(dates.type) if pa.types.is_date32(dates.type) else begun.cast(dates.type)
        names = [n for n in batch.schema.names if n not in (_NEXT, _KNOWN_DATE, _KNOWN_NEXT)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(np.array(opens)), pa.array(np.array(indexes, dtype=np.int32)), begun, pa.array(np.array(by_stored))],
            names=[*names, _OPENS, _INDEX, _START, _BY_STORED])


def _walk_rows(sightings: DataFrame, latest: DataFrame | None, gap_days: int) -> DataFrame:
    """Sightings of keys of ordinary size with their outcome, start and id: one shuffle, one sort, one pass."""
    date = sightings.schema["posting_date"].dataType
    rows = sightings.where(F.col("source").isNotNull() & F.col("url").isNotNull())
    none = F.lit(None)
    if latest is None:
        rows = rows.withColumns({_KNOWN: none.cast("string"), _KNOWN_DATE: none.cast(date)})
    else:
        rows = rows.join(latest.select(*S.KEYS, F.col("stored_id").alias(_KNOWN), F.col("stored_date").cast(date).alias(_KNOWN_DATE)), S.KEYS, "left")
    gap = days(gap_days)
    rows = rows.withColumns({_NEXT: (F.col("posting_date") + gap).cast(date), _KNOWN_NEXT: (F.col(_KNOWN_DATE) + gap).cast(date)})
    rows = rows.select(*sightings.columns, _KNOWN, _NEXT, _KNOWN_DATE, _KNOWN_NEXT).repartition(*S.KEYS).sortWithinPartitions(*S.KEYS, *S.ARRIVAL)
    schema = T.StructType([
        *sightings.schema.fields, T.StructField(_KNOWN, T.StringType()), T.StructField(_OPENS, T.BooleanType()),
        T.StructField(_INDEX, T.IntegerType()), T.StructField(_START, date), T.StructField(_BY_STORED, T.BooleanType())])
    opened = posting_id(F.col("source"), F.col("url"), F.col(_START))
    return rows.mapInArrow(_walked, schema).select(
        *sightings.columns, _INDEX, _outcome(F.col(_OPENS)).alias("outcome"), _START,
        F.when(F.col(_BY_STORED), F.col(_KNOWN)).otherwise(opened).alias("posting_id"))


def _outcome(opens: Column) -> Column:
    return F.when(~opens, F.lit(EXISTING)).when(F.col(_INDEX) == 0, F.lit(NEW)).otherwise(F.lit(REPOSTED))


def posting_episodes(sightings: DataFrame, stored: DataFrame | None = None, gap_days: int = S.REPOST_GAP_DAYS,
                     fold_limit: int = KEY_LIMIT, stage: str | None = None, counted: bool = False, large: DataFrame | None = None) -> DataFrame:
    """Every sighting with its outcome, posting id, episode start and repost index.

    The outcome is what the sighting met when it arrived: the first of an unseen key is
    new, one that opens a later episode is reposted, all others are existing. Where the keys were `counted` before, in these
    sightings or in more, `large` names those over the limit.
    """
    if gap_days < 1:
        raise ValueError("gap_days must be at least 1")
    large = large if counted else larger_keys(sightings, S.KEYS, fold_limit, stage)
    if large is None:
        return _walk_rows(sightings, stored_starts(stored, sightings), gap_days)
    ordinary, rest = (sightings.join(large, S.KEYS, how) for how in ("left_anti", "left_semi"))
    tagged = _joined(rest, _starts(rest, stored, gap_days, fold_limit, stage, large), stage, large)
    return _walk_rows(ordinary, stored_starts(stored, ordinary), gap_days).unionByName(tagged)


def _joined(sightings: DataFrame, starts: DataFrame, stage: str | None, large: DataFrame) -> DataFrame:
    """Sightings of keys too large for one task with the starts of their keys."""
    arrived = F.filter("starts", lambda s: s["arrival"].isNull() | (s["arrival"] <= _arrival()))
    opens = F.col("_at.arrival").isNotNull() & (F.col("_at.arrival") == _arrival())
    tagged = join_unique(sightings, starts, S.KEYS, stage=stage, large=large).withColumn("_arrived", arrived).drop("starts")
    return (
        tagged.withColumn("_at", F.element_at("_arrived", -1))
        .withColumn(_INDEX, F.size("_arrived") - 1)
        .withColumn("outcome", _outcome(opens))
        .withColumn(_START, F.col("_at.posting_date"))
        .withColumn("posting_id", F.coalesce(
            F.col("_at.posting_id"), posting_id(F.col("source"), F.col("url"), F.col("_at.posting_date"))))
        .drop("_arrived", "_at"))


def posting_timeline(tagged: DataFrame) -> DataFrame:
    """One row per episode of a key: its start, its place in the sequence, and how many
    further dates were seen, with the range they span."""
    other = F.when(F.col("outcome") == EXISTING, F.col("posting_date"))
    return tagged.groupBy(*S.KEYS, "repost_index", "episode_start", "posting_id").agg(
        F.count(other).alias("n_other_dates"),
        F.min(other).alias("first_other_date"),
        F.max(other).alias("last_other_date"))
