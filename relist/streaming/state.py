"""Episode state kept per key in the state store: a batch reads and writes the keys it holds, nothing else."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

import relist
from relist import schemas as S
from relist.functions.dates import days
from relist.operators.reconcile import posting_id

# The packing travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(relist)

#: Settings a query with keyed state is started with: state on local disks, its changes alone in the checkpoint.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Starts as they leave a call, so many in a row at most.
OPENED, STARTS = "sources array<string>, urls array<string>, posting_us array<bigint>", 1000


#: Keys are dealt into so many groups. It is part of the state: a checkpoint keeps the number it began with.
GROUPS = 4096


class EpisodeFold(StatefulProcessor):
    """Holds the start of the current episode of each key and returns the starts a batch adds.

    A call takes the keys of one group, and the state has an entry for each key of it: calls of Python and the Arrow batches
    that bring back what they return are paid by group, and by key only the read and the write of its own entry.
    The rows come in any order and are passed through one by one; what is held is the first arrival of each date of a key.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The start, and the first instant that opens the next episode.
        self.current = handle.getMapState("current", "source string, url string", "start_us bigint, next_us bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        name = (initialState.source, initialState.url)
        known = self.current.getValue(name)
        if known is None or initialState.posting_us > known[0]:
            self.current.updateValue(name, (initialState.posting_us, initialState.next_us))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        firsts = {}
        for _, source, url, date, after, *at in rows:
            self.meet(firsts.setdefault((source, url), {}), date, after, at)
        for source, url, date in self.opened(firsts):
            yield Row(source=source, url=url, posting_us=date)

    @staticmethod
    def meet(first: dict, date: int, after: int, at: list[int]) -> None:
        seen = first.get(date)
        if seen is None or at < seen[0]:
            first[date] = (at, after)

    def opened(self, firsts: dict) -> Iterator[tuple]:
        """The starts that the first arrivals of each date of a key add; the state is brought up to date."""
        begun = self.current.exists()
        for name, first in firsts.items():
            known = self.current.getValue(name) if begun else None
            upto = None if known is None else known[1]
            opened = None
            for _, date, after in sorted((at, date, after) for date, (at, after) in first.items()):
                if upto is None or date >= upto:
                    opened, upto = (date, after), after
                    yield (*name, date)
            if opened is not None:
                self.current.updateValue(name, opened)

    def close(self) -> None:
        pass


#: Rows that a task packs at a time, and what a packed row holds of each arrival.
PACKED_ROWS = 50_000
_VALUES = ("posting_us", "next_us", "captured_us", "page", "ordinal")
PACKED = "key_group int, sources array<string>, urls array<string>, arrivals array<int>, packed binary"


class PackedFold(EpisodeFold):
    """The same over packed rows: a row is a group's part of many arrivals, by key."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        firsts = {}
        for _, sources, urls, arrivals, packed in rows:
            values = iter(np.frombuffer(packed, np.int64).reshape(-1, len(_VALUES)).tolist())
            for source, url, n in zip(sources, urls, arrivals):
                first = firsts.setdefault((source, url), {})
                for _, (date, after, *at) in zip(range(n), values):
                    self.meet(first, date, after, at)
        starts = self.opened(firsts)
        while part := [x for _, x in zip(range(STARTS), starts)]:
            sources, urls, dates = zip(*part)
            yield Row(sources=list(sources), urls=list(urls), posting_us=list(dates))


def _codes(column: pa.Array) -> np.ndarray:
    """Numbers that tell the values of a column apart; null is a value."""
    return column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)


def _pack(table: pa.Table) -> pa.RecordBatch:
    """Arrivals as one row for each group: its keys, how many arrivals each has, and these as whole numbers.

    Of the arrivals of a key with one date only the first is kept, as no other can open anything.
    """
    group, source, url = (table.column(n).combine_chunks() for n in ("key_group", *S.KEYS))
    groups, values = group.to_numpy(), [table.column(n).to_numpy() for n in _VALUES]
    date, _, captured, page, ordinal = values
    keys = [groups, _codes(source), _codes(url)]
    order = np.lexsort((ordinal, page, captured, date, *keys[::-1]))

    def changes(columns: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([[True], np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)])

    kept = changes([*keys, date])
    begins_key, begins_group = changes(keys)[kept], changes(keys[:1])[kept]
    order = order[kept]
    rows = np.ascontiguousarray(np.stack([v[order] for v in values], axis=1))
    first = np.flatnonzero(begins_key)
    counts = np.diff(np.append(first, len(order))).astype(np.int32)
    edges = np.append(np.flatnonzero(begins_group), len(order))
    offsets = pa.array(np.searchsorted(first, edges).astype(np.int32))
    at = pa.array(order[first])
    whole, step = rows.tobytes(), rows.itemsize * rows.shape[1]
    return pa.RecordBatch.from_arrays([
        pa.array(groups[order[edges[:-1]]], pa.int32()), pa.ListArray.from_arrays(offsets, source.take(at)), pa.ListArray.from_arrays(offsets, url.take(at)),
        pa.ListArray.from_arrays(offsets, pa.array(counts)), pa.array([whole[a * step:b * step] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())],
        names=["key_group", "sources", "urls", "arrivals", "packed"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACKED_ROWS:
            yield _pack(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield _pack(pa.Table.from_batches(held))


def _us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _dated(rows: DataFrame, gap_days: int) -> DataFrame:
    """The date of each row and the first instant at least `gap_days` later, by the calendar of the session."""
    date = F.col("posting_date")
    return rows.where(date.isNotNull()).withColumns({"posting_us": _us(date), "next_us": _us(date + days(gap_days))})


def keyed_episode_starts(sightings: DataFrame, gap_days: int = S.REPOST_GAP_DAYS, stored: DataFrame | None = None) -> DataFrame:
    """A stream of the postings a stream of sightings opens: source, url, posting_id, posting_date.

    The same starts as `posting_episodes` gives batch by batch; sightings without a date, which the check of required
    fields refuses, open nothing. A batch reads the state of its own keys, so it costs the same however many keys and batches came before.
    `stored` (source, url, posting_date) are postings to begin with, read once when the checkpoint is new. Nothing expires.

    The rows of one key in one micro-batch go through one task, as a stream, with those of the other keys of its group; the pace
    of the source bounds them, and the dates that are held of a group. For keys too hot for that, `stream_episode_state` finds the starts without bringing a key together.
    """
    if gap_days < 1:
        raise ValueError("gap_days must be at least 1")
    lowest, group = F.lit(-(2 ** 63)), F.pmod(F.xxhash64(*S.KEYS), F.lit(GROUPS)).cast("int").alias("key_group")
    arrivals = _dated(sightings, gap_days).select(
        group, *S.KEYS, "posting_us", "next_us", F.coalesce(_us(F.col("captured_at")), lowest).alias("captured_us"),
        *[F.coalesce(F.col(c).cast("bigint"), lowest).alias(c) for c in ("page", "ordinal")])
    before = None
    if stored is not None:
        before = _dated(stored, gap_days).groupBy(*S.KEYS).agg(
            F.max(F.struct("posting_us", "next_us")).alias("latest")).select(group, *S.KEYS, "latest.*").groupBy("key_group")
    # A row costs a task of Python far more than what is in it, so arrivals go to the state and starts come from it many in a row.
    packed = arrivals.mapInArrow(_packed, PACKED).groupBy("key_group").transformWithState(PackedFold(), OPENED, "Append", "None", initialState=before)
    opened = packed.select(F.inline(F.arrays_zip("sources", "urls", "posting_us"))).toDF(*S.KEYS, "posting_us")
    date = F.timestamp_micros("posting_us").cast(sightings.schema["posting_date"].dataType)
    return opened.select(*S.KEYS, date.alias("posting_date")).select(
        *S.KEYS, posting_id(F.col("source"), F.col("url"), F.col("posting_date")).alias("posting_id"), "posting_date")


def stream_keyed_episodes(sightings: DataFrame, root: str, checkpoint: str, every: str | None = None,
                          gap_days: int = S.REPOST_GAP_DAYS, stored: DataFrame | None = None) -> StreamingQuery:
    """Write the postings a stream opens to `root`/episodes, each once, also over a restart.

    State and output belong to the checkpoint: a query started again with it goes on where the last one ended. The
    settings of the state store are those of the query alone; the session gets its own back.
    """
    conf = sightings.sparkSession.conf
    before = {k: conf.get(k, None) for k in STATE_SETTINGS}
    writer = (keyed_episode_starts(sightings, gap_days, stored).writeStream.format("parquet").outputMode("append")
              .option("path", f"{root}/episodes").option("checkpointLocation", checkpoint))
    paced = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    try:
        for k, v in STATE_SETTINGS.items():
            conf.set(k, v)
        return paced.start()
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)
