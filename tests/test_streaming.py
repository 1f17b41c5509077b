"""Keyed state and pacing of streams."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relist import schemas as S
from relist.operators.episodes import posting_episodes
from relist.operators.reconcile import EXISTING
from relist.sources import pages as P
from relist.streaming.ingest import stream_foreach
from relist.streaming import state as K
from relist.streaming.state import STATE_SETTINGS, EpisodeFold, stream_keyed_episodes

DAY0 = datetime(2024, 1, 1)
SIGHTINGS = "source string, url string, posting_date timestamp, captured_at timestamp, page int, ordinal int"


def sighting(url, day, seen, page=1, ordinal=0, source="s"):
    date = None if day is None else DAY0 + timedelta(days=day)
    return (source, url, date, DAY0 + timedelta(days=seen), page, ordinal)


def arrive(spark, rows, path):
    spark.createDataFrame(rows, SIGHTINGS).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, root, checkpoint, **options):
    stream = spark.readStream.schema(SIGHTINGS).option("maxFilesPerTrigger", 1).parquet(path)
    query = stream_keyed_episodes(stream, root, checkpoint, **options)
    query.awaitTermination()
    return query


def opened(spark, root):
    return sorted(tuple(r) for r in spark.read.parquet(f"{root}/episodes").select("source", "url", "posting_id", "posting_date").collect())


def expected(spark, rows, stored=None):
    """One pass marks every copy of an arrival that opens an episode; what it opens is one posting."""
    tagged = posting_episodes(spark.createDataFrame(rows, SIGHTINGS), stored)
    return sorted(tuple(r) for r in tagged.where(F.col("outcome") != EXISTING).select("source", "url", "posting_id", "posting_date").distinct().collect())


def test_keyed_state_equals_one_pass_over_restarts(spark, tmp_path):
    """Arrivals in time order, rows shuffled within; the query ends and starts again in the middle."""
    draw = random.Random(5)
    path, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    everything = []
    for part in range(4):
        rows = [sighting(f"u{draw.randrange(12)}", draw.randrange(0, 200), part * 10 + draw.randrange(10), draw.randrange(3), draw.randrange(3))
                for _ in range(60)]
        rows += rows[:3]
        everything += rows
        draw.shuffle(rows)
        arrive(spark, rows, path)
        if part % 2:
            run(spark, path, root, checkpoint)
    assert opened(spark, root) == expected(spark, everything)
    run(spark, path, root, checkpoint)
    assert opened(spark, root) == expected(spark, everything)


def test_keyed_state_goes_on_from_stored_postings(spark, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    stored = spark.createDataFrame(
        [("s", "a", "old", DAY0 - timedelta(days=50)), ("s", "a", "a0", DAY0), ("s", "b", "b0", DAY0)],
        "source string, url string, posting_id string, posting_date timestamp")
    rows = [sighting("a", 29, 40), sighting("a", 30, 41), sighting("b", 10, 40), sighting("c", 1, 40)]
    arrive(spark, rows, path)
    run(spark, path, root, str(tmp_path / "checkpoint"), stored=stored)
    assert opened(spark, root) == expected(spark, rows, stored)
    assert [r[1] for r in opened(spark, root)] == ["a", "c"]


def test_keyed_state_of_odd_rows(spark, tmp_path):
    """Sightings without a date open nothing; null keys are a key; of equal arrivals the earlier date comes first."""
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [sighting("a", None, 1), sighting("a", 3, 2), sighting(None, 5, 1), sighting(None, 5, 1), sighting("b", 60, 1), sighting("b", 1, 1)]
    arrive(spark, rows, path)
    arrive(spark, [], path)
    run(spark, path, root, str(tmp_path / "checkpoint"))
    assert [(r.url, (r.posting_date - DAY0).days) for r in spark.read.parquet(f"{root}/episodes").orderBy("url", "posting_date").collect()] == [
        (None, 5), ("a", 3), ("b", 1), ("b", 60)]
    with pytest.raises(ValueError):
        stream_keyed_episodes(spark.readStream.schema(SIGHTINGS).parquet(path), root, str(tmp_path / "other"), gap_days=0)


def test_a_batch_costs_its_own_keys(spark, tmp_path):
    """Twenty batches of 20 keys, all but one of them new: reads and writes of the state follow the batch, not the state."""
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for b in range(20):
        arrive(spark, [sighting("always", 40 * b, 40 * b)] + [sighting(f"{b}-{k}", 0, 40 * b) for k in range(19)], path)
    query = run(spark, path, root, str(tmp_path / "checkpoint"))
    batches = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 20
    assert [b["numRowsUpdated"] for b in batches] == [20] * 20
    assert batches[-1]["numRowsTotal"] == 19 * 20 + 1
    read = [b["customMetrics"]["rocksdbGetCount"] for b in batches]
    assert max(read) <= 2 * min(read)
    assert {k: spark.conf.get(k, None) for k in STATE_SETTINGS} == before


def raw(source, page, minute):
    return (f"{source}-{page}", page, source, "x", DAY0 + timedelta(minutes=minute))


def test_a_busy_source_does_not_hold_up_a_quiet_one(spark, tmp_path):
    path = str(tmp_path / "in")

    def land(source, pages):
        for p in pages:
            spark.createDataFrame([raw(source, p, p)], S.RAW_PAGE).coalesce(1).write.mode("append").partitionBy("source").parquet(path)

    seen = []
    paces = {"busy": 2, "quiet": 2, "other": 1, "not yet": 5}
    land("busy", range(7))
    land("quiet", range(2))
    land("unpaced", range(1))
    land("other", range(2))

    def go():
        stream = P.stream_paced_pages(spark, path, paces)
        assert stream.schema.fieldNames() == S.RAW_PAGE.fieldNames()
        stream_foreach(stream, lambda df, b: seen.extend((b, r.source, r.page) for r in df.collect()), str(tmp_path / "checkpoint")).awaitTermination()

    go()
    assert sorted(seen) == sorted([(p // 2, "busy", p) for p in range(7)] + [(0, "quiet", p) for p in range(2)] + [(p, "other", p) for p in range(2)])
    del seen[:]
    land("not yet", [1])
    go()
    assert [(s, p) for _, s, p in seen] == [("not yet", 1)]


@pytest.mark.parametrize("paces", [{}, {"busy": 0}])
def test_paces_are_checked(spark, tmp_path, paces):
    with pytest.raises(ValueError):
        P.stream_paced_pages(spark, str(tmp_path), paces)


class _Map:
    def __init__(self):
        self.rows, self.reads = {}, []

    def exists(self):
        return bool(self.rows)

    def getValue(self, key):
        self.reads.append(key)
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value


def test_a_call_folds_all_keys_of_a_group():
    """The keys of a group share a call; each reads and writes its own entry, and none is read while the group is empty."""
    state, fold = _Map(), EpisodeFold()

    class Handle:
        def getMapState(self, *_):
            return state

    fold.init(Handle())
    rows = [(7, "s", url, date, date + 30, date, 1, 0) for url in "ab" for date in (50, 0, 10, 40)]
    go = lambda given: [tuple(r) for r in fold.handleInputRows((7,), iter(given), None)]
    assert go(rows) == [("s", u, d) for u in "ab" for d in (0, 40)]
    assert state.reads == []
    assert go([(7, "s", "b", 80, 110, 80, 1, 0), (7, "s", None, 1, 31, 80, 1, 0)]) == [("s", "b", 80), ("s", None, 1)]
    assert state.reads == [("s", "b"), ("s", None)]
    assert state.rows == {("s", "a"): (40, 70), ("s", "b"): (80, 110), ("s", None): (1, 31)}


def test_packed_arrivals_open_what_single_ones_open(monkeypatch):
    """A group crosses to the state as one row of each pack, however many arrivals it has; keys may be null, arrivals equal."""
    monkeypatch.setattr(K, "PACKED_ROWS", 700)
    monkeypatch.setattr(K, "STARTS", 7)
    dice, states = random.Random(1), [_Map(), _Map()]
    folds = [EpisodeFold(), K.PackedFold()]
    for fold, state in zip(folds, states):
        fold.init(type("Handle", (), {"getMapState": lambda self, *_, state=state: state})())
    names = ["key_group", "source", "url", "posting_us", "next_us", "captured_us", "page", "ordinal"]
    for batch in range(3):
        rows = []
        for _ in range(2000):
            date, url = dice.randint(0, 400), dice.choice([None, *"abcdefgh", "ü\0x", ""])
            rows.append((dice.randint(0, 2), dice.choice(["s", "t", None]), url, date, date + 30, 1000 * batch + dice.randint(0, 300), dice.randint(1, 2), dice.randint(0, 1)))
        parts = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k:k + 256]]) for k in range(0, len(rows), 256)]
        packed = [tuple(r.values()) for b in K._packed(iter(parts)) for r in b.to_pylist()]
        assert len(packed) == 3 * 3
        for group in range(3):
            plain = folds[0].handleInputRows((group,), (r for r in rows if r[0] == group), None)
            several = list(folds[1].handleInputRows((group,), (r for r in packed if r[0] == group), None))
            assert all(len(r.urls) <= 7 for r in several)
            key = lambda r: tuple(map(repr, r))
            assert sorted((tuple(r) for r in plain), key=key) == sorted((x for r in several for x in zip(r.sources, r.urls, r.posting_us)), key=key)
        assert states[0].rows == states[1].rows
