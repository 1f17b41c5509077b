from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relist.operators import episodes as E
from relist.operators import frontier as Fr
from relist.operators import reconcile as R
from relist.operators import skew
from relist.operators.validate import assert_unique_key
from relist.sinks.tables import posting_documents

DAY0 = datetime(2020, 1, 1, 12)


def day(n):
    return DAY0 + timedelta(days=n)


def sightings(spark, rows):
    """rows: (source, url, day number) in arrival order."""
    data = [(s, u, day(d), day(1000) + timedelta(seconds=i), i + 1, 0) for i, (s, u, d) in enumerate(rows)]
    return spark.createDataFrame(data, "source string, url string, posting_date timestamp, captured_at timestamp, page int, ordinal int")


def stored(spark, rows):
    """rows: (source, url, day number, id)"""
    data = [(i, s, u, day(d), [day(d)], day(d)) for s, u, d, i in rows]
    return spark.createDataFrame(data, "posting_id string, source string, url string, posting_date timestamp, "
                                       "other_posting_dates array<timestamp>, created_at timestamp")


BATCH = [("a", "unseen", 0), ("a", "plus29", 29), ("a", "plus30", 30), ("a", "plus31", 31), ("a", "earlier", -5), ("a", "same", 0),
         ("a", "both", 40), ("b", "both", 3)]
STORED = [("a", u, 0, f"id-{u}") for u in ("plus29", "plus30", "plus31", "earlier", "same", "both", "other")] + [("b", "both", 0, "id-b")]
OUTCOMES = {("a", "unseen"): "new", ("a", "plus29"): "existing", ("a", "plus30"): "reposted", ("a", "plus31"): "reposted",
            ("a", "earlier"): "existing", ("a", "same"): "existing", ("a", "both"): "reposted", ("b", "both"): "existing"}


def test_classify(spark):
    got = R.classify_postings(sightings(spark, BATCH), stored(spark, STORED))
    assert {(r.source, r.url): r.outcome for r in got.collect()} == OUTCOMES


def test_classify_against_latest_posting(spark):
    table = stored(spark, [("a", "x", 0, "old"), ("a", "x", 40, "new")])
    row = R.classify_postings(sightings(spark, [("a", "x", 60)]), table).first()
    assert (row.stored_id, row.outcome) == ("new", "existing")


def test_parts_agree_with_classify(spark):
    batch, table = sightings(spark, BATCH), stored(spark, STORED)
    keys = lambda df: sorted((r.source, r.url) for r in df.collect())
    of = lambda *o: sorted(k for k, v in OUTCOMES.items() if v in o)
    assert keys(R.new_postings(batch, table)) == of("new")
    assert keys(R.matched_postings(batch, table)) == of("existing", "reposted")
    assert keys(R.reposted_postings(batch, table)) == of("reposted")
    assert keys(R.within_window_postings(batch, table)) == of("existing")
    assert keys(R.union_new_and_reposted(batch, table)) == of("new", "reposted")


def test_merge_existing(spark):
    merged = R.merge_existing(R.within_window_postings(sightings(spark, BATCH), stored(spark, STORED)))
    rows = {(r.source, r.url): r for r in merged.collect()}
    late = rows["a", "earlier"]
    assert (late.posting_id, late.posting_date, late.created_at, late.other_posting_dates) == ("id-earlier", day(0), day(0), [day(0), day(-5)])
    assert rows["a", "same"].other_posting_dates == [day(0), day(0)]


def test_update_ignores_unknown_ids(spark):
    table = stored(spark, STORED)
    changes = table.unionByName(stored(spark, [("a", "z", 0, "unknown")]))
    rows = R.update_postings(table, changes, "2021-01-01 00:00:00").collect()
    assert len(rows) == len(STORED) and all(r.created_at == day(0) and r.modified_at == datetime(2021, 1, 1) for r in rows)


def test_unique_key(spark):
    assert_unique_key(stored(spark, STORED), ["source", "url"])
    with pytest.raises(ValueError, match="duplicate key"):
        assert_unique_key(stored(spark, STORED * 2), ["source", "url"])


def test_episode_chain(spark):
    """The gap counts from the episode start: days 0, 20, 40, 60, 75 start at 0, 40 and 75."""
    got = E.posting_episodes(sightings(spark, [("a", "x", d) for d in (0, 20, 40, 60, 75)])).orderBy("page").collect()
    assert [(r.episode_start, r.outcome, r.repost_index) for r in got] == [
        (day(0), "new", 0), (day(0), "existing", 0), (day(40), "reposted", 1), (day(40), "existing", 1), (day(75), "reposted", 2)]
    assert len({r.posting_id for r in got}) == 3


def test_stored_posting_continues(spark):
    got = E.posting_episodes(sightings(spark, [("a", "x", 25), ("a", "x", 35), ("a", "y", 0)]), stored(spark, [("a", "x", 0, "mine")]))
    assert [(r.url, r.outcome, r.repost_index) for r in got.orderBy("page").collect()] == [("x", "existing", 0), ("x", "reposted", 1), ("y", "new", 0)]
    assert got.orderBy("page").first().posting_id == "mine"


def fold(rows, before, gap=30):
    """The definition, one row at a time."""
    current, out = dict(before), []
    for source, url, d in rows:
        key = (source, url)
        if key not in current:
            outcome = "new"
        elif d >= current[key] + gap:
            outcome = "reposted"
        else:
            outcome = "existing"
        if outcome != "existing":
            current[key] = d
        out.append((outcome, day(current[key])))
    return out


ROWS = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(-40, 400)), min_size=1, max_size=60)
BEFORE = st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz")), st.integers(0, 200), max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, before=BEFORE, limit=st.sampled_from([1, 4, 1000]))
def test_episodes_equal_the_fold(spark, rows, before, limit):
    """Also with a limit so small that keys are reduced or walked instead of folded."""
    table = stored(spark, [(s, u, d, f"id-{s}-{u}") for (s, u), d in before.items()]) if before else None
    got = E.posting_episodes(sightings(spark, rows), table, fold_limit=limit).orderBy("page").collect()
    assert [(r.outcome, r.episode_start) for r in got] == fold(rows, before)


def test_hot_key_is_walked(spark):
    """One key with most rows: 700 days and several sightings a day, far over the limit."""
    n = 5000
    days = F.floor(F.col("id") * 700 / n)
    hot = spark.range(n).select(
        F.lit("a").alias("source"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 77).cast("string"))).alias("url"),
        (F.lit(DAY0).cast("timestamp") + F.make_interval(days=days.cast("int"), hours=(F.col("id") % 7).cast("int"))).alias("posting_date"),
        (F.lit(DAY0).cast("timestamp") + F.make_interval(days=F.lit(1000), mins=F.col("id").cast("int"))).alias("captured_at"),
        F.col("id").cast("int").alias("page"), F.lit(0).alias("ordinal"))
    columns = ["page", "outcome", "episode_start", "posting_id", "repost_index"]
    folded = E.posting_episodes(hot).select(columns)
    walked = E.posting_episodes(hot, fold_limit=100).select(columns)
    assert folded.count() == walked.count() == n
    assert folded.exceptAll(walked).isEmpty() and walked.exceptAll(folded).isEmpty()


def test_join_unique_takes_large_keys_apart(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how)
        split = skew.join_unique(left, right, ["k"], how, limit=100)
        assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_timeline(spark):
    tagged = E.posting_episodes(sightings(spark, [("a", "x", d) for d in (0, 20, 40, 10, 75)]))
    rows = E.posting_timeline(tagged).orderBy("repost_index").collect()
    assert [(r.episode_start, r.n_other_dates, r.first_other_date, r.last_other_date) for r in rows] == [
        (day(0), 1, day(20), day(20)), (day(40), 1, day(10), day(10)), (day(75), 0, None, None)]


def test_documents_in_parts_hold_every_date(spark):
    dates = spark.range(500).select(
        F.when(F.col("id") < 450, "big").otherwise("small").alias("posting_id"),
        (F.lit(DAY0).cast("timestamp") + F.make_interval(days=(F.col("id") % 13).cast("int"))).alias("posting_date"),
        (F.lit(DAY0).cast("timestamp") + F.make_interval(mins=F.floor(F.col("id") / 20).cast("int"))).alias("captured_at"),
        F.floor(F.col("id") / 4).cast("int").alias("page"), (F.col("id") % 4).cast("int").alias("ordinal"))
    postings = spark.createDataFrame([("big",), ("small",), ("none",)], ["posting_id"])
    rows = posting_documents(postings, dates).orderBy("posting_id", "captured_at", "page").collect()
    whole = {}
    for r in rows:
        whole.setdefault(r.posting_id, []).extend(r.other_posting_dates)
    expected = {p: [r.posting_date for r in dates.where(F.col("posting_id") == p).orderBy("captured_at", "page", "ordinal").collect()] for p in ("big", "small", "none")}
    assert whole == expected
    assert max(len(r.other_posting_dates) for r in rows) == 4


PAGES = [(p, flag) for p, flag in enumerate([True, True, False, True, True], 1)]


@pytest.mark.parametrize("end_page, kept", [(None, [1, 2, 3]), (2, [1, 2]), (1, [1]), (0, [1]), (9, [1, 2, 3])])
def test_frontier(spark, end_page, kept):
    pages = spark.createDataFrame([(s, p, f or s == "b") for s in "ab" for p, f in PAGES], "source string, page int, found_new_info boolean")
    got = Fr.frontier_cutoff(pages, end_page)
    assert sorted(r.page for r in got.where("source = 'a'").collect()) == kept
    stop = 5 if end_page in (None, 9) else max(end_page, 1)
    assert sorted(r.page for r in got.where("source = 'b'").collect()) == list(range(1, stop + 1))


def _ordered(df):
    return sorted(map(str, df.select("source", "url", "posting_date", "captured_at", "page", "ordinal", "outcome", "posting_id", "episode_start", "repost_index").collect()))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_walk_goes_on_over_arrow_batches(spark, kind):
    """One key over several Arrow batches, with copies and missing dates, beside small keys, equals the fold by starts."""
    hot = [("a", "hot", (k * 7) % 211 if k % 50 else None, k // 2, 1, 0) for k in range(700)]
    rows = hot + hot[250:260] + [("a", f"u{k}", k, k, 1, 0) for k in range(40)] + [("a", "none", None, 1, 1, 0), ("a", "none", 5, 2, 1, 0), (None, "x", 1, 1, 1, 0)]
    day = "timestamp '2024-01-01' + make_interval(0, 0, 0, {})"
    df = spark.createDataFrame(rows, "source string, url string, d int, c int, page int, ordinal int").selectExpr(
        "source", "url", f"cast({day.format('d')} as {kind}) posting_date", f"{day.format('c')} captured_at", "page", "ordinal")
    table = spark.sql(f"SELECT 'a' source, 'u7' url, 'mine' posting_id, cast(timestamp '2023-12-20' as {kind}) posting_date")
    for known in (None, table):
        walked = E.posting_episodes(df, known)
        assert walked.schema["episode_start"].dataType.simpleString() == kind
        assert _ordered(walked) == _ordered(E.posting_episodes(df, known, fold_limit=300))


def test_episodes_move_the_sightings_once(spark):
    """Sightings of ordinary keys are shuffled once and not joined to their own starts."""
    rows = spark.range(100).selectExpr("'a' source", "concat('u', id % 9) url", "timestamp_seconds(id * 1000000) posting_date", "timestamp_seconds(id) captured_at", "1 page", "0 ordinal")
    plan = E.posting_episodes(rows, counted=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
