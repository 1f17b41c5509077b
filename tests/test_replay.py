"""The ends of runs found in one walk, against the rounds of the fixed point."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pages import CAPTURED, hit, json_page, raw_pages
from pyspark.sql import functions as F

from relist.operators import episodes, frontier, replay
from relist.plans import jobs
from relist.schemas import JSON_SOURCE

DAY0 = datetime(2020, 1, 1)


def crawls(spark, cases):
    """Pages and listings of random crawls, a source each: runs that begin together, pages numbered alike, copies of listings."""
    pages, rows, stored = [], [], []
    for case in range(cases):
        dice, source = random.Random(case), f"s{case}"
        urls = [f"u{k}" for k in range(dice.randint(1, 6))]
        stored += [(f"{source}-{u}", source, u, DAY0 + timedelta(days=dice.randint(0, 40))) for u in urls if dice.random() < 0.3]
        for run in range(dice.randint(1, 7)):
            run_at = DAY0 + timedelta(days=dice.choice([run, run, 0]) * 20)
            for k in range(dice.randint(1, 6)):
                page, ident = dice.choice([k + 1, k + 1, 1]), f"{source}-{run}-{k}"
                pages.append((ident, source, f"r{run}", page, run_at))
                for ordinal in range(dice.randint(0, 3)):
                    row = (ident, source, dice.choice(urls), page, dice.choice([ordinal, 0]), run_at, run_at + timedelta(days=dice.choice([-40, 0, 0, 5, 15])))
                    rows += [row] * dice.choice([1, 1, 1, 2])
    return (spark.createDataFrame(pages, "raw_page_id string, source string, run_id string, page int, run_at timestamp"),
            spark.createDataFrame(rows, "raw_page_id string, source string, url string, page int, ordinal int, captured_at timestamp, posting_date timestamp"),
            spark.createDataFrame(stored, "posting_id string, source string, url string, posting_date timestamp"))


@pytest.mark.parametrize("with_stored,end_page", [(False, None), (True, None), (True, 3)])
def test_one_walk_ends_runs_where_the_rounds_end_them(spark, tmp_path, with_stored, end_page):
    def keep(df, name):
        keep.n += 1
        df.write.parquet(path := f"{tmp_path}/{keep.n}-{name}")
        return spark.read.schema(df.schema).parquet(path)

    keep.n = 0
    pages, rows, stored = (keep(df, "in") for df in crawls(spark, 60))
    stored = stored if with_stored else None
    known = spark.createDataFrame([("s1", "r0", 1), ("s2", "r1", 2)], "source string, run_id string, stop_page int")
    fold = lambda df: episodes.posting_episodes(df, stored, 30)
    walk = lambda offered, rows: replay.run_ends(offered, rows, stored, 30, end_page)
    found = [[sorted(map(repr, df.collect())) for df in frontier.settle_runs(pages, rows, known, fold, end_page, keep, w)] for w in (None, walk)]
    assert found[0] == found[1]
    assert len(found[0][2]) > 50 and any("processed=False" in x for x in found[0][0])


def test_the_walk_is_left_to_the_rounds_where_it_is_not_the_way(spark):
    pages, rows, _ = crawls(spark, 5)
    assert replay.run_ends(pages, rows, None, 30, None) is not None
    assert replay.run_ends(pages, rows, None, 30, None, key_limit=3) is None
    assert replay.run_ends(pages, rows, None, 30, None, row_limit=10) is None
    assert replay.run_ends(pages.unionByName(pages.limit(1)), rows, None, 30, None) is None


def test_runs_that_depend_on_each_other_are_folded_twice(spark, root, monkeypatch):
    """Each run hides a listing behind its end that the next run then finds new: seven runs deep."""
    folds, fold = [], episodes.posting_episodes
    monkeypatch.setattr(episodes, "posting_episodes", lambda *args, **kw: folds.append(1) or fold(*args, **kw))
    pages, minute = [], 0
    for run in range(7):
        for page, listing in enumerate([2 * run + 1, 2 * run, 2 * run + 2, 2 * run + 3]):
            pages.append((f"{run}-{page}", page + 1, JSON_SOURCE, json_page([hit(listing)]), CAPTURED + timedelta(minutes=minute), f"run-{run}"))
            minute += 1
    offered = spark.createDataFrame(pages, "raw_page_id string, page int, source string, content string, captured_at timestamp, run_id string")
    result = jobs.run_ingest(spark, root, offered, 0, "2020-04-01 03:00:00")
    assert len(folds) == 2
    done = {r.raw_page_id for r in result.pages.select("raw_page_id").collect()}
    met, expected = set(), set()
    for run in range(7):
        for page, listing in enumerate([2 * run + 1, 2 * run, 2 * run + 2, 2 * run + 3]):
            expected.add(f"{run}-{page}")
            if listing in met:
                break
            met.add(listing)
    assert done == expected


def test_pages_that_are_runs_of_their_own_are_folded_once(spark, root, monkeypatch):
    """Every page without news ends its run, but closes no other page."""
    folds, fold = [], episodes.posting_episodes
    monkeypatch.setattr(episodes, "posting_episodes", lambda *args, **kw: folds.append(1) or fold(*args, **kw))
    pages = raw_pages(spark, [(JSON_SOURCE, 1 + k, json_page([hit(i)]), CAPTURED + timedelta(minutes=k)) for k, i in enumerate([1, 1, 2, 1, 2, 3])])
    result = jobs.run_ingest(spark, root, pages.withColumn("run_id", F.col("raw_page_id")), 0, "2020-04-01 03:00:00")
    assert len(folds) == 1 and result.pages.count() == 6
