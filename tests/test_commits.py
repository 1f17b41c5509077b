"""The commit log, the change feed and what a crash leaves behind."""

from __future__ import annotations

import pytest
from pages import hit, html_cards, html_raw, json_page, json_raw
from pyspark.sql import functions as F

from relist.operators import validate
from relist.plans import jobs
from relist.sinks import commits, feed
from relist.sinks import tables as T
from relist.sources import tables as sources

RUN, NEXT = "2020-04-01 03:00:00", "2020-04-02 03:00:00"
SAVED_TABLES = ("postings", "posting_dates", "extract_errors", "changes", "page_runs", "run_stops")


class Crash(RuntimeError):
    pass


def pages(spark):
    """Two pages; the second brings an error and a listing seen before."""
    return json_raw(spark, json_page([hit(1), hit(2)]), json_page([hit(1), hit(3), hit(4, company=1)]))


def rows(df):
    return sorted(map(str, df.drop("created_at", "modified_at", "end_time", "start_time", "run_page_id", "batch_id", "commit_number").collect()))


def state(spark, root):
    found = {t: rows(T.read_table(spark, root, t)) for t in (*SAVED_TABLES, "run_page_events")}
    return found | {"current": rows(T.current_postings(spark, root)), "published": rows(feed.read_published(spark, root))}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The tables after an undisturbed run."""
    root = str(tmp_path_factory.mktemp("whole") / "tables")
    jobs.run_ingest(spark, root, pages(spark), 0, RUN).release()
    return state(spark, root)


def crash_at(monkeypatch, step):
    """End the job at a step: before or behind the write of a table, or before or behind a commit of a phase."""
    when, what = step.split(" ")
    write, commit = commits.Batch.write, commits.commit

    def failing_write(self, df, table, *more, **named):
        if when == "before" and what == table:
            raise Crash(step)
        write(self, df, table, *more, **named)
        if when == "behind" and what == table:
            raise Crash(step)

    def failing_commit(spark, root, parts, *more):
        if when == "before" and what == f"commit:{parts[0].phase}":
            raise Crash(step)
        number = commit(spark, root, parts, *more)
        if when == "behind" and what == f"commit:{parts[0].phase}":
            raise Crash(step)
        return number

    monkeypatch.setattr(commits.Batch, "write", failing_write)
    monkeypatch.setattr(commits, "commit", failing_commit)


UNSEEN = ["behind raw_pages", "behind postings", "before commit:saved"]
SEEN = ["behind commit:saved", "before commit:published"]


@pytest.mark.parametrize("step, again", [("behind raw_pages", 1), ("behind postings", 0), ("before commit:saved", 1), ("behind commit:saved", 1),
                                         ("before commit:published", 0)])
def test_a_crash_shows_nothing_half_and_loses_no_message(spark, root, whole, step, again):
    with pytest.MonkeyPatch.context() as patch:
        crash_at(patch, step)
        with pytest.raises(Crash):
            jobs.run_ingest(spark, root, pages(spark), 0, RUN)
    left = state(spark, root)
    if step in UNSEEN:
        assert not any(left[t] for t in (*SAVED_TABLES, "current", "published"))
    else:
        assert all(left[t] == whole[t] for t in (*SAVED_TABLES, "current"))
        assert left["published"] == []
    jobs.run_ingest(spark, root, pages(spark), again, RUN if again == 0 else NEXT).release()
    after = state(spark, root)
    if again == 0:
        assert after == whole
    elif step in UNSEEN:
        assert {t: after[t] for t in (*SAVED_TABLES, "current", "published")} == {t: whole[t] for t in (*SAVED_TABLES, "current", "published")}
    else:
        # The second batch finds all of it stored: its first page brings nothing new and ends the run.
        assert T.current_postings(spark, root).count() == 3
        published = feed.read_published(spark, root)
        assert rows(published.where("batch_id = 0")) == whole["published"]
        assert published.where("batch_id = 1").count() == 2
        assert published.groupBy("commit_number", "captured_at", "page", "ordinal", "key").count().where("count > 1").isEmpty()


def test_batches_worked_out_from_the_same_state_conflict(spark, root):
    """A second job that saw none of the first one's postings is refused; run again, it updates them."""
    commit, inside = commits.commit, []

    def overtaken(spark, root, parts, *more):
        if parts[0].phase == T.SAVED and parts[0].batch_id == 0:
            inside.append(jobs.run_ingest(spark, root, pages(spark), 1, NEXT))
        return commit(spark, root, parts, *more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(commits, "commit", overtaken)
        with pytest.raises(commits.CommitConflict, match="batch 1"):
            jobs.run_ingest(spark, root, pages(spark), 0, RUN)
    assert inside[0].totals.first().n_inserted == 3
    assert T.current_postings(spark, root).count() == 3
    result = jobs.run_ingest(spark, root, pages(spark), 2, NEXT)
    assert tuple(result.totals.select("n_inserted", "n_updated").first()) == (0, 2)


def test_a_number_is_taken_once(spark, root):
    folder = commits.Folder(spark, f"{root}/_commits")
    assert folder.create("00000000000000000001.json", {"parts": []})
    assert not folder.create("00000000000000000001.json", {"parts": [1]})
    assert folder.read("00000000000000000001.json") == {"parts": []}
    assert folder.names() == ["00000000000000000001.json"]
    assert commits.commit(spark, root, [commits.Part(1, "x", {})]) == 2


def test_checkpoints_of_the_log(spark, root, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT", 4)
    for k in range(11):
        commits.commit(spark, root, [commits.Part(k % 5, "x", {"t": [f"f{k}"]}, k)])
    assert [x for x in sorted(commits.Folder(spark, f"{root}/_commits").names()) if x.startswith("upto")] == [f"upto-{n:020d}.json" for n in (4, 8)]
    for upto in range(1, 12):
        expected = {}
        for k in range(upto):
            expected[k % 5] = f"f{k}"
        log = commits.read_log(spark, root, upto)
        assert log.number == upto and sorted(log.folders("t")) == sorted(expected.values())
        assert log.position("x") == upto - 1
    assert commits.read_log(spark, root).folders("t", before=3, after=0) == ["f6", "f7"]


def test_a_consumer_of_its_own(spark, root):
    """A consumer that fails gets the same messages again; each consumer has its own position."""
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(1)])), 0, RUN)
    taken = []

    def broken(messages):
        taken.append(messages.collect())
        raise Crash

    with pytest.raises(Crash):
        feed.publish_changes(spark, root, "queue", broken)
    assert feed.publish_changes(spark, root, "queue", lambda m: taken.append(m.collect())) == 1
    assert taken[0] == taken[1] and len(taken[0]) == 1
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(1), hit(2)])), 1, NEXT)
    assert feed.publish_changes(spark, root, "queue", lambda m: taken.append(m.collect())) == 1
    assert len(taken[2]) == 2 and {m.commit_number for m in taken[2]} != {taken[0][0].commit_number}
    assert feed.publish_changes(spark, root, "queue", taken.append) == 0
    with pytest.raises(ValueError):
        feed.publish_changes(spark, root, hand_on=taken.append)


def test_a_batch_of_messages_is_not_brought_together(spark, root):
    """Neither the commit number nor the layout of the messages needs a shuffle that has a task for each batch."""
    rows = spark.range(0, 4000, 1, 8).selectExpr(
        "string(id) key", "repeat(string(id), 20) value", "timestamp '2024-01-01' captured_at", "int(id) page", "0 ordinal", "'s' source", "string(id) url", "true opened")
    for number in (1, 2):
        T.write_batch(rows, root, "changes", number)
    log = commits.read_log(spark, root)
    messages = feed.read_changes(spark, root, feed.pending(log), log)
    assert "Exchange" not in messages._jdf.queryExecution().executedPlan().toString()
    assert messages.where("commit_number <> batch_id").isEmpty() and messages.count() == 8000
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        feed.publish_changes(spark, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert feed.read_published(spark, root).select(F.input_file_name()).distinct().count() > 4


def test_a_base_does_not_hide_a_batch_saved_again(spark, root):
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(1), hit(2)])), 0, RUN)
    T.compact_postings(spark, root, 0)
    assert T.committed_bases(spark, root) == [(0, "upto=0")]
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(1, jobTitle="Changed")])), 0, RUN)
    assert T.committed_bases(spark, root) == []
    assert [r.title for r in T.current_postings(spark, root).collect()] == ["Changed"]


def test_an_export_of_one_moment(spark, root):
    """Exported while a batch is between its phases: the copy has none of it, and goes on like the original did."""
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(3)), 0, RUN)
    before, commit = state(spark, root), commits.commit

    def exporting(spark, root, parts, *more):
        if parts[0].phase == T.SAVED:
            T.export_snapshot(spark, root, f"{root}-dump", "day", as_of=1 + moment)
        return commit(spark, root, parts, *more)

    moment = commits.read_log(spark, root).number
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(commits, "commit", exporting)
        jobs.run_ingest(spark, root, html_raw(spark, html_cards(4)), 1, NEXT)
    T.load_snapshot(spark, f"{root}-dump", "day", f"{root}-copy")
    copy = state(spark, f"{root}-copy")
    assert {k: v for k, v in copy.items() if k != "run_page_events"} == {k: v for k, v in before.items() if k != "run_page_events"}
    assert T.read_table(spark, f"{root}-copy", "raw_pages").count() == 2
    assert feed.publish_changes(spark, f"{root}-copy") == 0
    jobs.run_ingest(spark, f"{root}-copy", html_raw(spark, html_cards(4)), 1, NEXT)
    assert state(spark, f"{root}-copy")["current"] == state(spark, root)["current"]


def test_messages_that_wait_are_copied(spark, root):
    with pytest.MonkeyPatch.context() as patch:
        crash_at(patch, "behind commit:saved")
        with pytest.raises(Crash):
            jobs.run_ingest(spark, root, html_raw(spark, html_cards(3)), 0, RUN)
    T.export_snapshot(spark, root, f"{root}-dump", "day")
    T.load_snapshot(spark, f"{root}-dump", "day", f"{root}-copy")
    assert feed.read_published(spark, f"{root}-copy").count() == 0
    assert feed.publish_changes(spark, f"{root}-copy") == 1
    assert feed.read_published(spark, f"{root}-copy").count() == 3


def test_details_are_kept_from_batch_to_batch(spark, root):
    none = spark.createDataFrame([], "url string, html string")
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(2)).unionByName(json_raw(spark, json_page([hit(1), hit(2)]))), 0, RUN)
    assert jobs.run_details(spark, root, none, 0, RUN, ["ItViec"]).count() == 2
    assert T.read_table(spark, root, "details_backlog").count() == 2
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(3)), 1, NEXT)
    log = commits.read_log(spark, root)
    waiting = jobs.waiting_for_details(spark, root, 1, log)
    assert waiting.count() == 3
    # Batch 0 is not read again: what it left over is stored.
    files = [f for f in waiting.inputFiles() if "batch_id=0" in f]
    assert files and all("details_backlog" in f for f in files)
    # A batch that is saved again brings no posting twice.
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(2)).unionByName(json_raw(spark, json_page([hit(1), hit(2)]))), 0, RUN)
    assert jobs.run_details(spark, root, none, 1, NEXT).count() == 3
    details = T.read_table(spark, root, "posting_details")
    assert details.count() == details.select("posting_id").distinct().count() == 5
    assert T.read_table(spark, root, "details_backlog").where("batch_id = 1").isEmpty()
    assert jobs.run_details(spark, root, none, 1, NEXT).count() == 3


def rows_scanned(df):
    """Rows that the scans of a frame hand on when it is collected."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_few_keys_are_read_from_the_files_that_hold_them(spark, root):
    """A table of 40 files of 500 postings whose urls lie mixed, and a compacted base of it."""
    wide = spark.range(0, 20_000, 1, 40).select(
        F.sha2(F.col("id").cast("string"), 256).alias("posting_id"), F.lit("s").alias("source"), F.sha2((F.col("id") * 7).cast("string"), 256).alias("url"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in T.POSTING_ROW.fields if f.name not in ("posting_id", "source", "url")])
    T.write_batch(wide.select(*T.POSTING_ROW.fieldNames()), root, "postings", 0)
    urls = wide.where("id % 6000 = 5").select("source", "url")
    stored = T.read_table(spark, root, "postings")
    found = sources.lookup_postings_by_key(stored, "s", urls)
    assert sorted(r.url for r in found.collect()) == sorted(r.url for r in urls.collect())
    assert len(urls.collect()) == 4
    assert rows_scanned(found) <= 4 * 500 < 20_000 == rows_scanned(stored)
    assert T.current_postings(spark, root, keys=urls).count() == 4
    T.compact_postings(spark, root, 0)
    assert T.current_postings(spark, root, keys=urls).count() == 4
    assert T.current_postings(spark, root, keys=urls.where("false")).count() == 0
    assert T.current_postings(spark, root, keys=wide).count() == 20_000
    assert sources.lookup_postings_by_key(stored, "s", wide).count() == 20_000
    assert sources.lookup_postings_by_key(stored, "t", urls).count() == 0


def test_a_lookup_checks_its_bound(spark):
    postings = spark.createDataFrame([("1", "s", "u"), ("2", "s", "v"), ("3", "t", "u"), ("4", "s", "w"), ("5", "s", "w")], "posting_id string, source string, url string")
    urls = spark.createDataFrame([("u",), ("v",), ("u",), ("x",)], "url string")
    assert sorted(r.posting_id for r in validate.bounded_lookup(postings, "s", urls).collect()) == ["1", "2"]
    with pytest.raises(Exception, match="Several postings of one key: w"):
        validate.bounded_lookup(postings, "s", spark.createDataFrame([("w",)], "url string")).collect()


def test_folders_of_tries_that_failed_can_be_found(spark, root):
    T.Batch(spark, root, 0, T.SAVED).write(spark.createDataFrame([], T.POSTING_ROW), "postings")
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(1)), 0, RUN)
    unused = commits.unused_folders(spark, root, list(T.STORED), 1 << 62)
    assert len(unused) == 1 and "/postings/commit=" in unused[0]
    assert commits.unused_folders(spark, root, list(T.STORED), 0) == []
    assert T.read_table(spark, root, "postings").where(F.col("batch_id") == 0).count() == 1
