from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pages import CAPTURED, card, hit, html_cards, html_page, html_raw, json_page, json_raw, raw_pages
from pyspark.sql import functions as F

from relist import schemas as S
from relist.operators import accounting as A
from relist.operators import episodes, skew
from relist.plans import jobs
from relist.schemas import HTML_SOURCE, JSON_SOURCE
from relist.sinks import feed
from relist.sinks import tables as T
from relist.sources import pages as P
from relist.sources import tables as sources
from relist.streaming.ingest import stream_ingest

RUN = "2020-04-01 03:00:00"


def counts(result):
    return tuple(result.totals.select("n_inserted", "n_updated", "n_errors").first())


def table(spark, root, name="postings"):
    return T.current_postings(spark, root) if name == "postings" else T.read_table(spark, root, name)


def test_html_run_takes_all_pages_while_all_is_new(spark, root):
    pages = html_raw(spark, html_cards(20), html_cards(20, start=20))
    assert counts(jobs.run_ingest(spark, root, pages, 0, RUN)) == (40, 0, 0)
    assert table(spark, root).count() == 40
    assert table(spark, root, "raw_pages").count() == 2


def test_run_stops_where_nothing_is_new(spark, root):
    first, second = html_cards(20), html_cards(20, start=20)
    jobs.run_ingest(spark, root, html_raw(spark, first), 0, RUN)
    result = jobs.run_ingest(spark, root, html_raw(spark, first, second), 1, "2020-04-02 03:00:00")
    assert counts(result) == (0, 20, 0)
    assert [r.page for r in result.pages.collect()] == [1]
    assert table(spark, root).count() == 20
    assert table(spark, root, "raw_pages").where("batch_id = 1").count() == 2
    marks = table(spark, root, "page_runs").where("batch_id = 1").collect()
    assert {r.page: r.processed for r in marks} == {1: True, 2: False}


def test_json_reingest_updates_in_place(spark, root):
    page = json_raw(spark, json_page([hit(7)]))
    jobs.run_ingest(spark, root, page, 0, RUN)
    before = table(spark, root).first()
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(7, jobTitle="Changed")])), 1, "2020-04-02 03:00:00")
    rows = table(spark, root).collect()
    assert len(rows) == 1
    after = rows[0]
    assert (after.posting_id, after.created_at, after.posting_date) == (before.posting_id, before.created_at, before.posting_date)
    assert after.modified_at > before.modified_at and after.title == "Changed"
    assert [r.posting_date for r in table(spark, root, "posting_dates").collect()] == [before.posting_date]


def test_repost_opens_another_posting(spark, root):
    at = 1577530825
    for batch, days in enumerate((0, 29, 30, 45, 10)):
        pages = json_raw(spark, json_page([hit(1, onlineDate=at + days * 86400)]), captured=CAPTURED + timedelta(days=batch))
        jobs.run_ingest(spark, root, pages, batch, datetime(2020, 4, 1 + batch))
    rows = table(spark, root).orderBy("posting_date").collect()
    assert [r.posting_date - rows[0].posting_date for r in rows] == [timedelta(0), timedelta(days=30)]
    docs = T.posting_documents(table(spark, root), table(spark, root, "posting_dates")).orderBy("captured_at", "page").collect()
    gaps = [[(d - rows[0].posting_date).days for x in docs if x.posting_id == r.posting_id for d in x.other_posting_dates] for r in rows]
    assert gaps == [[29], [45, 10]]


def test_duplicates_within_a_page_fold_into_one_posting(spark, root):
    pages = html_raw(spark, html_page([card(), card(title="Second")]))
    result = jobs.run_ingest(spark, root, pages, 0, RUN)
    assert counts(result) == (1, 1, 0)
    assert [r.title for r in table(spark, root).collect()] == ["Second"]


def test_same_url_in_two_sources(spark, root):
    spec = {s: S.SourceSpec(s, "https://same.example", "json", jobs.registry.extract_json_pages) for s in ("x", "y")}
    pages = raw_pages(spark, [("x", 1, json_page([hit(1)])), ("y", 1, json_page([hit(1)]))])
    assert counts(jobs.run_ingest(spark, root, pages, 0, RUN, specs=spec)) == (2, 0, 0)


def test_parameters(spark, root):
    pages = html_raw(spark, *[html_cards(2, start=10 * i) for i in range(5)]).unionByName(json_raw(spark, json_page([hit()])))
    result = jobs.run_ingest(spark, root, pages, 0, RUN, sources=[HTML_SOURCE], start_page=2, end_page=3)
    assert sorted((r.source, r.page) for r in result.pages.collect()) == [(HTML_SOURCE, 2), (HTML_SOURCE, 3)]
    assert counts(result) == (4, 0, 0)


def test_failed_batch_can_be_run_again(spark, root):
    pages = html_raw(spark, html_cards(3)).unionByName(json_raw(spark, json_page([hit(1), hit(2, company=1)])))
    first = counts(jobs.run_ingest(spark, root, pages, 0, RUN))
    again = counts(jobs.run_ingest(spark, root, pages, 0, RUN))
    assert first == again == (4, 0, 1)
    assert table(spark, root).count() == 4
    assert feed.read_published(spark, root).count() == 4
    assert table(spark, root, "extract_errors").count() == 1


def test_history(spark, root):
    pages = raw_pages(spark, [
        (HTML_SOURCE, 1, html_page([card(), card(path="/it-jobs/x-2", age="never")])), (HTML_SOURCE, 2, None), (HTML_SOURCE, 3, html_cards(1)),
        (JSON_SOURCE, 1, "not json"), (JSON_SOURCE, 2, json_page([hit()]))])
    result = jobs.run_ingest(spark, root, pages, 0, RUN, end_ts="2020-04-01 03:00:09")
    rows = {(r.source, r.page): r for r in jobs.run_history(spark, root).join(pages.select("raw_page_id", "page"), "raw_page_id").collect()}
    assert {k: r.status for k, r in rows.items()} == {(HTML_SOURCE, 1): "succeeded", (HTML_SOURCE, 2): "failed", (HTML_SOURCE, 3): "skipped",
                                                    (JSON_SOURCE, 1): "succeeded", (JSON_SOURCE, 2): "skipped"}
    done = rows[HTML_SOURCE, 1]
    assert (len(done.new_ids), len(done.existing_ids), len(done.error_ids)) == (1, 0, 1)
    assert (done.end_time - done.start_time).seconds == 9
    assert rows[HTML_SOURCE, 2].run_error == "Page has no content"
    assert len(rows[JSON_SOURCE, 1].error_ids) == 1
    assert counts(result) == (1, 0, 2)
    assert table(spark, root, "raw_pages").count() == 4


def test_open_page_counts_as_running(spark):
    pages = html_raw(spark, html_cards(1), html_cards(1))
    none = F.array().cast("array<string>")
    ids = pages.where("page = 1").select("raw_page_id", none.alias("new_ids"), none.alias("existing_ids"), none.alias("error_ids"))
    events = A.open_run_page(pages, RUN).unionByName(A.close_run_page(pages.where("page = 1"), ids, RUN, RUN))
    rows = A.run_page_status(A.run_page_view(events)).collect()
    assert sorted(r.status for r in rows) == ["running", "succeeded"]


def test_replay_in_a_time_range(spark, root):
    pages = raw_pages(spark, [(JSON_SOURCE, d, json_page([hit(d), hit(0)]), CAPTURED + timedelta(days=d)) for d in range(1, 6)])
    T.append_raw_page(pages, root, 0)
    result = jobs.run_replay(spark, root, JSON_SOURCE, 1, RUN, start_ts="2020-04-02T10:00:00", end_ts="2020-04-04T10:00")
    assert counts(result) == (4, 2, 0)
    assert table(spark, root, "run_page_events").count() == 0
    assert table(spark, root, "raw_pages").count() == 5
    again = jobs.run_replay(spark, root, JSON_SOURCE, 2, "2020-04-05 03:00:00", start_ts="2020-04-02T10:00:00", end_ts="2020-04-04T10:00")
    assert counts(again) == (0, 6, 0)
    with pytest.raises(ValueError):
        jobs.run_replay(spark, root, JSON_SOURCE, 3, RUN, start_ts="2020-04-02")


def test_messages(spark, root):
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(3)])), 0, RUN)
    row = feed.read_published(spark, root).first()
    posting = table(spark, root).first()
    assert row.key == posting.posting_id
    assert row.value == ('{"_id":"%s","url":"https://www.vietnamworks.com/role-3-3-jv","title":"Role 3","tags":["A","B"],'
                         '"postingDate":1577530825000,"company":"Company","locations":["Ho Chi Minh"],"rawJobSourceName":"VietnamWorks"}'
                         % posting.posting_id)


def test_details(spark, root):
    found = spark.createDataFrame([("https://itviec.com/it-jobs/listing-0", "<html><body>zero</body></html>"),
                                   ("https://itviec.com/it-jobs/listing-1", "no tags")], "url string, html string")
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(3)), 0, RUN)
    assert table(spark, root, "posting_details").count() == 0
    rows = jobs.run_details(spark, root, found, 0, RUN).collect()
    assert sorted((r.html, r.error) for r in rows if r.html) == [("<body>no tags</body>", None), ("<body>zero</body>", None)]
    assert [r.error for r in rows if not r.html] == ["No detail page captured"]
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(4)), 1, "2020-04-02 03:00:00", with_details=True, detail_pages=found)
    assert table(spark, root, "posting_details").groupBy("posting_id").count().where("count > 1").isEmpty()
    assert table(spark, root, "posting_details").count() == 4


def test_stream_equals_batch_equals_replay(spark, tmp_path):
    """Three pages as micro-batches, as one batch and replayed end in the same postings."""
    def content(i):
        return json_page([hit(100 + i), hit(1, onlineDate=1577530825 + i * 20 * 86400), hit(2)])

    pages = raw_pages(spark, [(JSON_SOURCE, i, content(i), CAPTURED + timedelta(days=i)) for i in range(1, 5)])
    incoming = str(tmp_path / "incoming")
    for i in range(1, 5):
        pages.where(F.col("page") == i).coalesce(1).write.mode("append").parquet(incoming)
    roots = {k: str(tmp_path / k) for k in ("stream", "batch", "replay")}
    stream = P.stream_raw_pages(spark, incoming, files_per_batch=1)
    reported = []
    stream_ingest(stream, roots["stream"], str(tmp_path / "checkpoint"), clock=lambda b: RUN,
                  report=lambda b, totals: reported.append((b, totals.n_inserted, totals.n_errors))).awaitTermination()
    assert [b for b, _, _ in reported] == [0, 1, 2, 3]
    assert sum(n for _, n, _ in reported) == 7
    jobs.run_ingest(spark, roots["batch"], pages, 0, RUN)
    T.append_raw_page(pages, roots["replay"], 0)
    jobs.run_replay(spark, roots["replay"], JSON_SOURCE, 1, RUN)

    def state(root):
        docs = T.posting_documents(T.current_postings(spark, root), T.read_table(spark, root, "posting_dates"))
        return sorted(map(str, docs.drop("created_at", "modified_at").collect()))

    assert T.current_postings(spark, roots["batch"]).count() == 7
    assert state(roots["stream"]) == state(roots["batch"]) == state(roots["replay"])
    assert T.read_table(spark, roots["stream"], "postings").select("batch_id").distinct().count() == 4


def json_pages(spark, *ids_at, run=None):
    """One JSON page per (listing id, minute of its capture), numbered from 1."""
    pages = raw_pages(spark, [(JSON_SOURCE, 1 + k, json_page([hit(i)]), CAPTURED + timedelta(minutes=at)) for k, (i, at) in enumerate(ids_at)])
    pages = pages.withColumn("raw_page_id", F.concat_ws("-", "raw_page_id", "captured_at"))
    return pages if run is None else pages.withColumn("run_id", F.lit(run))


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_micro_batches_do_not_decide_where_a_run_ends(spark, tmp_path, files):
    """Page 2 repeats page 1: the run ends there, however the pages arrive; all of them are landed."""
    pages, root = json_pages(spark, (1, 0), (1, 1), (3, 2), (4, 3)), str(tmp_path / "tables")
    for k in range(1, 5):
        pages.where(F.col("page") == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "incoming"))
    stream = P.stream_raw_pages(spark, str(tmp_path / "incoming"), files_per_batch=files)
    stream_ingest(stream, root, str(tmp_path / "checkpoint"), clock=lambda b: RUN, compact_every=2).awaitTermination()
    assert table(spark, root).count() == 1
    assert table(spark, root, "raw_pages").count() == 4
    assert {r.page: r.processed for r in table(spark, root, "page_runs").collect()} == {1: True, 2: True, 3: False, 4: False}


def test_runs_of_two_days_offered_together(spark, root):
    """The second day ends at its first page; that does not cut the first day short."""
    first = json_pages(spark, (1, 0), (2, 1), (3, 2))
    second = json_pages(spark, (1, 24 * 60), (9, 24 * 60 + 1))
    result = jobs.run_ingest(spark, root, first.unionByName(second), 0, RUN)
    assert counts(result) == (3, 1, 0)
    assert table(spark, root, "raw_pages").count() == 5
    assert result.pages.count() == 4


def test_what_lies_behind_a_stop_is_unknown_to_later_runs(spark, root):
    """Listing 5 stands behind the end of the first two runs, so the third run finds it new and goes on to listing 6."""
    runs = [json_pages(spark, (1, 0), (1, 1), (5, 2), run="a"), json_pages(spark, (2, 60), (1, 61), (5, 62), run="b"), json_pages(spark, (5, 120), (6, 121), run="c")]
    result = jobs.run_ingest(spark, root, runs[0].unionByName(runs[1]).unionByName(runs[2]), 0, RUN)
    assert counts(result) == (4, 2, 0)
    assert sorted((r.run_id, r.page) for r in result.pages.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("c", 2)]


def test_pages_of_a_run_arrive_by_number(spark, root):
    """Captured in reverse; page 3 is a copy of page 1."""
    result = jobs.run_ingest(spark, root, json_pages(spark, (1, 3), (2, 2), (1, 1)), 0, RUN)
    assert counts(result) == (2, 1, 0)


def test_an_unfinished_base_is_not_taken_for_the_table(spark, root):
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(5)), 0, RUN)
    spark.createDataFrame([], T.POSTING_ROW).write.parquet(f"{root}/postings_base/upto=0/_temporary/0")
    assert table(spark, root).count() == 5
    assert counts(jobs.run_ingest(spark, root, html_raw(spark, html_cards(5)), 1, RUN)) == (0, 5, 0)
    T.compact_postings(spark, root, 0)
    T.compact_postings(spark, root, 1)
    assert T.committed_bases(spark, root) == [(0, "upto=0-1"), (1, "upto=1")]
    assert table(spark, root).count() == 5


def test_failures_leave_a_trace(spark, root):
    """A page of an unknown source, one without content, one that is no JSON; then an extractor that fails."""
    pages = raw_pages(spark, [("Other", 1, "{}"), (HTML_SOURCE, 1, None), (JSON_SOURCE, 1, "not json")])
    result = jobs.run_ingest(spark, root, pages, 0, RUN)
    assert counts(result) == (0, 0, 1)
    assert [r.source for r in table(spark, root, "quarantined_pages").collect()] == ["Other"]
    assert sorted((r.source, r.status) for r in jobs.run_history(spark, root).collect()) == [(HTML_SOURCE, "failed"), (JSON_SOURCE, "succeeded")]

    def broken(_):
        raise RuntimeError("broken")

    specs = {HTML_SOURCE: S.SourceSpec(HTML_SOURCE, "", "html", broken)}
    with pytest.raises(RuntimeError):
        jobs.run_ingest(spark, root, html_raw(spark, html_cards(2)), 1, "2020-04-02 03:00:00", specs=specs)
    assert table(spark, root, "raw_pages").where("batch_id = 1").count() == 1
    assert jobs.run_history(spark, root).where("status = 'running'").count() == 1


def test_arguments_are_checked(spark, root):
    pages = html_raw(spark, html_cards(1))
    with pytest.raises(ValueError, match="Typo"):
        jobs.run_ingest(spark, root, pages, 0, RUN, sources=["Typo"])
    with pytest.raises(ValueError, match="Typo"):
        jobs.run_replay(spark, root, "Typo", 0, RUN)
    with pytest.raises(ValueError, match="detail_pages"):
        jobs.run_ingest(spark, root, pages, 0, RUN, with_details=True)
    with pytest.raises(ValueError, match="gap_days"):
        jobs.run_ingest(spark, root, pages, 0, RUN, gap_days=0)


def test_details_of_the_sources_of_the_run(spark, root):
    none = spark.createDataFrame([], "url string, html string")
    jobs.run_ingest(spark, root, json_raw(spark, json_page([hit(1), hit(2)])), 0, RUN)
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(3)), 1, RUN, sources=[HTML_SOURCE], with_details=True, detail_pages=none)
    assert table(spark, root, "posting_details").count() == 3


def test_a_copy_works_on_like_the_original(spark, root):
    for batch, start in enumerate((0, 1)):
        jobs.run_ingest(spark, root, html_raw(spark, html_cards(3, start=start)).unionByName(json_raw(spark, json_page([hit(batch)]))), batch, RUN)
    T.export_snapshot(spark, root, f"{root}-dump", "2020-04-09")
    T.load_snapshot(spark, f"{root}-dump", "2020-04-09", f"{root}-copy")
    after = [counts(jobs.run_ingest(spark, r, html_raw(spark, html_cards(5)), 2, "2020-04-03 03:00:00")) for r in (root, f"{root}-copy")]
    assert after[0] == after[1] == (1, 4, 0)
    for name in ("postings", "posting_dates", "raw_pages", "run_page_events", "page_runs", "run_stops", "extract_errors"):
        rows = [sorted(map(str, table(spark, r, name).drop("end_time", "modified_at").collect())) for r in (root, f"{root}-copy")]
        assert rows[0] == rows[1], name
    with pytest.raises(Exception):
        T.load_snapshot(spark, f"{root}-dump", "2020-04-09", f"{root}-copy")


def test_compaction_and_snapshot(spark, root):
    for batch, start in enumerate((0, 1, 2)):
        jobs.run_ingest(spark, root, html_raw(spark, html_cards(3, start=start)), batch, datetime(2020, 4, 1 + batch))
    before = sorted(map(str, table(spark, root).collect()))
    T.compact_postings(spark, root, 1)
    assert sorted(map(str, table(spark, root).collect())) == before
    jobs.run_ingest(spark, root, html_raw(spark, html_cards(3, start=3)), 3, datetime(2020, 4, 9))
    assert table(spark, root).count() == 6
    T.export_snapshot(spark, root, f"{root}-dump", "2020-04-09")
    back = sources.restore_snapshot(spark, f"{root}-dump", "2020-04-09", "postings", T.POSTING_ROW)
    assert back.count() == 6
    with pytest.raises(Exception, match="already exists"):
        T.export_snapshot(spark, root, f"{root}-dump", "2020-04-09")


def test_stage_tables_are_released(spark, root):
    result = jobs.run_ingest(spark, root, html_raw(spark, html_cards(1)), 0, RUN)
    assert T.exists(spark, result.stage)
    result.release()
    assert not T.exists(spark, result.stage)


def test_conform(spark):
    rows = spark.createDataFrame([("p", "1", "s", "c", "2020-01-01 00:00:00", 9), ("q", "x", "s", None, "2020-01-01 00:00:00", 9)],
                                 "raw_page_id string, page string, source string, content string, captured_at string, more int")
    good, bad = sources.split_conforming(rows, S.RAW_PAGE)
    assert good.columns == S.RAW_PAGE.fieldNames() and good.count() == 1
    assert bad.first().violations == ["page", "content"]
    with pytest.raises(Exception, match="Missing or mistyped fields: page, content"):
        sources.conform_schema(rows, S.RAW_PAGE).collect()


def test_source_filters(spark):
    pages = raw_pages(spark, [("a", 1, ""), ("b", 2, ""), ("c", 3, "")])
    assert P.select_sources(pages, []).count() == 3
    assert P.select_sources(pages, ["a", "c"]).count() == 2
    assert [r.page for r in P.page_range(pages, 2, 1).collect()] == [2]
    assert P.unknown_sources(pages, ["a"]).count() == 2


def test_page_files(spark, tmp_path):
    for n in (1, 12):
        (tmp_path / f"list_{n}.html").write_text(html_cards(n))
    files = P.read_page_files(spark, str(tmp_path))
    landed = P.land_html_list_page(files, HTML_SOURCE).orderBy("page").collect()
    assert [(r.page, r.content.count('class="job ')) for r in landed] == [(1, 1), (12, 12)]


def test_scan_prunes_and_pushes_down(spark, root):
    T.append_raw_page(html_raw(spark, html_cards(1)), root, 0)
    scan = P.scan_raw_pages(T.read_table(spark, root, "raw_pages"), HTML_SOURCE, "2020-03-31T00:00:00").select("raw_page_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "source#" in plan.split("PartitionFilters")[1] and "capture_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(captured_at" in plan
    assert "content" not in plan.split("ReadSchema")[1]


def test_totals_are_counted_while_writing(spark, root):
    """They equal the grouped counts, also of a batch without listings, and reading them starts no job over the stage tables."""
    for batch, pages in enumerate((json_pages(spark, (1, 0), (2, 1), (2, 2)), json_pages(spark, (1, 24 * 60)), json_pages(spark, (1, 0)).where("false"))):
        result = jobs.run_ingest(spark, root, pages, batch, RUN)
        counted = A.replay_totals(A.page_outcome_counts(result.tagged, result.errors)).first()
        result.release()
        assert result.totals.columns == list(A.TOTALS)
        assert result.totals.first() == counted


def test_keys_are_counted_once_however_many_rounds(spark, root, monkeypatch):
    counted, count = [], skew.larger_keys
    for module in (skew, episodes):
        monkeypatch.setattr(module, "larger_keys", lambda *args, **kw: counted.append(1) or count(*args, **kw))
    folds, fold = [], episodes.posting_episodes
    monkeypatch.setattr(episodes, "posting_episodes", lambda *args, **kw: folds.append(1) or fold(*args, **kw))
    result = jobs.run_ingest(spark, root, html_raw(spark, html_cards(1), html_cards(1), html_cards(1)), 0, RUN)
    assert result.pages.count() == 2 and len(folds) > 1 and len(counted) == 1


def test_a_table_without_batches_is_empty_in_the_plan(spark, root):
    rows = T.read_table(spark, root, "postings")
    plan = spark.range(3).join(rows, F.col("id") == F.col("batch_id"), "left")._jdf.queryExecution().optimizedPlan().toString()
    assert rows.isEmpty() and "Join" not in plan
