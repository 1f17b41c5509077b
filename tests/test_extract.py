from __future__ import annotations

import os
import random
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pages import CAPTURED, card, hit, html_cards, html_page, html_raw, json_page, json_raw, raw_pages
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from relist.operators import extract_html as H
from relist.operators import extract_json as J
from relist.operators import parsers
from relist.operators import registry as R
from relist.operators import validate as V
from relist.operators.html_elements import TOKEN, Finder, Page, Walker, compile_path
from relist.schemas import CARD_PATH, HTML_SOURCE, JSON_SOURCE


def checked(pages):
    return V.required_fields_check(R.extract_pages(pages)).orderBy("source", "page", "ordinal").collect()


def test_html_page_gives_all_cards_in_order(spark):
    rows = checked(html_raw(spark, html_cards(20), html_cards(20, start=20)))
    assert [r.url for r in rows] == [f"https://itviec.com/it-jobs/listing-{i}" for i in range(40)]
    assert [r.ordinal for r in rows] == [*range(20)] * 2
    assert all(r.errors == [] and r.raw_fragment is None for r in rows)
    first = rows[0]
    assert (first.title, first.tags, first.company, first.locations) == ("Title 0", ["Java", "SQL"], "ACME", ["City"])
    assert first.posting_date == datetime(2020, 3, 28, 10)


CARDS = [
    (card(path=None), dict(url="https://itviec.com/", title="Title"), []),
    (card(title=None), dict(url=None, title=None), ["Missing url", "Missing title"]),
    (card(title=""), dict(title=""), []),
    (card(tags=()), dict(tags=None), ["Missing tags"]),
    (card(tags=(" Java", "Java ", "SQL\n")), dict(tags=["Java", "SQL"]), []),
    (card(age="yesterday"), dict(posting_date=None), ["Missing posting date"]),
    (card(age=None), dict(posting_date=None), ["Missing posting date"]),
    (card(age="99999999999 days ago"), dict(posting_date=None), ["Missing posting date"]),
    (card(company=None), dict(company=None), ["Missing company"]),
    (card(company="/companies/ ACME &amp; Co "), dict(company="ACME & Co"), []),
    (card(company=" /companies/X"), dict(company="/companies/X"), []),
    (card(city=None), dict(locations=None), ["Missing locations"]),
    (card(city=" Ha\t Noi "), dict(locations=["Ha Noi"]), []),
    (card(path=" //it-jobs/y\n"), dict(url="https://itviec.com//it-jobs/y"), []),
    (card(title="A <b>bold</b><br>claim &lt;x&gt;"), dict(title="A bold claim <x>"), []),
    (card(title=None, tags=(), age=None, company=None, city=None), {},
     ["Missing url", "Missing title", "Missing tags", "Missing posting date", "Missing company", "Missing locations"]),
]


def test_card_fields(spark):
    rows = checked(html_raw(spark, html_page([c for c, _, _ in CARDS])))
    assert len(rows) == len(CARDS)
    for row, (source, values, errors) in zip(rows, CARDS):
        assert row.errors == errors
        assert {k: row[k] for k in values} == values
        assert row.raw_fragment == (source.strip() if errors else None)


def test_blank_fields_can_be_rejected(spark):
    pages = html_raw(spark, html_page([card(title="")]))
    assert V.required_fields_check(R.extract_pages(pages), reject_blank=True).first().errors == ["Missing title"]


@pytest.mark.parametrize("content", ["", "<html></html>", "plain text", '<div class="job">outside</div>',
                                     '<div id=jobs><div id="search-results"><div class=job></div></div></div>'])
def test_pages_without_cards_give_nothing(spark, content):
    assert checked(html_raw(spark, content)) == []


def test_nested_and_scripted_cards():
    path = compile_path("#search-results #jobs div.job")
    html = ('<div id="search-results"><script>"<div id=jobs><div class=job>"</script><!-- <div class="job"> -->'
            "<section><div id='jobs'><p>text<div class='a job b'>1<div class=job>2</div></div><span class=job>no</span></div></section></div>"
            "<div class=job>outside</div>")
    page = Page(html)
    assert [page.text(i) for i in page.select(path)] == ["1 2", "2"]


@pytest.mark.parametrize("html", [
    "<div class=job>1<a>x</a><p><a>y<div class=job>2<a>z</div></div><a>out</a>", "<title>a &lt;div class=job></title><div class=job><a>b</div>",
    "<div class=job><script>'<a>'</script><textarea><a></textarea><a>c</a></div><div class=job>", "<a><div class='job' ><b><a>d", "", "<!--<div class=job>"])
def test_one_walk_finds_what_each_path_finds(html):
    paths = ["a", "div.job > a", "b a", None]
    page, finder = Page(html), Finder("div.job", paths)
    each = [(r, [[r] if p is None else page.select(compile_path(p), r) for p in paths]) for r in page.select(compile_path("div.job"))]
    assert finder.find(page) == finder.find(page) == each


ODD_PARTS = [
    '<div class=r>', '<div class="r x">', '</div>', '<p>', '</p>', '<li>', '</li>', '<ul>', '</ul>', '<a href="u>v" id=q>', '<a href=u>', '</a>', '<b>',
    '</b>', '<br>', '<img class=i src="a>b">', ' text ', 'a &amp; b', '<!-- <div class=r> -->', '<!-->', '< 3', '<title>t<b>x</title>', '<td>', '<tr>',
    '</table>', '<span class=s title=\'<b>\'>', '</span>', '<a b="', '"', '>', '<textarea>a<p>', '</textarea>', '<a <b>', '</div x="a>b">', '\n\t', '</ >']


@pytest.mark.parametrize("root", ["div.r", "body div", "p", "a", "li", "title", "ul > li"])
def test_a_walk_without_a_page_gives_the_same_values(root):
    paths, whats = ["a", ".s", "li", "div > p", ".i", None, None, "ul li a", "textarea"], ["@href", "text", "text", "text", "@src", "text", "outer", "outer", "text"]
    walker, finder, dice, walked = Walker(root, paths), Finder(root, paths), random.Random(root), 0
    for _ in range(1500):
        html = "".join(dice.choices(ODD_PARTS, k=dice.randrange(1, 40)))
        page, pieces = Page(html), TOKEN.split(html)
        found = walker.find(pieces)
        if found is None:
            continue
        walked += 1
        values = [[[e.read(pieces, w, walker.seen) for e in x] for x, w in zip(each, whats)] for each in found]
        assert values == [[[page.read(i, w) for i in x] for x, w in zip(each, whats)] for _, each in finder.find(page)], html
    assert walked > 1000


def test_a_tag_is_understood_once():
    seen = {}
    for _ in range(3):
        Page("<div class=job><a href=x>t</a><a href=x>u</a></div>", seen)
    assert sorted(seen) == ["</a>", "</div>", "<a href=x>", "<div class=job>"]
    assert [Page("<title>a<b>&amp;</title><p>c", seen).text(i) for i in (0, 1)] == ["a<b>&", "c"]


def test_unclosed_tags():
    page = Page("<ul><li><b>one<li>two</ul><p>x<p>y<div>z")
    assert [page.text(i) for i in page.select(compile_path("li"))] == ["one", "two"]
    assert [page.text(i) for i in page.select(compile_path("p"))] == ["x", "y"]
    assert [page.read(i, "outer") for i in page.select(compile_path("div"))] == ["<div>z"]


def test_attributes():
    page = Page("<a HREF='x&amp;y' title=\"a>b\" data-x=1 disabled href=z>t</a><img src=a.png><br/>")
    a = page.select(compile_path("a"))[0]
    assert [page.read(a, w) for w in ("@href", "@title", "@data-x", "@disabled", "@none", "text")] == ["x&y", "a>b", "1", "", "", "t"]


@pytest.mark.parametrize("html, body", [
    ("<html><head></head><body class=x>a<p>b</body></html>", "<body class=x>a<p>b</body>"),
    ("<html><BODY>a<script>'</body>'</script>b</BODY></html>", "<BODY>a<script>'</body>'</script>b</BODY>"),
    ("<html><body>never closed\n", "<body>never closed\n"),
    ("<!DOCTYPE html><html><head><title>t</title></head><p>no body", "<body><p>no body</body>"),
    ("text only", "<body>text only</body>"),
])
def test_body(spark, html, body):
    assert spark.createDataFrame([(html,)], ["h"]).select(H.html_body(F.col("h")).alias("b")).first().b == body


def test_json_page_gives_all_hits(spark):
    rows = checked(json_raw(spark, json_page([hit(i) for i in range(50)])))
    assert [r.ordinal for r in rows] == [*range(50)]
    assert all(r.errors == [] for r in rows)


def test_json_field_values(spark):
    # The one listing whose record is given.
    row = checked(json_raw(spark, json_page([hit(
        1199830, alias="application-support-specialist-3", jobTitle="Application Support Specialist", company="Home Credit Vietnam",
        skills=["End-User Support", "It Helpdesk", "Technical Support", "System Support", "It Support"])])))[0]
    assert row.url == "https://www.vietnamworks.com/application-support-specialist-3-1199830-jv"
    assert row.title == "Application Support Specialist"
    assert sorted(row.tags) == ["End-User Support", "It Helpdesk", "It Support", "System Support", "Technical Support"]
    assert row.posting_date == datetime(2019, 12, 28, 11, 0, 25)
    assert (row.company, row.locations, row.source) == ("Home Credit Vietnam", ["Ho Chi Minh"], JSON_SOURCE)


def test_json_bad_pages(spark):
    two = '{"results":[{"hits":[%s]},{"hits":[%s]}]}' % ('{"jobTitle":"first"}', '{"jobTitle":"second"}')
    rows = checked(json_raw(spark, "not json", "{}", '{"results":[]}', '{"results":[{"hits":[]}]}', '{"results":[{"hits":{"a":1}}]}', two, "null"))
    assert [(r.page, r.raw_fragment) for r in rows if r.page_error] == [(1, "")]
    assert rows[0].errors[0].startswith("Cannot parse job source as json. Failure message: ")
    assert [(r.page, r.title) for r in rows if not r.page_error] == [(6, "first")]


HITS = [
    (hit(alias=12), ["Missing url"]),
    (hit(alias=None), ["Missing url"]),
    (hit(alias=...), ["Missing url"]),
    (hit(jobId="7"), []),
    (hit(jobId="x"), ["Missing url"]),
    (hit(skills=["a", 1]), ["Missing tags"]),
    (hit(skills=["a", None]), ["Missing tags"]),
    (hit(skills=[]), ["Missing tags"]),
    (hit(skills="a"), ["Missing tags"]),
    (hit(onlineDate=...), ["Missing posting date"]),
    (hit(onlineDate="1577530825"), []),
    (hit(onlineDate=1.5), ["Missing posting date"]),
    (hit(company=5), ["Missing company"]),
    (hit(locations=[], jobTitle=None), ["Missing title", "Missing locations"]),
    ({}, ["Missing url", "Missing title", "Missing tags", "Missing posting date", "Missing company", "Missing locations"]),
    (5, ["Missing url", "Missing title", "Missing tags", "Missing posting date", "Missing company", "Missing locations"]),
]


def test_strict_types(spark):
    rows = checked(json_raw(spark, json_page([h for h, _ in HITS])))
    assert [r.errors for r in rows] == [e for _, e in HITS]
    assert rows[-1].raw_fragment == "5"


def test_routes(spark):
    rows = V.required_fields_check(R.extract_pages(json_raw(spark, json_page([hit(1), hit(2, company=5)]), "bad")))
    valid, errors = V.route_valid(rows).collect(), V.route_errors(rows).collect()
    assert [r.title for r in valid] == ["Role 1"]
    assert sorted(len(r.errors) for r in errors) == [1, 1]
    assert len({r.error_id for r in errors}) == 2


def test_page_without_content_gives_nothing(spark):
    assert checked(raw_pages(spark, [(HTML_SOURCE, 1, None), (JSON_SOURCE, 1, None)])) == []


def test_unknown_source_raises(spark):
    with pytest.raises(Exception, match="Unknown source: Other"):
        R.extract_pages(raw_pages(spark, [("Other", 1, "{}")])).collect()


def test_python_runs_once_per_page(spark):
    """The optimizer must not evaluate the extractor a second time for a filter of its own."""
    plan = R.extract_html_pages(html_raw(spark, html_cards(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_json_is_parsed_once_per_page(spark):
    plan = J.explode_json_hits(json_raw(spark, json_page([hit()])).where("page > 0"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_capture_time_is_the_reference_of_ages(spark):
    later = CAPTURED.replace(year=2021)
    pages = html_raw(spark, html_cards(1)).unionByName(html_raw(spark, html_cards(1), captured=later))
    assert {r.posting_date for r in checked(pages)} == {datetime(2020, 3, 28, 10), datetime(2021, 3, 28, 10)}


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Python workers that cannot import the package still run the extractor."""
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from relist import build_session
from relist.operators.extract_html import html_select_all
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
spark = build_session("away", "local[1]")
print("found", spark.createDataFrame([("<p id=x>a<p>b",)], ["h"]).select(html_select_all(F.col("h"), "p").alias("p")).first().p)
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "found ['a', 'b']" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("attributes", ["data-n=O'Brien", 'data-n=5"', "data-n='a\"b'", 'data-n="it\'s"', "it's", '"', "data-n=", "data-n = 'x > y'", "alt=x/"])
def test_stray_quotes_do_not_swallow_cards(spark, attributes):
    """A quote opens a value only behind the equals sign; elsewhere it is a character like others."""
    page = f"<div id=search-results><div id=jobs><div class=job {attributes}>a</div><div class=job>b, it's</div><div class='job'>c</div></div></div>"
    rows = spark.createDataFrame([(page,)], "content string").select(H.html_select_all(F.col("content"), CARD_PATH).alias("t"))
    assert rows.first().t == ["a", "b, it's", "c"]


@pytest.fixture()
def pairs():
    def parse(content):
        for k, part in enumerate(content.split(" ")):
            if part == "fail":
                raise KeyError(part)
            yield {"title": part, "tags": [part, 1], "company": k, "raw_fragment": part}

    return parsers.table_parser(parse)


def test_parser_as_a_table_function(spark, pairs):
    """Fields as asked for, strictly typed; a failing page keeps what was found before; null texts give nothing."""
    spark.udtf.register("parse_pairs", pairs)
    pages = spark.createDataFrame([(1, "a b"), (2, "c fail d"), (3, None), (4, "")], "page int, content string")
    rows = spark.sql("SELECT page, l.* FROM {p}, LATERAL parse_pairs(content, 'title, company, tags[]') l ORDER BY page, ordinal", p=pages)
    assert rows.columns == ["page", "ordinal", "title", "company", "tags", "raw_fragment", "page_error"]
    assert [tuple(r) for r in rows.collect()] == [
        (1, 0, "a", None, ["a", None], "a", None), (1, 1, "b", None, ["b", None], "b", None),
        (2, 0, "c", None, ["c", None], "c", None), (2, 1, None, None, None, "", "Cannot parse page: KeyError: 'fail'"),
        (4, 0, "", None, ["", None], "", None)]
    assert spark.sql("SELECT * FROM parse_pairs('x', 'title')").columns == ["ordinal", "title", "raw_fragment", "page_error"]


@pytest.mark.parametrize("call", ["parse_pairs('x', '')", "parse_pairs(1, 'title')", "parse_pairs('x', NULL)"])
def test_arguments_of_a_parser_are_checked(spark, pairs, call):
    spark.udtf.register("parse_pairs", pairs)
    with pytest.raises(AnalysisException):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_names_of_table_functions_are_checked():
    with pytest.raises(ValueError):
        parsers.table_extractor("f(x); --", "https://a")


def test_a_number_beyond_all_characters_does_not_break_a_page(spark):
    """Python reads no number of more than 4300 digits; the standard has U+FFFD for it, and zeros in front do not count."""
    far, near = f"&#{'9' * 5000};", f"&#{'0' * 5000}65;"
    rows = checked(html_raw(spark, html_page([card(title=f"a{far}b{near}"), card(company=f"/companies/{far}x"), card()])))
    assert [(r.ordinal, r.title, r.company, r.errors) for r in rows] == [
        (0, "a\ufffdbA", "ACME", []), (1, "Title", "\ufffdx", []), (2, "Title", "ACME", [])]


def test_a_page_that_cannot_be_read_is_an_error_and_no_listing(spark, monkeypatch):
    class Breaks:
        def split(self, html):
            if "<broken>" in html:
                raise IndexError("no such piece")
            return self.token.split(html)

    token = Breaks()
    token.token = TOKEN
    monkeypatch.setattr(H, "TOKEN", token)
    pages = html_raw(spark, html_cards(2), "<broken>" + html_cards(2))
    message = "Cannot parse page: IndexError: no such piece"
    found = H.explode_html_cards(pages).orderBy("page", "ordinal").collect()
    assert [(r.ordinal, r.page_error) for r in found] == [(0, None), (1, None), (0, message)]
    assert all(found[2][f.name] is None for f in H.CARD_FIELDS)
    rows = checked(pages)
    assert [(r.page, r.errors) for r in rows] == [(1, []), (1, []), (2, [message])]
    assert rows[2].raw_fragment == "" and rows[2].page_error == message
    # Where no column has room for the error the query fails, be it a count of cards or a text.
    for use in (H.only_cards(H.explode_html_cards(pages)), H.only_cards(H.extract_html_pages(pages)).select("url"),
                pages.select(F.size(H.html_rows(F.col("content"), CARD_PATH, [H.HtmlField("text")]))), pages.select(H.html_select_first(F.col("content"), "a"))):
        with pytest.raises(Exception, match="no such piece"):
            use.collect()
