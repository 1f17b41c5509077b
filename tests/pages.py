"""List pages for the tests."""

from __future__ import annotations

import json
from datetime import datetime

from relist.schemas import HTML_SOURCE, JSON_SOURCE, RAW_PAGE

CAPTURED = datetime(2020, 3, 31, 10, 0, 0)


def card(path="/it-jobs/x-1", title="Title", tags=("Java", "SQL"), age="3 days ago", company="/companies/ACME", city="City"):
    link = f'<a href="{path}">{title}</a>' if path is not None and title is not None else ""
    if path is None and title is not None:
        link = f"<a>{title}</a>"
    spans = "".join(f"<a><span>{t}</span></a>" for t in tags or ())
    return f"""
<div class="job first"><div class="job_content">
  <div class="logo"><div class="logo-wrapper">{f'<a href="{company}"><img src=x></a>' if company is not None else ''}</div></div>
  <div class="job__description">
    <div class="job__body"><div class="details"><h2 class="title">{link}</h2></div></div>
    <div class="job-bottom"><div class="tag-list">{spans}</div></div>
  </div>
  <div class="city_and_posted_date">
    <div class="city"><div class="address">{f'<span class="text">{city}</span>' if city is not None else ''}</div></div>
    <div class="distance-time-job-posted">{f'<span>{age}</span>' if age is not None else ''}</div>
  </div>
</div></div>"""


def html_page(cards):
    return f'<!DOCTYPE html><html><body><div id="search-results"><div id="jobs">{"".join(cards)}</div></div></body></html>'


def html_cards(n, start=0, age="3 days ago"):
    return html_page([card(path=f"/it-jobs/listing-{i}", title=f"Title {i}", age=age) for i in range(start, start + n)])


def hit(i=1, **changes):
    row = {"alias": f"role-{i}", "jobId": i, "jobTitle": f"Role {i}", "skills": ["A", "B"], "onlineDate": 1577530825,
           "company": "Company", "locations": ["Ho Chi Minh"], "jobSalary": 0, **changes}
    return {k: v for k, v in row.items() if v is not ...}


def json_page(hits, page=0):
    return json.dumps({"results": [{"hits": hits, "page": page, "nbHits": 1}]})


def raw_pages(spark, rows):
    """rows: (source, page, content[, captured_at])"""
    data = [(f"raw-{s}-{p}-{i}", p, s, c, *(at or [CAPTURED])) for i, (s, p, c, *at) in enumerate(rows)]
    schema = RAW_PAGE.fieldNames()
    return spark.createDataFrame(data, ", ".join(f"{f} {RAW_PAGE[f].dataType.simpleString()}" for f in schema))


def html_raw(spark, *contents, captured=CAPTURED, first=1):
    return raw_pages(spark, [(HTML_SOURCE, first + i, c, captured) for i, c in enumerate(contents)])


def json_raw(spark, *contents, captured=CAPTURED):
    return raw_pages(spark, [(JSON_SOURCE, 1 + i, c, captured) for i, c in enumerate(contents)])
