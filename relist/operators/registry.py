"""Per-source extractors and their dispatch."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist import schemas as S
from relist.operators.extract_html import extract_html_pages
from relist.operators.extract_json import extract_json_pages
from relist.sources.pages import check_source_domain

DEFAULT_REGISTRY: dict[str, S.SourceSpec] = {
    S.HTML_SOURCE: S.SourceSpec(S.HTML_SOURCE, S.BASE_URLS[S.HTML_SOURCE], "html", extract_html_pages),
    S.JSON_SOURCE: S.SourceSpec(S.JSON_SOURCE, S.BASE_URLS[S.JSON_SOURCE], "json", extract_json_pages),
}


def extract_pages(raw_pages: DataFrame, registry: Mapping[str, S.SourceSpec] = DEFAULT_REGISTRY) -> DataFrame:
    """Run each source's extractor over that source's pages; an unknown source raises.

    The source filters reach the scan, so with the table partitioned by source every
    page is read by one branch only.
    """
    names = list(registry)
    known = [spec.extractor(raw_pages.where(F.col("source") == name)) for name, spec in registry.items()]
    strangers = raw_pages.where(~F.coalesce(F.col("source").isin(*names), F.lit(False)))
    refused = check_source_domain(strangers, names).select(
        *[F.col(f.name) if f.name in ("raw_page_id", "source", "page", "captured_at")
          else F.lit(None).cast(f.dataType).alias(f.name) for f in S.EXTRACTED.fields])
    return reduce(DataFrame.unionByName, [*known, refused])
