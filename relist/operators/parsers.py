"""A user's page parser as a table function: callable from SQL with LATERAL, and as the extractor of a source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import UserDefinedTableFunction

from relist import schemas as S
from relist.functions.arrays import map_trim_set
from relist.functions.dates import try_parse_iso
from relist.functions.strings import build_url, trim_java

Parser = Callable[[str], Iterable[Mapping[str, object]]]

#: What a listing of a source can have, as the second argument of the table function; `[]` marks lists.
LISTING = "url, title, tags[], posting_date, company, locations[]"


def _names(fields: str) -> list[tuple[str, bool]]:
    parts = [f.strip() for f in fields.split(",") if f.strip()]
    return [(f.removesuffix("[]").strip(), f.endswith("[]")) for f in parts]


def table_parser(parse: Parser) -> UserDefinedTableFunction:
    """A table function of a parser that yields one mapping per listing of a page text.

        spark.udtf.register("parse_feed", table_parser(parse_feed))
        SELECT p.page, l.* FROM pages p, LATERAL parse_feed(p.content, 'url, title, tags[]') l

    The second argument, a constant, names the fields wanted; the result has them as text or lists of text, with
    `ordinal` in front and `raw_fragment`, `page_error` behind. A field the parser does not give is null, and so is one of another
    kind (a number where text is wanted); the elements of a list that are no text are null. A page on which the parser fails gives the
    listings found before and one row with `page_error`; a null text gives no rows. Pages are taken one at a time.
    """
    class PageParser:
        @staticmethod
        def analyze(content: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
            if not isinstance(content.dataType, StringType):
                raise ValueError("The page text must be a string")
            if not fields.isConstantExpression or not isinstance(fields.value, str) or not _names(fields.value):
                raise ValueError("The fields must be a constant list of names")
            text = StringType()
            wanted = [StructField(n, ArrayType(text) if many else text) for n, many in _names(fields.value)]
            return AnalyzeResult(StructType([
                StructField("ordinal", IntegerType()), *wanted, StructField("raw_fragment", text), StructField("page_error", text)]))

        def eval(self, content, fields):
            if content is None:
                return
            wanted, ordinal = _names(fields), 0
            try:
                for listing in parse(content):
                    values = []
                    for name, many in wanted:
                        v = listing.get(name)
                        if many:
                            values.append([x if isinstance(x, str) else None for x in v] if isinstance(v, (list, tuple)) else None)
                        else:
                            values.append(v if isinstance(v, str) else None)
                    fragment = listing.get("raw_fragment")
                    yield (ordinal, *values, fragment if isinstance(fragment, str) else "", None)
                    ordinal += 1
            except Exception as e:  # the page is an error row, whatever its parser raised
                yield (ordinal, *[None] * len(wanted), "", f"Cannot parse page: {type(e).__name__}: {e}")

    return F.udtf(PageParser)


def table_extractor(function: str, base_url: str) -> Callable[[DataFrame], DataFrame]:
    """The extractor of a source whose pages a registered table function parses.

    Texts are trimmed, addresses are put behind the base address and dates read as ISO date-times, as for the sources the library
    brings. The function is found by name when the extractor runs.
    """
    if not function.replace(".", "_").isidentifier():
        raise ValueError(f"Not the name of a function: {function!r}")

    def extract(raw_pages: DataFrame) -> DataFrame:
        found = raw_pages.sparkSession.sql(
            f"SELECT p.raw_page_id, p.source, p.page, p.captured_at, l.* FROM {{pages}} p, LATERAL {function}(p.content, '{LISTING}') l",
            pages=raw_pages)
        made = {
            "url": build_url(base_url, trim_java(F.col("url"))), "title": trim_java(F.col("title")), "tags": map_trim_set(F.col("tags")),
            "posting_date": try_parse_iso(F.col("posting_date")), "company": trim_java(F.col("company")),
            "locations": map_trim_set(F.col("locations"))}
        return found.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.EXTRACTED.fields])

    return extract
