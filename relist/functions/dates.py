from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.strings import AGE_PATTERN, lower, parse_int, regex_capture, trim_java

# Local date-time, optional seconds and fraction, optional zone. The zone is
# accepted and ignored; a date alone is refused.
ISO_DATE_TIME = (
    r"^(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)"
    r"(?:(?:[Zz]|[+-]\d{2}:\d{2}(?::\d{2})?)(?:\[[^\]]+\])?)?\z"
)
# timestamp_seconds overflows the microsecond range beyond this.
MAX_EPOCH_SECONDS = 9_223_372_036_854


def relative_age_to_ts(text: Column, captured_at: Column) -> Column:
    """'3 days ago' as a time before the page was captured; any other text gives null.

    Months are calendar months and clamp at the month end.
    """
    age = lower(trim_java(text))
    n, unit = F.regexp_extract(age, AGE_PATTERN, 1), F.regexp_extract(age, AGE_PATTERN, 2)
    # Without a match both are empty, which is no interval; try_subtract because a huge
    # amount runs past the first representable date.
    step = F.concat(n, F.lit(" "), unit).try_cast("interval")
    return F.when(parse_int(n).isNotNull(), F.try_subtract(captured_at, step))


def epoch_s_to_ts(c: Column) -> Column:
    in_range = F.abs(c) <= MAX_EPOCH_SECONDS
    return F.when(in_range, F.timestamp_seconds(F.when(in_range, c)))


def ts_to_epoch_ms(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def epoch_ms_to_ts(c: Column) -> Column:
    return F.timestamp_millis(c)


def try_parse_iso(c: Column) -> Column:
    """ISO date-time text as a local timestamp, null where it is not one."""
    date, time = regex_capture(c, ISO_DATE_TIME, 1), regex_capture(c, ISO_DATE_TIME, 2)
    return F.concat(date, F.lit("T"), time).try_cast("timestamp_ntz")


def parse_iso(c: Column) -> Column:
    """Like try_parse_iso, but a bad text fails the query; null stays null."""
    message = F.concat(F.lit("Invalid date time, ISO expected: "), c)
    return F.when(c.isNotNull(), F.coalesce(try_parse_iso(c), F.raise_error(message).cast("timestamp_ntz")))


def parse_bound(text: str | None) -> Column | None:
    """A range bound given as a job argument: checked once, then a literal that pushes down."""
    if text is None:
        return None
    match = re.match(ISO_DATE_TIME.replace(r"\z", r"\Z"), text)
    if not match:
        raise ValueError(f"Invalid date time, ISO expected: {text!r}")
    local = datetime.fromisoformat("T".join(match.groups()))
    return F.lit(local.isoformat()).cast("timestamp_ntz")


def run_time(run_ts: datetime | str) -> Column:
    """The clock of a run: one literal for all rows, never read per row."""
    text = run_ts if isinstance(run_ts, str) else run_ts.isoformat()
    return F.date_trunc("millisecond", F.lit(text).cast("timestamp"))


def days(n: int) -> Column:
    return F.make_interval(days=F.lit(n))


def at_least_n_days_after(later: Column, earlier: Column, n: int) -> Column:
    """Calendar days in the session zone, so the wall-clock time is kept across DST."""
    return later >= earlier + days(n)


def same_local_date(a: Column, b: Column) -> Column:
    return F.to_date(a) == F.to_date(b)
