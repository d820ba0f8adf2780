"""Date-time assembly, shifts by a date part, and counts of whole parts between two moments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = {"month": 1, "quarter": 3, "year": 12}
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
PARTS = (*SECONDS, *MONTHS)


def _known(part: str) -> str:
    part = part.lower()
    if part not in PARTS:
        raise ValueError(f"date part must be one of {', '.join(PARTS)}, not {part!r}")
    return part


def combine(day: Column, clock: Column) -> Column:
    """Timestamp from a date and a clock: a ``HH:mm:ss`` text, a time or a timestamp; NULL where either is missing."""
    found = F.regexp_extract(clock.cast("string"), r"(\d{1,2}:\d{2}:\d{2})", 1)
    return F.concat(day.cast("date").cast("string"), F.lit(" "), F.nullif(found, F.lit(""))).cast("timestamp_ntz")


def shift(moment: Column, part: str, amount: Column | int) -> Column:
    """``moment`` moved by ``amount`` date parts; the result is a timestamp."""
    part = _known(part)
    n = F.lit(amount) if isinstance(amount, int) else amount
    if part in MONTHS:
        step = F.make_ym_interval(F.lit(0), (n * MONTHS[part]).cast("int"))
    else:
        seconds = (n * SECONDS[part]).cast("decimal(18,6)")
        step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return moment.cast("timestamp_ntz") + step


def shift_date(day: Column, part: str, amount: Column | int) -> Column:
    """``shift`` for dates and parts of a day or longer."""
    return shift(day, part, amount).cast("date")


def boundaries(start: dt.date, end: dt.date, part: str) -> int:
    """Number of part boundaries crossed between two moments (31 January to 1 February is one month)."""
    part = _known(part)
    if part in MONTHS:
        months = (end.year - start.year) * 12 + end.month - start.month
        if part == "month":
            return months
        if part == "year":
            return end.year - start.year
        return (end.year * 12 + end.month - 1) // 3 - (start.year * 12 + start.month - 1) // 3
    epoch = dt.datetime(1900, 1, 1)  # a Monday, so weeks start on Monday

    def index(moment: dt.date) -> int:
        if not isinstance(moment, dt.datetime):
            moment = dt.datetime(moment.year, moment.month, moment.day)
        return (moment - epoch) // dt.timedelta(seconds=SECONDS[part])

    return index(end) - index(start)


def in_year_of(col: Column, as_of: dt.date) -> Column:
    """True for moments in the calendar year of ``as_of``, as a half-open range a scan can prune by."""
    first, after = dt.date(as_of.year, 1, 1), dt.date(as_of.year + 1, 1, 1)
    return (col >= F.lit(first)) & (col < F.lit(after))
