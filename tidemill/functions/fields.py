"""Column expressions shared by the jobs; all stay inside Spark's own expressions."""

from __future__ import annotations

from calendar import monthrange
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def unpadded_date(column: str | Column) -> Column:
    """Date of a string such as ``2015-1-5``."""
    return F.to_date(column, "yyyy-M-d")


def log_day(column: str | Column) -> Column:
    """Day part of an ISO time."""
    return F.substring(column, 1, 10)


def clock_text(column: str | Column) -> Column:
    """Time as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def ranked_titles(rank: str, item: str, title: str) -> Column:
    """Aggregate of one user's ranked items as ``id:title,id:title``; a missing title is empty.

    Made for top-N rows: the list it builds is N long.
    """
    entry = F.concat_ws(":", F.col(item).cast("string"), F.coalesce(F.col(title), F.lit("")))
    entries = F.sort_array(F.collect_list(F.struct(F.col(rank), entry.alias("entry"))))
    return F.array_join(F.transform(entries, lambda e: e["entry"]), ",")


def date_prefix(column: str, prefix: str) -> Column:
    """Dates whose text ``year-month-day``, month and day without leading zeros, begins with ``prefix``.

    The test is one of half-open ranges of the typed column, which reaches the scan, where a test of
    the text would read every row. ``2014`` is one range; ``2014-1`` is four, of January, October, November and December. A prefix
    that no date of the years 1 to 9999 has gives no row.
    """
    ranges = sorted(_date_ranges(prefix))
    merged: list[list[date]] = []
    for first, after in ranges:
        if merged and merged[-1][1] == first:
            merged[-1][1] = after
        else:
            merged.append([first, after])
    test = F.lit(False)
    for at, (first, after) in enumerate(merged):
        own = F.col(column) >= F.lit(first.isoformat()).cast("date")
        if after != date.max:
            own &= F.col(column) < F.lit(after.isoformat()).cast("date")
        test = own if at == 0 else test | own
    return test


def _date_ranges(prefix: str) -> list[tuple[date, date]]:
    """First day, and day after the last, of each run of days that a prefix stands for."""
    parts = prefix.split("-")
    if len(parts) > 3 or not all(p.isdigit() or not p for p in parts) or any(p.startswith("0") for p in parts):
        return []
    if len(parts) == 1:
        spans = [(int(parts[0]) * 10**k, (int(parts[0]) + 1) * 10**k) for k in range(5 - len(parts[0]))] if parts[0] else [(1, 10_000)]
        return [(date(low, 1, 1), _day(min(high, 10_000), 1)) for low, high in spans if low < 10_000]
    if not parts[0] or int(parts[0]) > 9_999:
        return []
    year = int(parts[0])
    if len(parts) == 2:
        return [(date(year, m, 1), _day(year, m + 1)) for m in range(1, 13) if str(m).startswith(parts[1])]
    if not parts[1] or int(parts[1]) > 12:
        return []
    month, days = int(parts[1]), monthrange(year, int(parts[1]))[1]
    chosen = [date(year, month, d) for d in range(1, days + 1) if str(d).startswith(parts[2])]
    return [(d, d + timedelta(days=1) if d != date.max else date.max) for d in chosen]


def _day(year: int, month: int) -> date:
    """First day of a month; the thirteenth is the next year's first, and after year 9999 comes nothing."""
    year, month = (year + 1, 1) if month == 13 else (year, month)
    return date(year, month, 1) if year < 10_000 else date.max
