"""Time helpers that stay exact on TIMESTAMP_NTZ (and on TIMESTAMP in a UTC session)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_hour(ts: Column | str) -> Column:
    """Whole hours since 1970-01-01 00:00 of the hour containing ``ts``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)


def add_hours(ts: Column | str, n: Column | int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add("HOUR", n, ts)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole hours from start to end (truncated)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("HOUR", start, end)


def day_of_year_frac(ts: Column | str) -> Column:
    """Day of year plus hour/24 (minutes ignored), as the solar step uses it."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.dayofyear(ts) + F.hour(ts) / 24
