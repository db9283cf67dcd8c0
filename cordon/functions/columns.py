"""Column expressions shared by the operators.

All of these are built-in Spark expressions (no Python on the row path), so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cordon.config import DAYPARTS, OVERNIGHT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """yyyyMMdd as INT (e.g. 2024-01-31 -> 20240131)."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def month_label(c) -> Column:
    """'yyyy-MM' label of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM")


def iso_dow(c) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday (``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(c)) + F.lit(1)


def whole_minutes(start, end) -> Column:
    """Complete minutes from start to end: 20 s across a minute mark is 0."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def add_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _c(minutes).cast("int"), _c(ts))


def daypart(hour) -> Column:
    h = _c(hour)
    expr = None
    for name, lo, hi in DAYPARTS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OVERNIGHT))


def trip_key(vendor, pickup_ts, pu_zone, total) -> Column:
    """Surrogate key = upper-case hex MD5 of the pipe-joined natural key.

    Every part enters with all its digits, so trips that de-duplication tells
    apart never share a key: id as BIGINT text, timestamp with microseconds,
    amount as the exact text of its declared type.  ``concat`` propagates
    NULL, so a NULL part yields a NULL key (trap T3).
    """
    text = F.concat(
        _c(vendor).cast("bigint").cast("string"), F.lit("|"),
        F.date_format(_c(pickup_ts), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("|"),
        _c(pu_zone).cast("bigint").cast("string"), F.lit("|"),
        _c(total).cast("string"),
    )
    return F.upper(F.md5(text))


def ntz(value) -> Column:
    """Zone-less timestamp literal from a date/datetime (no session-zone shift)."""
    return F.lit(value.isoformat(sep=" ") if hasattr(value, "hour") else
                 value.isoformat() + " 00:00:00").cast("timestamp_ntz")
