"""Date arithmetic with the boundary-counting semantics the fleet SQL relies on.

The validation SQL counts *boundaries crossed* (00:59 -> 02:01 is 2 hours, Jan 31 -> Feb 1 is 1 month),
not whole elapsed units. All helpers return BIGINT columns and stay inside codegen (no UDFs).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_col(as_of: _dt.datetime | str | None) -> Column:
    """The query clock. ``None`` means ``current_timestamp()`` (GETDATE); tests pass a fixed instant."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return F.lit(as_of).cast("timestamp")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hours_between(start, end) -> Column:
    """Hour boundaries crossed from ``start`` to ``end``."""
    s = F.unix_seconds(F.date_trunc("hour", _c(start)))
    e = F.unix_seconds(F.date_trunc("hour", _c(end)))
    return ((e - s) / F.lit(3600)).cast("bigint")


def days_between(start, end) -> Column:
    """Day boundaries crossed (``datediff`` on dates) as BIGINT."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def months_between_boundaries(start, end) -> Column:
    """Month boundaries crossed: 12*(year diff) + month diff."""
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def days_ago(as_of: Column, n: int) -> Column:
    """``DATEADD(day, -n, as_of)`` keeping the time of day."""
    return as_of - F.make_interval(days=F.lit(n))


def day_start(ts) -> Column:
    """Midnight of the day of ``ts`` as a timestamp (the grain of the daily fact tables)."""
    return F.to_date(_c(ts)).cast("timestamp")


def month_key(ts) -> Column:
    """``MonthYear`` key, ``yyyy-MM``."""
    return F.date_format(_c(ts), "yyyy-MM")
