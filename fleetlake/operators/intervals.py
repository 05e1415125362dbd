"""Interval operators: point-in-interval join and interval -> calendar-month expansion.

A plain equi-join on ``asset_id`` with the range as a residual compares every visit of an asset with
every daily row of that asset. One asset with a third of all visits makes that quadratic in one task.
Here both sides are keyed by (key, month): a daily row carries its own month, an interval is exploded
into the months it overlaps (bounded by the calendar span, not by row counts), and the range check
stays as a residual inside one (key, month) bucket. Each (interval, point) pair still meets exactly
once — in the point's month — so the result equals the naive join.

A closed interval spans its own months; an open one runs to the newest point of its own key, which a
map-side maximum per key finds. No query clock takes part, so a bucket holds one key's points of one month
whatever the clock says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "MM")


def interval_left_join(intervals: DataFrame, points: DataFrame, key: str, start: str, end: str,
                       point: str, point_prefix: str = "_p_") -> DataFrame:
    """``intervals LEFT JOIN points ON key = key AND point >= start AND (end IS NULL OR point <= end)``.

    Interval columns keep their names; point columns are prefixed with ``point_prefix``. An interval
    with no point in its first month keeps a row with NULL point columns for it — aggregates that ignore
    NULLs (sum/avg/min/max/count(col)) are unchanged by that row, so group by the interval's
    columns afterwards as the SQL form does. Its other months without a point leave none.

    The pair (interval, point) meets in the point's month, which lies in the interval's months whenever
    start <= point <= end, and, for an open interval, whenever start <= point, as no point of the key is newer
    than the month it runs to.
    """
    p = points.select([F.col(c).alias(point_prefix + c) for c in points.columns])
    pk, pt = point_prefix + key, point_prefix + point
    newest = p.groupBy(F.col(pk).alias("_key")).agg(F.max(pt).alias("_newest"))
    # one pass over the intervals; the join takes one row per key, so a hot key splits on the intervals' side
    ranged = (intervals.join(newest, F.col(end).isNull() & (intervals[key] == newest["_key"]), "left")
              .withColumn("_last", F.coalesce(F.col(end), F.col("_newest"), F.col(start))).drop("_key", "_newest"))
    first = _month_start(F.col(start))
    last = F.greatest(_month_start(F.col("_last")), first)
    # a NULL start spans no month and matches no point, but the interval stays (explode_outer)
    left = ranged.select("*", F.explode_outer(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("_bucket")).drop("_last")
    right = p.select("*", _month_start(F.col(pt)).alias("_p_bucket"))
    cond = ((F.col(key) == F.col(pk)) & (F.col("_bucket") == F.col("_p_bucket"))
            & (F.col(pt) >= F.col(start)) & (F.col(end).isNull() | (F.col(pt) <= F.col(end))))
    first_or_met = F.col(pk).isNotNull() | F.col("_bucket").isNull() | (F.col("_bucket") == first)
    return left.join(right, cond, "left").where(first_or_met).drop("_bucket", "_p_bucket")


def month_day_overlaps(intervals: DataFrame, start: str, end_exclusive: Column,
                       month_col: str = "month_start") -> DataFrame:
    """Explode each interval ``[start_day, end_exclusive_day)`` into (month_start, days) rows.

    Days are counted at date grain; a handover day belongs to the interval that starts on it.
    Intervals of zero days produce no rows.
    """
    s = F.to_date(F.col(start))
    e = F.to_date(end_exclusive)
    last = F.date_sub(e, 1)
    df = intervals.where(e > s).select(
        "*", F.explode(F.sequence(F.trunc(s, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))).alias(month_col))
    nxt = F.add_months(F.col(month_col), 1)
    days = F.datediff(F.least(e, nxt), F.greatest(s, F.col(month_col)))
    return df.select("*", days.cast("bigint").alias("_days"))
