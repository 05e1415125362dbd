"""Aggregate helpers shared by queries, billing and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.casts import round_half_up


def percent_of_total(grouped: DataFrame, count_col: str, out: str, digits: int = 2) -> DataFrame:
    """``ROUND(c * 100.0 / SUM(c) OVER (), digits)`` over an already grouped frame.

    The un-partitioned window runs in one task, so it is only applied to the output of a GROUP BY
    whose keys have a small domain (status, make, label) — never to raw fact rows.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    share = F.col(count_col).cast("double") * F.lit(100.0) / total.cast("double")
    return grouped.select("*", round_half_up(share, digits).alias(out))
