"""Keep-last deduplication.

Keep the row with the greatest sequence value per key. This is a grouped ``max_by`` over a struct of
the row, so Spark aggregates partially on the map side before the shuffle: a key holding a third of
all rows is reduced to one row per map task instead of being sorted whole in one task (which a
``row_number()`` window would do).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the largest ``seq`` tuple. Output keeps ``df``'s columns.

    ``seq`` must be a total order inside a key (e.g. landing offset + position). Rows whose key has a
    NULL part are grouped like any other value (pandas ``drop_duplicates`` does the same).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = F.struct(*[F.col(c) for c in seq])
    row = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys)
            .agg(F.max_by(row, order).alias("_row"))
            .select(*keys, "_row.*")
            .select(*df.columns))
