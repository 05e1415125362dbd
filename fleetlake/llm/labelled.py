"""A bounded sample of labelled rows, to fit on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import staged

# labelled rows that anything is fitted on: those with the smallest hashes of their id. 16 bytes each, so the
# sample is broadcast to the documents whatever their number.
LABELLED_ROWS = 20_000


def labelled_sample(labels: DataFrame, label: str, where: Column | None = None, rows: int = LABELLED_ROWS) -> DataFrame:
    """(label_id, label), at most ``rows`` of them: the ``label`` column of rows that have it and a doc_id.

    Rows with equal ids are one (largest label). The smallest hashes of the ids are taken, so the sample is the
    same however the table is stored.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        known = known.where(where)
    one = known.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return staged(one.orderBy(F.xxhash64("label_id"), "label_id").limit(rows), "labelled")
