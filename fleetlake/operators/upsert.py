"""Keyed upsert ("MERGE: matched -> update all, else insert all"), by MERGE where the catalog can, else per partition.

Result rows = target rows whose key is not in the source  UNION ALL  source rows. NULL keys never
match, so a NULL-keyed row stays on both sides, as MERGE does. The source must hold one row per key
(keep-last dedup runs first; MERGE would fail otherwise).

On a table partitioned by ``date`` only the touched partitions are rewritten (copy-on-write):
  touched = dates of the source  UNION  dates of target rows whose key the source replaces
            (a row may move to another date);
  the dates become literals of the target's scan, so no other partition's files are opened (a key without the date
  costs one scan of the keys and dates of the table, to find moved rows);
  new content of the touched partitions is staged to shared storage, then swapped in with dynamic
  partition overwrite; a touched partition that ends up empty is deleted explicitly (dynamic
  overwrite would leave it, and with it the moved row, in place).
All files of a table have its stored schema: a batch is cast to it, and ``evolve`` rewrites the table when it adds a column.
Replaying a batch leaves the same table, but for rows with a NULL key: these match nothing and are added again,
as MERGE does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.casts import to_type_lenient
from fleetlake.sources.tables import Lake


def align_source(source: DataFrame, target: DataFrame, evolve: bool = False) -> tuple[DataFrame, DataFrame]:
    """Make the source fit the target: each column cast to the target's type (what does not fit is NULL), a column
    that the source lacks NULL. Extra source columns are ignored unless ``evolve`` adds them to the target."""
    have = {f.name: f.dataType for f in source.schema}
    cols = [to_type_lenient(F.col(f"`{f.name}`"), have[f.name], f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema]
    extra = [c for c in source.columns if c not in target.columns] if evolve else []
    kept = [F.lit(None).cast(have[c]).alias(c) for c in extra]
    return source.select(*cols, *(F.col(f"`{c}`") for c in extra)), target.select("*", *kept)


def upsert_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], evolve: bool = False) -> DataFrame:
    """The merged content as a lazy DataFrame."""
    source, target = align_source(source, target, evolve)
    cond = [target[k] == source[k] for k in keys]
    kept = target.join(source.select(*keys), cond, "left_anti")
    return kept.unionByName(source)


def merge_rows(lake: Lake, name: str, source: DataFrame, keys: Sequence[str], evolve: bool = False) -> None:
    """I7, I8 as MERGE: matched rows updated whole, the others inserted. The keys may match in any partition."""
    target = lake.read(name)
    aligned, _ = align_source(source, target, evolve)
    table = lake.table_name(name)
    same = [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys]
    merge = aligned.alias("source").mergeInto(table, reduce(Column.__and__, same))
    if evolve:
        merge = merge.withSchemaEvolution()
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def upsert_table(lake: Lake, name: str, source: DataFrame, keys: Sequence[str], partition_col: str | None = "date",
                 evolve: bool = False, source_staged: bool = False) -> None:
    """Upsert ``source`` into table ``name`` of ``lake``; creates the table when it does not exist.

    A table whose catalog can change rows (``lake.can_merge``) is merged by it, in its own transaction; tables of plain
    files are rewritten per partition (copy-on-write).

    The source is read more than once below, so it is staged first unless ``source_staged`` says it
    already is a read of written files (the loaders stage their deduplicated batch)."""
    if not lake.exists(name):
        lake.overwrite(name, source, partition_by=[partition_col] if partition_col else ())
        return
    if lake.can_merge(name):
        merge_rows(lake, name, source, keys, evolve)
        return
    with lake.staging():                                 # this upsert's staged copies go when it succeeds
        _upsert_existing(lake, name, source, keys, partition_col, evolve, source_staged)


def _upsert_existing(lake: Lake, name: str, source: DataFrame, keys: Sequence[str], partition_col: str | None,
                     evolve: bool, source_staged: bool) -> None:
    target = lake.read(name)
    if partition_col is None or partition_col not in target.columns:
        merged = lake.stage(name, upsert_frames(target, source, keys, evolve))
        lake.overwrite(name, merged)
        return

    added = [c for c in source.columns if c not in target.columns] if evolve else []
    source, target = align_source(source, target, evolve)
    # read several times below, so it is staged; a source that is a read of written files already needs only its casts
    src = source if source_staged else lake.stage(name + "_src", source)
    src_keys = src.select(*keys)
    if added:
        # every file of a table has one schema: a new column rewrites the table, once
        merged = target.join(src_keys, [target[k] == src_keys[k] for k in keys], "left_anti").unionByName(src)
        lake.overwrite(name, lake.stage(name, merged, partition_by=[partition_col]), partition_by=[partition_col], rebalance=False)
        return
    # the touched dates as text, as Spark's session writes them: bounded by the calendar, free of the driver's clock
    day = F.col(partition_col).cast("string").alias("day")
    dates = {r["day"] for r in src.select(day).distinct().collect()}
    if partition_col not in keys:
        # a row may move: one scan of the target's keys and dates finds where it was
        where_now = target.select(*keys, partition_col)
        moved = where_now.join(src_keys, [where_now[k] == src_keys[k] for k in keys], "left_semi")
        dates |= {r["day"] for r in moved.select(day).distinct().collect()}
    # literals, so the scan lists only those partitions
    kind = target.schema[partition_col].dataType
    known = [F.lit(d).cast(kind) for d in sorted(d for d in dates if d is not None)]
    touched = F.col(partition_col).isin(*known) if known else F.lit(False)
    if None in dates:
        touched = touched | F.col(partition_col).isNull()
    here = target.where(touched)
    new_content = here.join(src_keys, [here[k] == src_keys[k] for k in keys], "left_anti").unionByName(src)
    staged = lake.stage(name, new_content, partition_by=[partition_col])
    staged_at = lake.last_staged
    left = {r["day"] for r in staged.select(day).distinct().collect()}
    lake.replace_partitions(name, staged, staged_at, partition_col, dates - left)
