"""Data-quality checks (V1-V6, I10-I12). All checks of one table run in one aggregation pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_profile(df: DataFrame, keys: Sequence[str] = (), critical: Sequence[str] = (),
                  date_col: str | None = None, date_max: Column | None = None,
                  date_min: Column | None = None) -> DataFrame:
    """One row: row count, duplicate count over ``keys``, NULL count per critical column and, with
    ``date_col``, its min/max and the rows outside [date_min, date_max] (or NULL)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if keys:
        aggs.append((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("duplicates"))
    for c in critical:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
    if date_col:
        d = F.col(date_col)
        aggs += [F.min(d).alias("min_date"), F.max(d).alias("max_date")]
        bad = d.isNull()
        if date_max is not None:
            bad = bad | (d > date_max)
        if date_min is not None:
            bad = bad | (d < date_min)
        aggs.append(F.count_if(bad).alias("rows_out_of_range"))
    return df.agg(*aggs)


def schema_mismatches(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """V6: (column, expected type, actual type) for every missing or differently typed column."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for f in expected.fields:
        got = actual.get(f.name, "<missing>")
        if got != f.dataType.simpleString():
            out.append((f.name, f.dataType.simpleString(), got))
    return out


def missing_tables(spark: SparkSession, names: Sequence[str], database: str | None = None) -> list[str]:
    """V6: which of ``names`` the catalog does not have."""
    return [n for n in names
            if not spark.catalog.tableExists(n if database is None else f"{database}.{n}")]


def schema_relation(spark: SparkSession, tables: Mapping[str, DataFrame], declared: Mapping[str, T.StructType]) -> DataFrame:
    """V6 as rows (table_name, column_name, expected_type, actual_type, filled, status), for every declared or present column.

    ``status`` is ``ok``, ``differs`` (another type), ``missing`` (a column, or its whole table, is not there) or ``undeclared``;
    ``filled`` counts the rows that hold a value, by one aggregation per table."""
    def row(table: str, column: str, expected: str | None, actual: str | None, filled: Column) -> Column:
        status = "missing" if actual is None else "undeclared" if expected is None else "ok" if expected == actual else "differs"
        return F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(expected).cast("string").alias("expected_type"),
                        F.lit(actual).cast("string").alias("actual_type"), filled.alias("filled"), F.lit(status).alias("status"))

    parts = []
    for name, schema in declared.items():
        expected = {f.name: f.dataType.simpleString() for f in schema}
        present = {f.name: f.dataType.simpleString() for f in tables[name].schema} if name in tables else {}
        rows = [row(name, c, expected.get(c), present.get(c), F.count(F.col(f"`{c}`")) if c in present else F.lit(0).cast("bigint"))
                for c in dict.fromkeys([*expected, *present])]
        one = tables[name] if present else spark.range(0)
        parts.append(one.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))
    return reduce(DataFrame.unionAll, parts)
