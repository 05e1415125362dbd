"""Schema normalisation of landed records (N0-N14) as ONE projection.

Per column, in this order:
  N2  all-NULL column that is not configured -> ""          (one aggregate job finds them)
  N3  datetime_cols -> timestamp                            (lenient: bad cell -> NULL)
  N4  long_int_cols -> bigint                               ("12.7" -> 12)
  N5  boolean_cols  -> boolean                              (true/false, yes/no, 1/0)
  N6  the fixed double measures -> double, after N4         (daily path only)
  N7  NullType -> ""
  N8  struct / map / array -> compact JSON text
  N9  binary -> base64 text
  N10 decimal -> double
  N11 any type outside the allow-list -> string
  N12 configured columns that are absent are skipped
  N14 optional: promote struct fields to top-level columns instead of N8
N0/N1 (ragged records -> union of columns; nested cells, and columns of several kinds, as the text that was sent) are done by
``sources.pages``; N8 here serves frames that hold structs, maps and arrays.
All steps compose into one ``select`` — one Project node, no withColumn chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.config import DOUBLE_COLS, EndpointConfig
from fleetlake.functions.casts import (to_boolean_lenient, to_double_lenient, to_long_lenient,
                                       to_timestamp_lenient)

# Spark simple type names that are stored as they are
ALLOWED_SIMPLE = {"string", "bigint", "double", "boolean", "date", "timestamp", "int", "float"}

_JSON_OPTS = {"ignoreNullFields": "false"}


def all_null_columns(df: DataFrame, candidates: list[str]) -> set[str]:
    """Columns among ``candidates`` with no non-NULL value (one aggregation over all of them)."""
    if not candidates:
        return set()
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(candidates)]).first()
    return {c for i, c in enumerate(candidates) if row[f"c{i}"] == 0}


def _column_expr(name: str, dtype: T.DataType, cfg: EndpointConfig, double_cols: tuple[str, ...],
                 blank: bool) -> Column:
    c = F.col(f"`{name}`")
    if blank:                                                   # N2
        return F.lit("")
    typed = False
    configured = name in cfg.datetime_cols or name in cfg.long_int_cols or name in cfg.boolean_cols or name in double_cols
    if configured and isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        # an object has no configured type: NULL, known without reading it
        to = ("double" if name in double_cols else "boolean" if name in cfg.boolean_cols else "bigint" if name in cfg.long_int_cols else "timestamp")
        return F.lit(None).cast(to)
    if name in cfg.datetime_cols:                               # N3
        c, dtype, typed = to_timestamp_lenient(c), T.TimestampType(), True
    if name in cfg.long_int_cols:                               # N4
        c, dtype, typed = to_long_lenient(c, dtype), T.LongType(), True
    if name in cfg.boolean_cols:                                # N5
        c, dtype, typed = to_boolean_lenient(c), T.BooleanType(), True
    if name in double_cols:                                     # N6
        c, dtype, typed = to_double_lenient(c, dtype), T.DoubleType(), True
    if typed:
        return c
    if isinstance(dtype, T.NullType):                           # N7
        return F.lit("")
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):   # N8
        return F.to_json(c, _JSON_OPTS)
    if isinstance(dtype, T.VariantType):
        return F.coalesce(F.try_variant_get(c, "$", "string"), F.to_json(c))
    if isinstance(dtype, T.BinaryType):                         # N9
        return F.base64(c)
    if isinstance(dtype, T.DecimalType):                        # N10
        return c.cast("double")
    if dtype.simpleString() not in ALLOWED_SIMPLE:              # N11
        return c.cast("string")
    return c


def normalize(df: DataFrame, cfg: EndpointConfig, daily: bool | None = None, keep: tuple[str, ...] = (),
              flatten_structs: bool = False, blank_all_null: bool = True) -> DataFrame:
    """Apply N2-N14 to a frame of records. Columns in ``keep`` (e.g. ``_seq``) pass through untouched."""
    daily = cfg.daily if daily is None else daily
    double_cols = DOUBLE_COLS if daily else ()
    if flatten_structs:                                         # N14
        df = flatten_struct_columns(df, keep)
    fields = [f for f in df.schema.fields if f.name not in keep]
    candidates = _n2_candidates(df, cfg, daily, keep)
    blanks = all_null_columns(df, candidates) if blank_all_null else set()
    exprs = []
    for f in fields:
        out = cfg.renames.get(f.name, f.name)
        exprs.append(_column_expr(f.name, f.dataType, cfg, double_cols, f.name in blanks).alias(out))
    exprs += [F.col(k) for k in keep if k in df.columns]
    return df.select(*exprs)


def _n2_candidates(df: DataFrame, cfg: EndpointConfig, daily: bool, keep: tuple[str, ...]) -> list[str]:
    """N2 applies only to columns that are not configured and could hold a value (input names)."""
    configured = cfg.configured if daily else (cfg.configured - set(DOUBLE_COLS))
    return [f.name for f in df.schema.fields if f.name not in keep and f.name not in configured
            and not isinstance(f.dataType, T.NullType)]


def blank_candidates(df: DataFrame, cfg: EndpointConfig, daily: bool | None = None,
                     keep: tuple[str, ...] = ()) -> list[str]:
    """Output names of the columns N2 may blank, for ``normalize(..., blank_all_null=False)`` whose
    N2 is applied later with ``blank_columns`` (e.g. once their NULL counts were observed on write)."""
    daily = cfg.daily if daily is None else daily
    return [cfg.renames.get(c, c) for c in _n2_candidates(df, cfg, daily, keep)]


def blank_columns(df: DataFrame, blanks: set[str]) -> DataFrame:
    """N2 after the fact: each named column becomes "" in every row."""
    if not blanks:
        return df
    return df.select(*[F.lit("").alias(c) if c in blanks else F.col(f"`{c}`") for c in df.columns])


def flatten_struct_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One level of struct fields becomes ``parent_field`` columns (``select s.*`` with prefixes)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType) and f.name not in keep:
            cols += [F.col(f"`{f.name}`.`{sf.name}`").alias(f"{f.name}_{sf.name}") for sf in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
