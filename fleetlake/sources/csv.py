"""CSV exports of the fleet (asset list, daily utilisation sheet).

Format facts of these files: header row, UTF-8 with a byte-order mark, dates as ``M/d/yyyy``,
booleans as ``Yes``/``No``, whole-number doubles written without a fraction (``19``), and codes that
look numeric but are text (model ``320``) — so the schema is declared, never inferred.
Spark's CSV reader drops the BOM; dates and booleans are parsed leniently (bad cell -> NULL). Cells may hold quotes
(doubled) and line breaks; columns are found by their header, so a sheet with another order of columns reads the
same, and one that lacks a declared column fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.casts import to_boolean_lenient

# The two exported sheets
ASSETS_CSV_SCHEMA = T.StructType([
    T.StructField("asset_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("make", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("year", T.IntegerType()), T.StructField("status", T.StringType()),
    T.StructField("billable", T.StringType()), T.StructField("asset_type", T.StringType()),
    T.StructField("purchase_price", T.DoubleType()),
])
UTILIZATION_CSV_SCHEMA = T.StructType([
    T.StructField("asset_id", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("utilization_percentage", T.DoubleType()), T.StructField("active_hours", T.DoubleType()),
    T.StructField("site_name", T.StringType()), T.StructField("assignee_name", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, date_cols: Sequence[str] = (),
             bool_cols: Sequence[str] = (), date_format: str = "M/d/yyyy") -> DataFrame:
    reader = (spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", True))
    # every cell as text under the sheets' own headers, then the declared types
    found = reader.option("inferSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in found.columns]
    if missing:
        raise ValueError(f"the sheet lacks the columns {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in found.columns])
    sheet = reader.schema(text).option("enforceSchema", False).csv(path)
    raw = sheet.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields))
    cols = []
    for f in raw.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in date_cols:
            c = F.to_date(F.try_to_timestamp(c, F.lit(date_format))).cast("timestamp")
        elif f.name in bool_cols:
            c = to_boolean_lenient(c)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, date_cols: Sequence[str] = (), bool_cols: Sequence[str] = (),
              date_format: str = "M/d/yyyy") -> None:
    """Write in the same sheet format (dates ``M/d/yyyy``, booleans ``Yes``/``No``)."""
    cols = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in date_cols:
            x = F.date_format(x, date_format)
        elif c in bool_cols:
            x = F.when(x, "Yes").when(~x, "No")
        cols.append(x.alias(c))
    df.select(*cols).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
