"""Lenient casts: malformed input becomes NULL instead of failing the job.

Spark 4 runs with ANSI casts, where ``cast('abc' as bigint)`` raises. The loaders must keep the
older lenient behaviour (bad cell -> NULL) without turning ANSI off for the whole session, so every
cast here is a ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_timestamp_lenient(c) -> Column:
    return _c(c).try_cast("timestamp")


def to_long_lenient(c, src_type: T.DataType | None = None) -> Column:
    """String/number -> BIGINT; ``"12.7"`` -> 12 (truncation), ``"abc"`` -> NULL.

    Integral strings are tried as BIGINT first, so digit strings longer than 2^53 stay exact; only
    strings that are not integral go through DOUBLE.
    """
    c = _c(c)
    if src_type is not None and isinstance(src_type, (T.IntegralType, T.BooleanType)):
        return c.try_cast("bigint")
    if src_type is not None and isinstance(src_type, (T.FractionalType,)):
        return F.when(F.isnan(c.cast("double")), F.lit(None).cast("bigint")).otherwise(c.try_cast("bigint"))
    as_double = _text_to_double(c)
    return F.coalesce(
        F.when(c.rlike(_WHOLE_NUMBER), c.try_cast("bigint")),
        F.when(F.isnan(as_double), F.lit(None).cast("bigint")).otherwise(as_double.try_cast("bigint")),
    )


# a parse that fails costs an exception a row, so text that can't be a whole number, or doesn't begin like a number, an infinity or a
# NaN, is told by its looks
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER_BEGINS = r"^\s*[+-]?(?:\.?[0-9]|(?i:inf|nan))"


def _text_to_double(c: Column) -> Column:
    return F.when(c.rlike(_NUMBER_BEGINS), c.try_cast("double"))


def to_double_lenient(c, src_type: T.DataType | None = None) -> Column:
    """String/number -> DOUBLE; NaN -> NULL, so one bad cell does not spoil an average."""
    c = _c(c)
    x = _text_to_double(c) if isinstance(src_type, T.StringType) else c.try_cast("double")
    return F.when(~F.isnan(x), x)


def to_type_lenient(c, src_type: T.DataType, to: T.DataType) -> Column:
    """A cell as the stored type of its column: what does not fit is NULL, objects become their JSON text."""
    c = _c(c)
    if src_type == to:
        return c
    if isinstance(src_type, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(c) if isinstance(to, T.StringType) else F.lit(None).cast(to)   # an object is no number, time or flag
    if isinstance(to, T.StringType):
        return c.cast("string")
    if isinstance(to, T.LongType):
        return to_long_lenient(c, src_type)
    if isinstance(to, T.DoubleType):
        return to_double_lenient(c, src_type)
    return c.try_cast(to)


def to_boolean_lenient(c) -> Column:
    """Accepts true/false, t/f, yes/no, y/n, 1/0 (case-insensitive); anything else -> NULL."""
    return _c(c).try_cast("boolean")


# Places kept before rounding a double (M1). A double carries ~16 significant digits; 12 places absorb
# its binary error (2.175 is stored as 2.17499999999999982...) without moving a real digit.
ROUND_SCALE = 12


def round_half_up(c, digits: int) -> Column:
    """``ROUND(x, digits)`` of a double, HALF_UP on its decimal value, as DOUBLE.

    Engines disagree at a decimal tie: Spark rounds the shortest decimal text of the double (2.18),
    others the binary value (2.17). Rounding the DECIMAL(38, 12) form gives the same answer everywhere;
    ``sql_round`` is the same rule as SQL text.
    """
    return F.round(_c(c).cast(f"decimal(38,{ROUND_SCALE})"), digits).cast("double")


def sql_round(expr: str, digits: int) -> str:
    """SQL text of ``round_half_up`` (for SQL consumers and the oracle)."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,{ROUND_SCALE})), {digits}) AS DOUBLE)"
