"""Column expressions.  All are built-in Catalyst expressions (no Python
worker), so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType,
                               FloatType, NumericType, StructType,
                               TimestampNTZType, TimestampType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c, dtype: DataType | None = None) -> Column:
    """True for NULL, and for NaN when the column is floating point.

    ``isnan`` is only applied to float/double columns: under ANSI mode it
    would try to cast text to a number and fail.
    """
    col = _col(c)
    if isinstance(dtype, (FloatType, DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def clip(c, threshold: float, dtype: DataType | None = None) -> Column:
    """Values beyond ±threshold become the bound; NULL and NaN pass through.

    With ``dtype`` the result is cast back to it (float stays float)."""
    col = _col(c)
    t = float(threshold)
    out = (F.when(F.isnan(col), col)
           .when(col > F.lit(t), F.lit(t))
           .when(col < F.lit(-t), F.lit(-t))
           .otherwise(col))
    return out.cast(dtype) if dtype is not None else out


def round6(c, digits: int = 6) -> Column:
    """Round, and fold ``-0.0`` into ``0.0`` (adding 0.0 does that in IEEE)."""
    return F.round(_col(c), digits) + F.lit(0.0)


def strip_and_cast(c, suffix: str, to: str) -> Column:
    """Remove every ``suffix`` occurrence, then ``try_cast``: bad text → NULL
    instead of an ANSI error."""
    return F.replace(_col(c), F.lit(suffix), F.lit("")).try_cast(to)


def json_encode(*cols) -> Column:
    """JSON text of a struct of the given columns (NULL fields are omitted)."""
    if not cols:
        return F.to_json(F.struct(F.col("*")))
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def json_decode(c, schema: StructType | str) -> Column:
    """Parse JSON text into a struct; a field that does not parse is NULL."""
    return F.from_json(_col(c), schema)


def chunk_of(c, dtype: DataType, width) -> Column:
    """Monotone coarse bucket of an order column, used to split one entity's
    series into independent pieces.

    ``width`` is in seconds for timestamp/date columns and in the column's own
    unit for numeric columns.  Rows in order never map to a smaller bucket, and
    equal values always share a bucket (peers never straddle two pieces).
    """
    col = _col(c)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        micros = F.unix_micros(col.cast("timestamp"))
        return F.floor(micros / F.lit(float(width) * 1_000_000.0)).cast("long")
    if isinstance(dtype, DateType):
        return F.floor(F.unix_date(col) / F.lit(max(float(width) / 86400.0, 1.0))).cast("long")
    if isinstance(dtype, (NumericType, DecimalType)):
        return F.floor(col / F.lit(float(width))).cast("long")
    raise TypeError(f"cannot bucket an order column of type {dtype}")
