"""Row cleaning: null/NaN drop, clipping, bounds checks, threshold split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fx


def drop_incomplete(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows with a NULL — or a NaN in a float column — in ``cols``
    (all columns by default)."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def clip(df: DataFrame, cols, threshold: float = 20.0) -> DataFrame:
    """Clip each column to [-threshold, +threshold], keeping its type.
    NULL and NaN pass through unchanged."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: fx.clip(c, threshold, types[c]) for c in cols})


def out_of_bounds(df: DataFrame, cols, threshold: float) -> DataFrame:
    """Rows where any of ``cols`` has an absolute value above ``threshold``."""
    cond = reduce(lambda a, b: a | b, [F.abs(F.col(c)) > F.lit(float(threshold)) for c in cols])
    return df.filter(cond)


def count_out_of_bounds(df: DataFrame, cols, threshold: float) -> DataFrame:
    return out_of_bounds(df, cols, threshold).agg(F.count(F.lit(1)).alias("n_out_of_bounds"))


def split_at(df: DataFrame, col: str, threshold) -> tuple[DataFrame, DataFrame]:
    """(rows with col <= threshold, rows with col > threshold); NULL in neither.
    Two filters over one scan definition; each pushes down to Parquet."""
    c = F.col(col)
    return df.filter(c <= F.lit(threshold)), df.filter(c > F.lit(threshold))
