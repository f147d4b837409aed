"""Class weights (inverse frequency, most frequent class = 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, join_small, materialize_small


def weight_table(df: DataFrame, label: str, out: str = "weight",
                 max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row per label: weight = max_count / count (equal to
    (total / count) normalised by the smallest such ratio).

    Label counts come from one partial aggregation; when there are at most
    ``max_rows`` labels they are returned as a local relation (computed once,
    broadcastable)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    local = materialize_small(counts, max_rows)
    if local is not None:
        top = max((r["_n"] for r in local.collect()), default=None)
        if top is None:
            return local.select(label, F.lit(None).cast("double").alias(out))
        return local.select(label, (F.lit(float(top)) / F.col("_n")).alias(out))
    top = counts.agg(F.max("_n")).collect()[0][0]  # one number
    return counts.select(label, (F.lit(float(top)) / F.col("_n")).alias(out))


def class_weights(df: DataFrame, label: str = "label", out: str = "weight",
                  table: DataFrame | None = None,
                  max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out``: the weight of each row's label.  The weight column is
    present even on empty input.  A NULL label gets a NULL weight."""
    table = table if table is not None else weight_table(df, label, out, max_rows)
    t = table.withColumnRenamed(label, "_se_lbl")
    j = join_small(df, t, lambda big, small: big[label].eqNullSafe(small["_se_lbl"]), "left", max_rows)
    return j.drop("_se_lbl")
