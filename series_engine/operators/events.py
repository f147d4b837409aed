"""Run ("event") separation: gaps-and-islands over an ordered label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sequence


def change_indicator(df: DataFrame, label: str, by, order, out: str = "indicator") -> DataFrame:
    """1 where ``label`` differs from the previous row's label in the entity's
    order, else 0 (first row, or NULL on either side: 0).

    Plain window per entity; ``separate`` is the skew-safe path that uses it
    chunk by chunk."""
    w = Window.partitionBy(*sequence._cols(by)).orderBy(*sequence._cols(order))
    return df.withColumn(out, F.coalesce((F.col(label) != F.lag(label).over(w)).cast("int"), F.lit(0)))


def separate(df: DataFrame, label: str, out: str = "event", by=None, order=None,
             run_order=None, chunk_width=None, unique_order: bool = False) -> DataFrame:
    """Number the runs of equal ``label`` per entity, from 0.

    A new run starts where the label changes from the previous row (order
    ``order``).  The running count uses a RANGE frame over ``run_order``
    (defaults to ``order``), so rows with equal ``run_order`` values share an
    id.  Hot entities are split into chunks (see ``sequence.index``); the
    result does not depend on ``chunk_width``.
    """
    return sequence.index(df, by, order, label=label, run_order=run_order,
                          event_col=out, chunk_width=chunk_width, keep_internal=False,
                          unique_order=unique_order)
