"""Classification metrics from (label, prediction) pairs, DataFrame only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, materialize_small


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
            max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Long format (metric, class, value): ``accuracy`` (class NULL), and
    ``precision`` / ``recall`` for every class seen in the label column.
    A class never predicted has precision 0.

    One pass over ``df`` (which may be a whole scoring plan): every pair
    adds an "actual" record to its label's class and a "predicted" record to
    its prediction's class, and one grouped count per class (partial
    aggregation, at most one row per class) gives actual, predicted and true
    positive counts.  The metrics are read off that small table."""
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    recs = df.select(F.explode(F.array(
        F.struct(lab.alias("class"), one.alias("a"), zero.alias("p"),
                 F.when(lab == pred, one).otherwise(zero).alias("t")),
        F.struct(pred.alias("class"), zero.alias("a"), one.alias("p"), zero.alias("t")))).alias("r"))
    per = recs.groupBy(F.col("r.class").alias("class")).agg(
        F.sum("r.a").alias("actual"), F.sum("r.p").alias("predicted"), F.sum("r.t").alias("tp"))
    local = materialize_small(per, max_rows)
    per = local if local is not None else per
    seen = per.filter(F.col("class").isNotNull() & (F.col("actual") > 0))
    prec = seen.select(F.lit("precision").alias("metric"), "class",
                       F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted"))
                        .otherwise(F.lit(0.0)).alias("value"))
    rec = seen.select(F.lit("recall").alias("metric"), "class", (F.col("tp") / F.col("actual")).alias("value"))
    acc = per.agg((F.sum("tp") / F.sum("actual")).alias("value")).select(
        F.lit("accuracy").alias("metric"), F.lit(None).cast("double").alias("class"),
        F.coalesce("value", F.lit(0.0)).alias("value"))
    return acc.unionByName(prec).unionByName(rec)
