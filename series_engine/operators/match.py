"""Match audits between two tables on a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import materialize_small


def audit(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """One row: left_rows, right_rows, inner_rows (row-level inner join
    cardinality), left_only, right_only (rows without a partner; NULL keys
    never match).

    Both sides are first reduced to one count per key (partial aggregation),
    so a hot key costs one row, and the full outer join is of key counts:
    inner rows = Σ l·r over matched keys."""
    lc = left.groupBy(F.col(left_on).alias("_k")).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(F.col(right_on).alias("_k")).agg(F.count(F.lit(1)).alias("_r"))
    j = lc.join(rc, "_k", "full_outer")
    return j.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).cast("long").alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).cast("long").alias("right_rows"),
        F.coalesce(F.sum(F.col("_l") * F.col("_r")), F.lit(0)).cast("long").alias("inner_rows"),
        F.coalesce(F.sum(F.when(F.col("_r").isNull(), F.col("_l"))), F.lit(0)).cast("long").alias("left_only"),
        F.coalesce(F.sum(F.when(F.col("_l").isNull(), F.col("_r"))), F.lit(0)).cast("long").alias("right_only"))


def full_outer(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
               drop_right_key: bool = True) -> DataFrame:
    """Full outer equi join; the right key is dropped, so right-only rows show
    a NULL left key (the unmatched count per column then reads off a null
    profile).

    Spark does not split a hot key of a full outer join, so the join is made
    of parts that it can split: a left join (the right side broadcast when its
    size is proven small), and the right rows whose key the left's distinct
    keys do not hold."""
    local = materialize_small(right)
    side = F.broadcast(local) if local is not None else right
    side = side.select(F.col(right_on).alias("_r_key"), F.struct(*[F.col(c) for c in right.columns]).alias("_r"))
    rest = [c for c in right.columns if not (drop_right_key and c == right_on)]
    both = left.join(side, left[left_on] == side["_r_key"], "left").select(
        *[left[c] for c in left.columns], *[F.col("_r").getField(c).alias(c) for c in rest])
    keys = left.select(F.col(left_on).alias("_l_key")).distinct()
    alone = right.join(keys, right[right_on] == keys["_l_key"], "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return both.unionAll(alone.select(*empty, *[right[c] for c in rest]))
