"""Exploratory profiling: every report is an aggregation that Spark runs with
partial (map-side) aggregation; only one-row summaries reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..session import write_table
from .joins import materialize_small


def overview(df: DataFrame, name: str, detail: bool = True) -> DataFrame:
    """One row: table name and row count; with ``detail`` also the input
    partition count (planned splits, no data read), column count and schema."""
    out = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
    if not detail:
        return out
    parts = df.rdd.getNumPartitions()
    return out.select("*", F.lit(parts).alias("partitions"), F.lit(len(df.columns)).alias("n_columns"),
                      F.lit(df.schema.simpleString()).alias("schema"))


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """One row, one column per input column: number of NULL (or NaN for
    float columns) values."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols) if cols else df.columns
    return df.agg(*[F.count(F.when(fx.is_missing(c, types[c]), F.lit(1))).alias(c) for c in cols])


def group_counts(df: DataFrame, key, descending: bool = True, out: str = "count") -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.col(out).desc() if descending else F.col(out).asc())


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(col).distinct()


def extremes(df: DataFrame, abs_cols=(), range_cols=()) -> DataFrame:
    """max(|c|) for ``abs_cols`` and min/max for ``range_cols`` in one pass."""
    aggs = [F.max(F.abs(F.col(c))).alias(f"max_abs_{c}") for c in abs_cols]
    for c in range_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def top_entity(df: DataFrame, entity: str, label: str, k: int = 1) -> DataFrame:
    """Entities with most distinct labels, then most rows (entity ascending
    breaks ties).  Sort + limit runs as a per-partition top-k."""
    per = (df.filter(F.col(label).isNotNull())
             .groupBy(entity)
             .agg(F.countDistinct(label).alias("n_labels"), F.count(F.lit(1)).alias("n_rows")))
    return per.orderBy(F.col("n_labels").desc(), F.col("n_rows").desc(), F.col(entity).asc()).limit(k)


def _side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a small table when a bounded collect proves it small."""
    local = materialize_small(df, max_rows)
    return F.broadcast(local) if local is not None else df


def exact_quantiles(long: DataFrame, keys, value: str, probs) -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont`` semantics) per
    group without gathering a group's values in one task.

    Rows are first summed to one row per distinct (group, value), then dealt
    into ranges of the order (group, value) by row count, so a group is spread
    over as many tasks as it is large, and values a group repeats are one row.
    Running counts inside a range plus the counts of the group's earlier
    ranges give every value its ranks; the values that hold the needed ranks
    ``floor/ceil((n - 1) p)`` are picked by a filter.  The source is read a
    fixed number of times whatever the values are; infinities are ordinary
    values at the ends.  Returns keys, ``n`` and ``q{i}`` per probability."""
    keys = list(keys)
    counts = write_table(long.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_m")), "quantile-counts")
    dealt = write_table(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "quantile-ranges")
    parts = dealt.groupBy(*keys, "_part").agg(F.sum("_m").alias("_pm"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    # one row per group and range that it touches
    parts = parts.select(*keys, "_part", F.coalesce(F.sum("_pm").over(before), F.lit(0)).alias("_base"),
                         F.sum("_pm").over(whole).alias("_n"))
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("_in", F.coalesce(F.sum("_m").over(inside), F.lit(0)))
    same = [ranked[k].eqNullSafe(parts[k]) for k in keys] + [ranked["_part"] == parts["_part"]]
    ranked = ranked.join(parts, same).select(*[ranked[k] for k in keys], F.col(value).alias("_val"), "_m", "_n",
                                             (F.col("_base") + F.col("_in")).alias("_first"))
    aggs, held = [], []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for name, r in ((f"_lo{i}", F.floor(h)), (f"_hi{i}", F.ceil(h))):
            hit = (r >= F.col("_first")) & (r < F.col("_first") + F.col("_m"))
            held.append(hit)
            aggs.append(F.max(F.when(hit, F.col("_val"))).alias(name))
    needed = held[0]
    for hit in held[1:]:
        needed = needed | hit
    out = ranked.filter(needed).groupBy(*keys, "_n").agg(*aggs)

    def between(i, p):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        h = (F.col("_n") - 1) * F.lit(float(p))
        # equal ends stay as they are: infinity minus infinity is no number
        return F.when(lo == hi, lo).otherwise(lo + (h - F.floor(h)) * (hi - lo)).alias(f"q{i}")

    return out.select(*keys, F.col("_n").alias("n"), *[between(i, p) for i, p in enumerate(probs)])


def quartiles(df: DataFrame, by, cols, exact: bool = True, accuracy: int = 10_000,
              whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group and column (long format): n, q1, median, q3,
    iqr, fences q1 - 1.5 iqr / q3 + 1.5 iqr, whiskers (extreme values inside
    the fences) and the count of values outside.

    ``exact`` selects the exact order statistics (``exact_quantiles``: no
    group is gathered in one task); otherwise ``percentile_approx`` with
    bounded memory per group."""
    by = [by] if isinstance(by, str) else list(by)
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        by, list(cols), "column", "v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    keys = [*by, "column"]
    if exact:
        stats = exact_quantiles(long, keys, "v", [0.25, 0.5, 0.75]).select(
            *keys, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    else:
        q = F.percentile_approx("v", [0.25, 0.5, 0.75], accuracy)
        stats = (long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), q.alias("_q"))
                     .select(*keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                             F.col("_q")[2].alias("q3")))
    stats = (stats.withColumn("iqr", F.col("q3") - F.col("q1"))
                  .withColumn("lower_fence", F.col("q1") - F.lit(whisker) * F.col("iqr"))
                  .withColumn("upper_fence", F.col("q3") + F.lit(whisker) * F.col("iqr")))
    inside = (F.col("v") >= F.col("lower_fence")) & (F.col("v") <= F.col("upper_fence"))
    small = materialize_small(stats)  # one row per (group, column): computed once
    if small is not None:
        stats = small
        fences = F.broadcast(stats.select(*keys, "lower_fence", "upper_fence"))
    else:
        fences = stats.select(*keys, "lower_fence", "upper_fence")
    tail = (long.join(fences, keys)
            .groupBy(*keys).agg(F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
                                F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
                                F.count(F.when(~inside, F.lit(1))).alias("n_outliers")))
    return stats.join(tail, keys, "inner")


def _scalar_row(df: DataFrame):
    """The single row of a global aggregate (bounded: one row)."""
    return df.collect()[0]


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of ``col`` over [min, max]: bucket, edges, count.
    Empty buckets are not listed; the max value falls in the last bucket."""
    c = F.col(col).cast("double")
    valid = df.filter(c.isNotNull() & ~F.isnan(c))
    lo, hi = _scalar_row(valid.agg(F.min(c), F.max(c)))
    if lo is None:
        return valid.select(F.lit(0).alias("bucket"), F.lit(0.0).alias("lower"),
                            F.lit(0.0).alias("upper"), F.lit(0).cast("long").alias("count")).limit(0)
    width = (hi - lo) / bins
    if width > 0:
        b = F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    else:
        b = F.lit(0)
    return (valid.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
                 .select("bucket",
                         (F.lit(lo) + F.col("bucket") * F.lit(width)).alias("lower"),
                         (F.lit(lo) + (F.col("bucket") + 1) * F.lit(width)).alias("upper"),
                         "count"))


def histograms(df: DataFrame, cols, bins: int = 20) -> DataFrame:
    """Equal-width histograms of several numeric columns in one scan (long
    format: column, bucket, lower, upper, count).  One global aggregate gives
    every column's range; each row then yields one bucket per column and a
    single grouped count (partial aggregation) does the rest."""
    cols = list(cols)
    mm = _scalar_row(df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(cols)],
                            *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(cols)]))
    lo = {c: mm[f"lo_{i}"] for i, c in enumerate(cols)}
    width = {c: ((mm[f"hi_{i}"] - lo[c]) / bins if lo[c] is not None else 0.0) for i, c in enumerate(cols)}
    buckets = []
    for c in cols:
        v = F.col(c).cast("double")
        if lo[c] is None:
            b = F.lit(None).cast("int")
        elif width[c] > 0:
            b = F.least(F.floor((v - F.lit(lo[c])) / F.lit(width[c])), F.lit(bins - 1)).cast("int")
        else:
            b = F.when(v.isNotNull(), F.lit(0))
        buckets.append(F.when(~F.isnan(v), b).alias(c))
    long = df.select(*buckets).unpivot([], cols, "column", "bucket").filter(F.col("bucket").isNotNull())
    counts = long.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("count"))
    lo_m = F.create_map(*[x for c in cols if lo[c] is not None for x in (F.lit(c), F.lit(float(lo[c])))])
    w_m = F.create_map(*[x for c in cols if lo[c] is not None for x in (F.lit(c), F.lit(float(width[c])))])
    return counts.select("column", "bucket",
                         (lo_m[F.col("column")] + F.col("bucket") * w_m[F.col("column")]).alias("lower"),
                         (lo_m[F.col("column")] + (F.col("bucket") + 1) * w_m[F.col("column")]).alias("upper"),
                         "count")


def split_thresholds(lo: int, hi: int, start_frac: float = 0.7, end_frac: float = 0.9,
                     steps: int = 10) -> list[int]:
    span = hi - lo
    start = int(span * start_frac) + lo
    end = int(span * end_frac) + lo
    step = max((end - start) // steps, 1)
    return list(range(start, end, step))


def split_sweep(df: DataFrame, col: str, start_frac: float = 0.7, end_frac: float = 0.9,
                steps: int = 10) -> DataFrame:
    """Train/test shares for candidate id thresholds between 70% and 90% of
    the id range: one pass of conditional counts for all thresholds."""
    c = F.col(col)
    lo, hi = _scalar_row(df.agg(F.min(c), F.max(c)))
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "threshold long, train_rows long, test_rows long, train_share double, test_share double")
    ths = split_thresholds(int(lo), int(hi), start_frac, end_frac, steps)
    aggs = []
    for i, t in enumerate(ths):
        aggs += [F.count(F.when(c <= F.lit(t), F.lit(1))).alias(f"tr{i}"),
                 F.count(F.when(c > F.lit(t), F.lit(1))).alias(f"te{i}")]
    wide = df.agg(*aggs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(t).cast("long").alias("threshold"), F.col(f"tr{i}").alias("train_rows"),
                 F.col(f"te{i}").alias("test_rows")) for i, t in enumerate(ths)])).alias("s")).select("s.*")
    total = F.col("train_rows") + F.col("test_rows")
    return stacked.select("threshold", "train_rows", "test_rows",
                          F.round(F.col("train_rows") / total, 2).alias("train_share"),
                          F.round(F.col("test_rows") / total, 2).alias("test_share"))


def longest_run(df: DataFrame, by, event: str, label: str, order=None,
                rows: DataFrame | None = None) -> DataFrame:
    """Per label, the run with most rows (ties: smallest entity, then run id):
    label, entity, run, n_rows, and the run's first / last order values.

    Built from aggregates only (rows per run, best run per label), so no
    label's runs are funnelled through one window task.  With
    ``rows`` (the source rows) and ``order``, the winning runs' rows are
    returned: a run is the contiguous order range [first, last] of its
    entity, so the rows come from a broadcast range join of the (one row per
    label) winners against a plain scan of ``rows`` — the run numbering is
    not computed a second time."""
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order or [])
    ok = F.struct(*order) if order else F.lit(None)
    runs = df.groupBy(label, *by, event).agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.min(ok).alias("_first"), F.max(ok).alias("_last"))
    # the longest run, among ties the smallest (entity, run): one aggregate per
    # label, NULL labels and entities included
    key = F.struct((-F.col("n_rows")).alias("_less"), *by, event)
    best = (runs.groupBy(label).agg(F.min_by(F.struct("n_rows", *by, event, "_first", "_last"), key).alias("_k"))
                .select(label, "_k.n_rows", *[F.col(f"_k.{c}").alias(c) for c in [*by, event, "_first", "_last"]]))
    if rows is None or not order:
        return best
    small = materialize_small(best)
    side = F.broadcast(small) if small is not None else best
    side = side.select(*[F.col(c).alias(f"_b_{c}") for c in side.columns])
    cond = F.struct(*[rows[o] for o in order]).between(side["_b__first"], side["_b__last"])
    for b in by:
        cond = cond & rows[b].eqNullSafe(side[f"_b_{b}"])
    out = rows.join(side, cond, "inner")
    return out.select(*rows.columns, F.col(f"_b_{event}").alias(event), F.col("_b_n_rows").alias("n_rows"))
