"""Queries on streams that files cut in the middle of series, and on folders with
a commit log (registered beside ``queries``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import streaming
from ..functions.columns import round6
from ..operators import clean, evaluate
from ..session import scratch_path
from ..sinks import commits, writers
from ..sources import readers
from . import model as mdl
from .more_queries import _TEST, _TRAIN, KEYS, _stump_params, _stump_sql
from .queries import B2_AXES, B2_BY, B2_ORDER, b2_split, query, table

CUT_P, CUT_N, CUT_STEP, CUT_FILES = 2, 6, 3, 3


def _cut_files(df, path: str, files: int = CUT_FILES) -> None:
    """One file per stretch of time, oldest first, or several for a stretch of many
    rows: every entity's series is cut."""
    lim = df.agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")).first()
    day = F.datediff(F.col("l_shipdate"), F.lit(lim.a))
    width = (lim.b - lim.a).days // files + 1
    writers.write_in_turn(df, path, F.floor(day / width), B2_ORDER)


def _cut_sql() -> str:
    w = "PARTITION BY l_suppkey, run ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey"
    avg = ", ".join(f"avg({c}) OVER ({w} ROWS BETWEEN {CUT_P} PRECEDING AND CURRENT ROW) AS {c}" for c in B2_AXES)
    out = ", ".join(f"round(lag({c}, 1) OVER ({w}), 6) + 0.0 AS {c}_first, round(lag({c}, {CUT_N}) OVER ({w}), 6) + 0.0 AS {c}_last"
                    for c in B2_AXES)
    return f"""WITH e AS (SELECT *, CAST(year(l_shipdate) // 2 AS VARCHAR) AS era FROM lineitem),
i AS (SELECT *, coalesce(CAST(era <> lag(era) OVER o AS BIGINT), 0) AS ind FROM e
  WINDOW o AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)),
r AS (SELECT *, CAST(sum(ind) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i),
s AS (SELECT {KEYS}, run, {avg} FROM r),
g AS (SELECT {KEYS}, run, row_number() OVER ({w}) - {CUT_N} AS rank, {out} FROM s)
SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM g WHERE rank > 0 AND rank % {CUT_STEP} = 0"""


def _cut_features(spark, sf, files: int, **stream):
    """Features of a stream over the table cut into files, read with these options."""
    era = F.floor(F.year("l_shipdate") / 2).cast("string").alias("era")
    li = table(spark, sf, "lineitem").select(*B2_BY, *B2_ORDER, era, *B2_AXES)
    src, base = scratch_path(spark, "cut-src"), scratch_path(spark, "cut-out")
    _cut_files(li, src, files)
    chain = streaming.Chain(cols=B2_AXES, by=B2_BY, order=B2_ORDER, label="era", period=CUT_P, n=CUT_N, step=CUT_STEP,
                            event_col="run", unique_order=True)
    fan = stream.pop("compact_fan", None)
    q = streaming.features_stream(readers.read_stream_dir(spark, src, li.schema, **stream), base, chain,
                                  streaming.trigger_kwargs(available_now=True), snapshot_every=2, compact_fan=fan)
    q.awaitTermination()
    out = []
    for c in B2_AXES:
        out += [round6(F.col(f"{c}_lags")[0]).alias(f"{c}_first"), round6(F.col(f"{c}_lags")[CUT_N - 1]).alias(f"{c}_last")]
    return streaming.read_rows(spark, base).select(*B2_BY, *B2_ORDER, "run", "rank", *out)


@query("stream_features_cut", _cut_sql())
def q_stream_features_cut(spark, sf):
    """The feature chain over a stream whose files cut every supplier's series and
    its runs (two years each): what one batch job over all rows gives."""
    return _cut_features(spark, sf, CUT_FILES, max_files_per_trigger=1)


@query("stream_backlog", _cut_sql())
def q_stream_backlog(spark, sf):
    """The same over a backlog of files taken in batches of bounded bytes, read files
    removed, finished batches merged by levels."""
    return _cut_features(spark, sf, 2 * CUT_FILES, max_bytes_per_trigger=64 << 10, clean_source="delete", compact_fan=2)


@query("stream_score_cut", _stump_sql(_TRAIN, _TEST, f"SELECT {KEYS}, predicted_action FROM p"))
def q_stream_score_cut(spark, sf):
    """Predictions over a stream whose files cut every supplier's series."""
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    m = mdl.fit(train, _stump_params())
    src, base = scratch_path(spark, "cut-src"), scratch_path(spark, "cut-out")
    _cut_files(test, src)
    q = streaming.score_stream(readers.read_stream_dir(spark, src, li.schema, max_files_per_trigger=1), m, base,
                               streaming.trigger_kwargs(available_now=True), columns=(*B2_BY, *B2_ORDER))
    q.awaitTermination()
    return streaming.read_rows(spark, base, "predictions")


@query("append_once_retries", "SELECT event_id, user_id, event_type, value FROM events")
def q_append_once_retries(spark, sf):
    """The table in four appends of which each is retried and one died before its
    record, compacted in between: every row once."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    base = scratch_path(spark, "once")
    log = commits.CommitLog(spark, base)
    ev.where("event_id % 4 = 2").write.parquet(log.attempt("rows", 2))  # files without a record
    for part in range(4):
        rows = ev.where(F.col("event_id") % 4 == part)
        for _ in range(2):
            commits.append_once(rows, base, part)
        if part == 2:
            log.compact("rows", keep=1)
    return log.read("rows", ev.schema)


@query("publish_once_stream", "SELECT event_id, user_id, event_type, value FROM events")
def q_publish_once_stream(spark, sf):
    """Published runs, each retried, as a file stream sees them."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    base, out = scratch_path(spark, "published"), scratch_path(spark, "seen")
    for run in range(3):
        for _ in range(2):
            commits.publish_once(ev.where(F.col("event_id") % 3 == run), base, f"run {run}")
    q = (readers.read_stream_dir(spark, commits.stream_path(base), ev.schema).writeStream.format("parquet")
         .option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(ev.schema).parquet(out)


@query("metrics_once", """WITH c AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels)
SELECT run, 'accuracy' AS metric, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS value
FROM c, (SELECT unnest(['first', 'second']) AS run) GROUP BY run""")
def q_metrics_once(spark, sf):
    """Two runs logged twice each: each counts once."""
    m = evaluate.metrics(table(spark, sf, "labels"), "quality", "toxic")
    path = scratch_path(spark, "metrics-once")
    for run in ("first", "second", "first", "second"):
        writers.append_metrics_once(m, path, run, f"models/{run}")
    rows = commits.CommitLog(spark, path).read("metrics").where("metric = 'accuracy'")
    return rows.select("run", "metric", round6("value").alias("value"))


@query("sized_partition_update", """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice + 1 ELSE l_extendedprice END AS price FROM lineitem""")
def q_sized_partition_update(spark, sf):
    """The table in folders with files of a byte target, then one folder written anew."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                                             F.col("l_extendedprice").cast("double").alias("price"))
    path = scratch_path(spark, "sized")
    writers.write_sized(li, path, "l_returnflag", order=["l_orderkey", "l_linenumber", "l_partkey"], target_bytes=256 << 10)
    writers.write_sized(li.where("l_returnflag = 'R'").withColumn("price", F.col("price") + 1), path, "l_returnflag", target_bytes=256 << 10)
    return readers.read_partitioned(spark, path, schema=li.schema)


_PROFILED = ["l_quantity", "l_discount", "l_shipdate", "l_linestatus"]


@query("profile_after_appends", f"""WITH n AS (SELECT CAST(nullif(l_quantity, 7) AS DOUBLE) AS l_quantity, CAST(l_discount AS DOUBLE) AS l_discount,
  CAST(l_shipdate AS DATE) AS l_shipdate, l_linestatus FROM lineitem)
{" UNION ALL ".join(f'''SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null, {
    f"min({c}) AS low, max({c}) AS high, CAST(NULL AS VARCHAR) AS low_text, CAST(NULL AS VARCHAR) AS high_text" if c in ("l_quantity", "l_discount")
    else f"CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, CAST(min({c}) AS VARCHAR) AS low_text, CAST(max({c}) AS VARCHAR) AS high_text"
} FROM n''' for c in _PROFILED)}""")
def q_profile_after_appends(spark, sf):
    """Exact part of the profile of a table that came in three appends, each
    retried; every append reads its own rows alone."""
    from ..operators import profile_state
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif(F.col("l_quantity"), F.lit(7)).cast("double").alias("l_quantity"), F.col("l_discount").cast("double").alias("l_discount"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_linestatus")
    log = profile_state.ProfileLog(spark, scratch_path(spark, "profile"), _PROFILED, ["l_linestatus"])
    for part in range(3):
        for _ in range(2):
            log.add(li.where(F.col("l_orderkey") % 3 == part), part)
        if part == 1:
            log.compact()
    return profile_state.report(log.state()).select("column", "n_rows", "n_null", "low", "high", "low_text", "high_text")
