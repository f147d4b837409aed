"""Registered queries: each runs one operator family of the library over the
driver tables, with the equivalent DuckDB SQL where one exists.

Bindings:
  B1 ``events``   entity user_id, order (ts, event_id), label event_type,
                  axes value and k (the ``k`` field of the ``props`` JSON).
  B2 ``lineitem`` entity l_suppkey, order (l_shipdate, l_orderkey,
                  l_linenumber, l_partkey), label l_linestatus,
                  axes l_quantity, l_extendedprice, l_discount.
Doubles coming out of aggregates or windows are rounded to 6 digits (and
-0.0 folded to 0.0) in both engines; integer counts are bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import json_decode, json_encode, round6
from ..operators import (balance, clean, evaluate, events, features, match,
                         profile, sampling)
from ..operators.joins import materialize_small
from ..session import scratch_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

B1_BY, B1_ORDER, B1_LABEL = ["user_id"], ["ts", "event_id"], "event_type"
B2_BY, B2_ORDER, B2_LABEL = ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], "l_linestatus"
B2_AXES = ["l_quantity", "l_extendedprice", "l_discount"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def b1(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.withColumn("k", json_decode("props", "k int").getField("k"))


def b1_with_nulls(spark, sf) -> DataFrame:
    """B1 with derived NULLs / NaN (the tables themselves hold none)."""
    ev = table(spark, sf, "events")
    v = F.col("value")
    return ev.select("event_id", "ts", "user_id",
                     F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"),
                     F.when(v < 5, F.lit(None)).when(v > 95, F.lit(float("nan"))).otherwise(v).alias("value"),
                     "props")


B1N_SQL = """b AS (SELECT event_id, ts, user_id, nullif(event_type, 'view') AS event_type,
  CASE WHEN value < 5 THEN NULL WHEN value > 95 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value,
  props FROM events)"""
K_SQL = "CAST(json_extract(props, '$.k') AS INTEGER)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- scans, profiles, filters -------------------------------------------------

@query("table_overview", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS row_count, (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns,
  (SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS columns FROM {t}""" for t in TABLES))
def q_table_overview(spark, sf):
    """Rows and columns of every table (SQL has no form of the planned
    partitions and of Spark's schema text, which ``overview`` gives too)."""
    out = None
    for t in TABLES:
        df = table(spark, sf, t)
        o = profile.overview(df, t).select("table_name", "row_count", F.col("n_columns").cast("long").alias("n_columns"),
                                           F.lit(",".join(df.columns)).alias("columns"))
        out = o if out is None else out.unionByName(o)
    return out


@query("null_profile", f"""WITH {B1N_SQL}
SELECT count(CASE WHEN event_id IS NULL THEN 1 END) AS event_id,
       count(CASE WHEN ts IS NULL THEN 1 END) AS ts,
       count(CASE WHEN user_id IS NULL THEN 1 END) AS user_id,
       count(CASE WHEN event_type IS NULL THEN 1 END) AS event_type,
       count(CASE WHEN value IS NULL OR isnan(value) THEN 1 END) AS value,
       count(CASE WHEN props IS NULL THEN 1 END) AS props
FROM b""")
def q_null_profile(spark, sf):
    return profile.null_profile(b1_with_nulls(spark, sf))


@query("drop_any_null", f"""WITH {B1N_SQL}
SELECT * FROM b WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
  AND event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value) AND props IS NOT NULL""")
def q_drop_any_null(spark, sf):
    return clean.drop_incomplete(b1_with_nulls(spark, sf))


@query("clip_bounds", f"""SELECT event_id,
  CASE WHEN isnan(value - 50) THEN value - 50 WHEN value - 50 > 40 THEN 40.0
       WHEN value - 50 < -40 THEN -40.0 ELSE value - 50 END AS value,
  CAST(CASE WHEN {K_SQL} - 50 > 40 THEN 40 WHEN {K_SQL} - 50 < -40 THEN -40
       ELSE {K_SQL} - 50 END AS INTEGER) AS k
FROM events""")
def q_clip_bounds(spark, sf):
    x = b1(spark, sf).select("event_id", (F.col("value") - 50).alias("value"), (F.col("k") - 50).alias("k"))
    return clean.clip(x, ["value", "k"], 40)


@query("out_of_bounds_count", """SELECT count(*) AS n_out_of_bounds FROM lineitem
WHERE abs(l_quantity) > 50000 OR abs(l_extendedprice) > 50000 OR abs(l_discount) > 50000""")
def q_out_of_bounds_count(spark, sf):
    return clean.count_out_of_bounds(table(spark, sf, "lineitem"), B2_AXES, 50000)


@query("extremes", f"""SELECT max(abs(value)) AS max_abs_value, max(abs({K_SQL})) AS max_abs_k,
  min(user_id) AS min_user_id, max(user_id) AS max_user_id FROM events""")
def q_extremes(spark, sf):
    return profile.extremes(b1(spark, sf), abs_cols=["value", "k"], range_cols=["user_id"])


@query("label_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_label_counts(spark, sf):
    return profile.group_counts(table(spark, sf, "events"), "event_type")


@query("entity_counts", "SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY l_suppkey")
def q_entity_counts(spark, sf):
    return profile.group_counts(table(spark, sf, "lineitem"), "l_suppkey")


@query("distinct_labels", "SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL")
def q_distinct_labels(spark, sf):
    return profile.distinct_values(table(spark, sf, "events"), "event_type")


@query("top_entity", """SELECT user_id, count(DISTINCT event_type) AS n_labels, count(*) AS n_rows
FROM events WHERE event_type IS NOT NULL GROUP BY user_id
ORDER BY n_labels DESC, n_rows DESC, user_id LIMIT 1""")
def q_top_entity(spark, sf):
    return profile.top_entity(table(spark, sf, "events"), "user_id", "event_type", 1)


@query("quartiles_by_label", f"""WITH long AS (
  SELECT event_type, 'value' AS axis, CAST(value AS DOUBLE) AS v FROM events
    WHERE value IS NOT NULL AND NOT isnan(value)
  UNION ALL
  SELECT event_type, 'k' AS axis, CAST({K_SQL} AS DOUBLE) AS v FROM events WHERE {K_SQL} IS NOT NULL),
s AS (SELECT event_type, axis, count(*) AS n, quantile_cont(v, 0.25) AS q1,
        quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY event_type, axis),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM s)
SELECT f.event_type, f.axis, f.n, round(f.q1, 6) + 0.0 AS q1, round(f.median, 6) + 0.0 AS median,
  round(f.q3, 6) + 0.0 AS q3, round(f.iqr, 6) + 0.0 AS iqr,
  round(f.lower_fence, 6) + 0.0 AS lower_fence, round(f.upper_fence, 6) + 0.0 AS upper_fence,
  round(min(CASE WHEN l.v >= f.lower_fence AND l.v <= f.upper_fence THEN l.v END), 6) + 0.0 AS lower_whisker,
  round(max(CASE WHEN l.v >= f.lower_fence AND l.v <= f.upper_fence THEN l.v END), 6) + 0.0 AS upper_whisker,
  count(CASE WHEN l.v < f.lower_fence OR l.v > f.upper_fence THEN 1 END) AS n_outliers
FROM f JOIN long l ON l.event_type = f.event_type AND l.axis = f.axis
GROUP BY f.event_type, f.axis, f.n, f.q1, f.median, f.q3, f.iqr, f.lower_fence, f.upper_fence""")
def q_quartiles_by_label(spark, sf):
    q = profile.quartiles(b1(spark, sf), "event_type", ["value", "k"], exact=True)
    q = q.withColumnRenamed("column", "axis")
    dbl = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "lower_whisker", "upper_whisker"]
    return q.withColumns({c: round6(c) for c in dbl})


@query("histogram", """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events
    WHERE value IS NOT NULL AND NOT isnan(value)),
b AS (SELECT CAST(least(floor((e.value - s.lo) / ((s.hi - s.lo) / 20)), 19) AS INTEGER) AS bucket, s.lo, s.hi
    FROM events e, s WHERE e.value IS NOT NULL AND NOT isnan(e.value))
SELECT bucket, round(lo + bucket * ((hi - lo) / 20), 6) + 0.0 AS lower,
  round(lo + (bucket + 1) * ((hi - lo) / 20), 6) + 0.0 AS upper, count(*) AS count
FROM b GROUP BY bucket, lo, hi""")
def q_histogram(spark, sf):
    h = profile.histogram(table(spark, sf, "events"), "value", 20)
    return h.withColumns({"lower": round6("lower"), "upper": round6("upper")})


@query("split_sweep", """WITH mm AS (SELECT min(user_id) AS lo, max(user_id) AS hi FROM events),
p AS (SELECT CAST(floor((hi - lo) * CAST(0.7 AS DOUBLE)) AS BIGINT) + lo AS st,
             CAST(floor((hi - lo) * CAST(0.9 AS DOUBLE)) AS BIGINT) + lo AS en FROM mm),
t AS (SELECT unnest(range(st, en, greatest((en - st) // 10, 1))) AS threshold FROM p),
c AS (SELECT t.threshold, count(CASE WHEN e.user_id <= t.threshold THEN 1 END) AS train_rows,
        count(CASE WHEN e.user_id > t.threshold THEN 1 END) AS test_rows FROM t, events e GROUP BY t.threshold)
SELECT CAST(threshold AS BIGINT) AS threshold, train_rows, test_rows,
  round(train_rows / (train_rows + test_rows), 2) AS train_share,
  round(test_rows / (train_rows + test_rows), 2) AS test_share FROM c""")
def q_split_sweep(spark, sf):
    return profile.split_sweep(table(spark, sf, "events"), "user_id")


HIST_COLS = ['c_acctbal', 'c_nationkey']


@query("histograms", """WITH d AS (SELECT * FROM customer WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
  AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND c_mktsegment IS NOT NULL)
SELECT 'c_acctbal' AS "column", bucket, round(lo + bucket * w, 6) + 0.0 AS lower,
  round(lo + (bucket + 1) * w, 6) + 0.0 AS upper, count(*) AS count FROM (
  SELECT CAST(least(floor((CAST(c_acctbal AS DOUBLE) - s.lo) / s.w), 19) AS INTEGER) AS bucket, s.lo, s.w
  FROM d, (SELECT min(CAST(c_acctbal AS DOUBLE)) AS lo, (max(CAST(c_acctbal AS DOUBLE)) - min(CAST(c_acctbal AS DOUBLE))) / 20 AS w FROM d) s)
  GROUP BY bucket, lo, w UNION ALL SELECT 'c_nationkey' AS "column", bucket, round(lo + bucket * w, 6) + 0.0 AS lower,
  round(lo + (bucket + 1) * w, 6) + 0.0 AS upper, count(*) AS count FROM (
  SELECT CAST(least(floor((CAST(c_nationkey AS DOUBLE) - s.lo) / s.w), 19) AS INTEGER) AS bucket, s.lo, s.w
  FROM d, (SELECT min(CAST(c_nationkey AS DOUBLE)) AS lo, (max(CAST(c_nationkey AS DOUBLE)) - min(CAST(c_nationkey AS DOUBLE))) / 20 AS w FROM d) s)
  GROUP BY bucket, lo, w""")
def q_histograms(spark, sf):
    cust = clean.drop_incomplete(table(spark, sf, "customer"))
    h = profile.histograms(cust, HIST_COLS, 20)
    return h.withColumns({"lower": round6("lower"), "upper": round6("upper")})


@query("threshold_split", """WITH c AS (SELECT floor(min(user_id) + 0.8 * (max(user_id) - min(user_id))) AS cut FROM events)
SELECT event_id, user_id, CASE WHEN user_id <= cut THEN 'train' ELSE 'test' END AS split
FROM events, c WHERE user_id IS NOT NULL""")
def q_threshold_split(spark, sf):
    """Split at 80% of the id range, derived from the data."""
    ev = table(spark, sf, "events")
    lo, hi = ev.agg(F.min("user_id"), F.max("user_id")).collect()[0]  # one row
    train, test = clean.split_at(ev, "user_id", int(lo + 0.8 * (hi - lo)))
    return (train.select("event_id", "user_id", F.lit("train").alias("split"))
            .unionByName(test.select("event_id", "user_id", F.lit("test").alias("split"))))


# --- joins ----------------------------------------------------------------------

@query("match_audit", """SELECT
  (SELECT count(*) FROM events) AS left_rows,
  (SELECT count(*) FROM customer) AS right_rows,
  (SELECT count(*) FROM events e JOIN customer c ON e.user_id = c.c_custkey) AS inner_rows,
  (SELECT count(*) FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)) AS left_only,
  (SELECT count(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)) AS right_only""")
def q_match_audit(spark, sf):
    return match.audit(table(spark, sf, "events"), table(spark, sf, "customer"), "user_id", "c_custkey")


@query("full_outer_rows", """SELECT l.user_id, l.n_events, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) l
FULL OUTER JOIN customer c ON l.user_id = c.c_custkey""")
def q_full_outer_rows(spark, sf):
    left = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    cust = table(spark, sf, "customer")
    j = match.full_outer(left, cust, "user_id", "c_custkey")
    return j.select("user_id", "n_events", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


ANCHORS, HALF_WINDOW_S = 5, 6 * 3600


@query("range_extract", f"""WITH a AS (SELECT event_id AS anchor_event_id, user_id AS au, ts AS ats
    FROM events ORDER BY value DESC, event_id LIMIT {ANCHORS})
SELECT a.anchor_event_id, e.event_id, e.user_id, e.ts, e.value FROM events e JOIN a
  ON e.user_id = a.au AND e.ts >= a.ats - INTERVAL {HALF_WINDOW_S} SECOND
  AND e.ts <= a.ats + INTERVAL {HALF_WINDOW_S} SECOND""")
def q_range_extract(spark, sf):
    ev = table(spark, sf, "events")
    a = ev.orderBy(F.col("value").desc(), F.col("event_id")).limit(ANCHORS).select("event_id", "user_id", "ts")
    r = sampling.ranges(ev, a, "user_id", "ts", 2 * HALF_WINDOW_S)
    return r.select("anchor_event_id", "event_id", "user_id", "ts", "value")


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return sampling.anchors(table(spark, sf, "events"), 5, seed=42, key="event_id")


# --- runs, windows, features -------------------------------------------------------

RUNS_SQL = """WITH i AS (SELECT *, coalesce(CAST(event_type <> lag(event_type)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT), 0) AS ind FROM events)"""


@query("event_runs", f"""{RUNS_SQL}
SELECT event_id, user_id, event_type, CAST(sum(ind) OVER (PARTITION BY user_id ORDER BY ts, event_id
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i""")
def q_event_runs(spark, sf):
    r = events.separate(table(spark, sf, "events"), B1_LABEL, "run", B1_BY, B1_ORDER, unique_order=True)
    return r.select("event_id", "user_id", "event_type", "run")


@query("event_runs_chunked", ORACLE["event_runs"])
def q_event_runs_chunked(spark, sf):
    """event_runs through the hot-entity path: one-day chunks per user."""
    r = events.separate(table(spark, sf, "events"), B1_LABEL, "run", B1_BY, B1_ORDER, chunk_width="day",
                        unique_order=True)
    return r.select("event_id", "user_id", "event_type", "run")


B2_RUNS_SQL = """i AS (SELECT *, coalesce(CAST(l_linestatus <> lag(l_linestatus) OVER (PARTITION BY l_suppkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS BIGINT), 0) AS ind FROM lineitem)"""


@query("event_runs_ties", f"""WITH {B2_RUNS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus,
  CAST(sum(ind) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i""")
def q_event_runs_ties(spark, sf):
    r = events.separate(table(spark, sf, "lineitem"), B2_LABEL, "run", B2_BY, B2_ORDER,
                        run_order=["l_shipdate"], unique_order=True)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "run")


B2_ROWS_RUNS = f"""{B2_RUNS_SQL},
r AS (SELECT *, CAST(sum(ind) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i)"""


@query("longest_run", f"""WITH {B2_ROWS_RUNS},
n AS (SELECT l_linestatus, l_suppkey, run, count(*) AS n_rows FROM r GROUP BY l_linestatus, l_suppkey, run),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus
    ORDER BY n_rows DESC, l_suppkey, run) AS rn FROM n) WHERE rn = 1)
SELECT r.l_linestatus, r.l_suppkey, r.run, best.n_rows, r.l_orderkey, r.l_linenumber, r.l_partkey
FROM r JOIN best ON r.l_linestatus = best.l_linestatus AND r.l_suppkey = best.l_suppkey AND r.run = best.run""")
def q_longest_run(spark, sf):
    li = table(spark, sf, "lineitem")
    r = events.separate(li, B2_LABEL, "run", B2_BY, B2_ORDER, unique_order=True)
    best = profile.longest_run(r, B2_BY, "run", B2_LABEL, order=B2_ORDER, rows=li)
    return best.select("l_linestatus", "l_suppkey", "run", "n_rows", "l_orderkey", "l_linenumber", "l_partkey")


TOP_CAP = 20.0


@query("top_entity_runs", f"""WITH top AS (SELECT user_id FROM events WHERE event_type IS NOT NULL GROUP BY user_id
    ORDER BY count(DISTINCT event_type) DESC, count(*) DESC, user_id LIMIT 1),
u AS (SELECT e.event_id, e.ts, e.user_id, e.event_type,
    CASE WHEN e.value > {TOP_CAP} THEN {TOP_CAP} WHEN e.value < -{TOP_CAP} THEN -{TOP_CAP} ELSE e.value END AS value
    FROM events e JOIN top ON e.user_id = top.user_id WHERE e.event_type IS NOT NULL),
i AS (SELECT *, coalesce(CAST(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    AS BIGINT), 0) AS ind FROM u),
r AS (SELECT *, CAST(sum(ind) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i),
n AS (SELECT event_type, user_id, run, count(*) AS n_rows FROM r GROUP BY event_type, user_id, run),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n_rows DESC, user_id, run)
    AS rn FROM n) WHERE rn = 1)
SELECT r.event_type, r.user_id, r.run, best.n_rows, r.event_id, r.value
FROM r JOIN best ON r.event_type = best.event_type AND r.user_id = best.user_id AND r.run = best.run""")
def q_top_entity_runs(spark, sf):
    """The exploratory flow: user with most actions and rows → that user's
    labeled rows, clipped → runs → longest run per label, with its rows."""
    ev = table(spark, sf, "events")
    # one row (k = 1): computed once, then a local relation every branch reuses
    top = materialize_small(profile.top_entity(ev, "user_id", "event_type", 1).select("user_id"), 1)
    rows_ = (ev.join(F.broadcast(top), "user_id")
               .filter(F.col("event_type").isNotNull()))
    rows_ = clean.clip(rows_, ["value"], TOP_CAP)
    r = events.separate(rows_, B1_LABEL, "run", B1_BY, B1_ORDER, unique_order=True)
    best = profile.longest_run(r, B1_BY, "run", B1_LABEL, order=B1_ORDER, rows=rows_)
    return best.select("event_type", "user_id", "run", "n_rows", "event_id", "value")


MAVG_P = 3


@query("moving_average", f"""SELECT event_id, user_id,
  round(avg(value) OVER w, 6) + 0.0 AS value, round(avg({K_SQL}) OVER w, 6) + 0.0 AS k
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {MAVG_P} PRECEDING AND CURRENT ROW)""")
def q_moving_average(spark, sf):
    s = features.smooth(b1(spark, sf), ["value", "k"], MAVG_P, B1_BY, B1_ORDER, unique_order=True)
    return s.select("event_id", "user_id", round6("value").alias("value"), round6("k").alias("k"))


LAGS_N = 5


@query("lag_features", "SELECT * FROM (SELECT event_id, user_id, "
       + ", ".join(f"lag(value, {i}) OVER w AS value_{i}" for i in range(1, LAGS_N + 1))
       + " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "
       + f"WHERE value_{LAGS_N} IS NOT NULL")
def q_lag_features(spark, sf):
    x = features.lags(table(spark, sf, "events"), ["value"], LAGS_N, B1_BY, B1_ORDER, unique_order=True)
    x = features.lag_columns(x, "value_lags", "value", LAGS_N)
    return x.select("event_id", "user_id", *[f"value_{i}" for i in range(1, LAGS_N + 1)])


SF_P, SF_N, SF_STEP = 1, 3, 2


def _strided_sql() -> str:
    avg = ", ".join(f"avg({c}) OVER (PARTITION BY l_suppkey, run ORDER BY l_shipdate, l_orderkey, "
                    f"l_linenumber, l_partkey ROWS BETWEEN {SF_P} PRECEDING AND CURRENT ROW) AS {c}"
                    for c in B2_AXES)
    lagc = ", ".join(f"lag({c}, {i}) OVER w AS {c}_{i}" for c in B2_AXES for i in range(1, SF_N + 1))
    outc = ", ".join([f"round({c}, 6) + 0.0 AS {c}" for c in B2_AXES]
                     + [f"round({c}_{i}, 6) + 0.0 AS {c}_{i}" for c in B2_AXES for i in range(1, SF_N + 1)])
    notnull = " AND ".join(f"{c}_{SF_N} IS NOT NULL" for c in B2_AXES)
    return f"""WITH {B2_ROWS_RUNS},
s AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate, run, {avg} FROM r),
g AS (SELECT *, {lagc} FROM s WINDOW w AS (PARTITION BY l_suppkey, run
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)),
k AS (SELECT *, rank() OVER (PARTITION BY l_suppkey, run ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)
    AS rnk FROM g WHERE {notnull})
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, run, CAST(rnk AS INTEGER) AS rank, {outc}
FROM k WHERE rnk % {SF_STEP} = 0"""


@query("strided_features", _strided_sql())
def q_strided_features(spark, sf):
    x = features.event_features(table(spark, sf, "lineitem"), B2_AXES, B2_BY, B2_ORDER, B2_LABEL,
                                period=SF_P, n=SF_N, step=SF_STEP, event_col="run", unique_order=True)
    for c in B2_AXES:
        x = features.lag_columns(x, f"{c}_lags", c, SF_N)
    lag_names = [f"{c}_{i}" for c in B2_AXES for i in range(1, SF_N + 1)]
    return x.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "run", "rank",
                    *[round6(c).alias(c) for c in B2_AXES + lag_names])


@query("strided_features_chunked", ORACLE["strided_features"])
def q_strided_features_chunked(spark, sf):
    """strided_features through the hot-entity path: 30-day chunks and
    64-row blocks, so run ids, averages and lags cross chunk and block
    borders (with halo copies)."""
    x = features.event_features(table(spark, sf, "lineitem"), B2_AXES, B2_BY, B2_ORDER, B2_LABEL,
                                period=SF_P, n=SF_N, step=SF_STEP, event_col="run",
                                chunk_width=30 * 86_400, block_rows=64, unique_order=True)
    for c in B2_AXES:
        x = features.lag_columns(x, f"{c}_lags", c, SF_N)
    lag_names = [f"{c}_{i}" for c in B2_AXES for i in range(1, SF_N + 1)]
    return x.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "run", "rank",
                    *[round6(c).alias(c) for c in B2_AXES + lag_names])


@query("class_weights", """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, round(CAST((SELECT max(n) FROM c) AS DOUBLE) / c.n, 6) + 0.0 AS weight
FROM events e JOIN c ON e.event_type = c.event_type""")
def q_class_weights(spark, sf):
    w = balance.class_weights(table(spark, sf, "events"), "event_type", "weight")
    return w.select("event_id", "event_type", round6("weight").alias("weight"))


@query("label_index", """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
r AS (SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS label FROM c)
SELECT e.event_id, e.event_type, r.label FROM events e JOIN r ON e.event_type = r.event_type""")
def q_label_index(spark, sf):
    from pyspark.ml.feature import StringIndexer
    ev = table(spark, sf, "events")
    m = StringIndexer(inputCol="event_type", outputCol="label", handleInvalid="keep").fit(ev)
    return m.transform(ev).select("event_id", "event_type", "label")


# --- model stages ---------------------------------------------------------------------

MM_COLS = ["q", "p", "d"]


def b2_scaled_axes(spark, sf) -> DataFrame:
    """B2 axes brought to comparable magnitudes (quantity, price / 1000,
    discount * 100)."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("l_quantity").alias("q"), (F.col("l_extendedprice") / 1000).alias("p"),
                     (F.col("l_discount") * 100).alias("d"))


B2_SCALED_SQL = """a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q,
    l_extendedprice / 1000 AS p, l_discount * 100 AS d FROM lineitem)"""


@query("minmax_scale", f"""WITH {B2_SCALED_SQL},
m AS (SELECT min(q) AS q0, max(q) AS q1, min(p) AS p0, max(p) AS p1, min(d) AS d0, max(d) AS d1 FROM a)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(CASE WHEN q1 = q0 THEN 0.5 ELSE (q - q0) / (q1 - q0) END, 6) + 0.0 AS q,
  round(CASE WHEN p1 = p0 THEN 0.5 ELSE (p - p0) / (p1 - p0) END, 6) + 0.0 AS p,
  round(CASE WHEN d1 = d0 THEN 0.5 ELSE (d - d0) / (d1 - d0) END, 6) + 0.0 AS d
FROM a, m""")
def q_minmax_scale(spark, sf):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    a = VectorAssembler(inputCols=MM_COLS, outputCol="v").transform(b2_scaled_axes(spark, sf))
    s = MinMaxScaler(inputCol="v", outputCol="s").fit(a).transform(a)
    arr = vector_to_array("s")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    *[round6(arr[i]).alias(c) for i, c in enumerate(MM_COLS)])


@query("covariance_matrix", f"WITH {B2_SCALED_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(covar_samp({a}, {b}), 6) + 0.0 AS cov FROM a"
    for a in MM_COLS for b in MM_COLS))
def q_covariance_matrix(spark, sf):
    x = b2_scaled_axes(spark, sf)
    wide = x.agg(*[F.covar_samp(a, b).alias(f"{a}__{b}") for a in MM_COLS for b in MM_COLS])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), round6(f"{a}__{b}").alias("cov"))
        for a in MM_COLS for b in MM_COLS])).alias("c")).select("c.*")


@query("pca_features")
def q_pca_features(spark, sf):
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    emb = table(spark, sf, "embeddings").select("vec_id", array_to_vector(
        F.col("embedding").cast("array<double>")).alias("v"))
    m = PCA(k=3, inputCol="v", outputCol="pc").fit(emb)
    # component signs are arbitrary: report magnitudes
    return m.transform(emb).select("vec_id", *[F.abs(vector_to_array("pc")[i]).alias(f"pc_{i + 1}")
                                               for i in range(3)])


@query("confusion_metrics", """WITH c AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction,
    count(*) AS n FROM labels GROUP BY 1, 2),
a AS (SELECT label AS class, sum(n) AS actual FROM c GROUP BY 1),
p AS (SELECT prediction AS class, sum(n) AS predicted FROM c GROUP BY 1),
t AS (SELECT label AS class, n AS tp FROM c WHERE label = prediction)
SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS class,
  round(coalesce(sum(CASE WHEN label = prediction THEN n END) / sum(n), 0), 6) + 0.0 AS value FROM c
UNION ALL
SELECT 'precision', a.class, round(CASE WHEN coalesce(p.predicted, 0) > 0 THEN coalesce(t.tp, 0) / p.predicted
  ELSE 0 END, 6) + 0.0 FROM a LEFT JOIN p ON a.class = p.class LEFT JOIN t ON a.class = t.class
UNION ALL
SELECT 'recall', a.class, round(coalesce(t.tp, 0) / a.actual, 6) + 0.0
FROM a LEFT JOIN t ON a.class = t.class""")
def q_confusion_metrics(spark, sf):
    m = evaluate.metrics(table(spark, sf, "labels"), "quality", "toxic")
    return m.withColumn("value", round6("value"))


# --- sources, sinks, streams --------------------------------------------------------------

@query("json_roundtrip", f"""SELECT event_id, user_id, event_type, value, {K_SQL} AS k FROM events""")
def q_json_roundtrip(spark, sf):
    x = b1(spark, sf).select("event_id", json_encode("user_id", "event_type", "value", "k").alias("msg"))
    dec = json_decode("msg", "user_id long, event_type string, value double, k int")
    return x.select("event_id", dec.alias("c")).select("event_id", "c.*")


@query("partitioned_roundtrip", "SELECT * FROM events")
def q_partitioned_roundtrip(spark, sf):
    from ..sinks.writers import write_partitioned
    from ..sources.readers import read_partitioned
    ev = table(spark, sf, "events")
    path = scratch_path(spark, "partitioned")
    write_partitioned(ev, path, ["event_type"], order=["user_id", "ts"])
    back = read_partitioned(spark, path, schema=ev.schema)
    return back.select(*ev.columns)


CSV_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


@query("csv_roundtrip", f"SELECT {', '.join(CSV_COLS)} FROM lineitem")
def q_csv_roundtrip(spark, sf):
    from ..sources.readers import read_typed_csv
    li = table(spark, sf, "lineitem")
    schema = li.select(*CSV_COLS).schema
    path = scratch_path(spark, "csv")
    # last field carries a trailing ';' like the raw sensor files
    (li.select(*CSV_COLS[:-1], F.concat(F.col(CSV_COLS[-1]).cast("string"), F.lit(";")).alias(CSV_COLS[-1]))
       .write.mode("overwrite").csv(path))
    return read_typed_csv(spark, path, schema, strip={CSV_COLS[-1]: ";"})


def _b2_model_params():
    from .model import ModelParams
    return ModelParams(cap=200_000.0, features_size=3, moving_avg_period=1, step=2, pca_components=3,
                       num_trees=5, max_depth=4, entity=B2_BY, order=B2_ORDER, action=B2_LABEL,
                       axes=B2_AXES, unique_order=True)


def b2_split(li: DataFrame) -> int:
    """Train/test supplier threshold at 80% of the id range (79 at sf0.01),
    derived from the data as the workflow's split point is."""
    lo, hi = li.agg(F.min("l_suppkey"), F.max("l_suppkey")).collect()[0]  # one row
    return int(lo + 0.8 * (hi - lo))


@query("forest_predictions")
def q_forest_predictions(spark, sf):
    from . import model as mdl
    li = table(spark, sf, "lineitem")
    p = _b2_model_params()
    m = mdl.fit(li, p)
    return mdl.score(m, li).select(*B2_BY, *B2_ORDER, "prediction", "predicted_action")


@query("evaluate_model")
def q_evaluate_model(spark, sf):
    from . import model as mdl
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    m = mdl.fit(train, _b2_model_params())
    return mdl.evaluate(m, test)


STREAM_COLS = ["event_id", "user_id", "event_type", "value", "props"]


@query("stream_decode", f"SELECT {', '.join(STREAM_COLS)} FROM events")
def q_stream_decode(spark, sf):
    from .. import streaming
    from ..sources.readers import read_stream_dir
    ev = table(spark, sf, "events").select(*STREAM_COLS)
    src, msgs, out = (scratch_path(spark, n) for n in ("stream-src", "stream-msg", "stream-out"))
    ev.write.parquet(src)
    q = streaming.publish(read_stream_dir(spark, src, ev.schema, max_files_per_trigger=1),
                          checkpoint=f"{msgs}-ckpt", fmt="parquet", key_col="event_id",
                          trigger=streaming.trigger_kwargs(available_now=True), path=msgs)
    q.awaitTermination()
    raw = spark.readStream.schema("key string, value string").parquet(msgs)
    q2 = (streaming.decode(raw, ev.schema).writeStream.format("parquet")
          .option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start(out))
    q2.awaitTermination()
    return spark.read.schema(ev.schema).parquet(out)


@query("stream_score")
def q_stream_score(spark, sf):
    from .. import streaming
    from ..sources.readers import read_stream_dir
    from . import model as mdl
    p = _b2_model_params()
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    m = mdl.fit(train, p)
    src, out = scratch_path(spark, "score-src"), scratch_path(spark, "score-out")
    test.repartition("l_suppkey").write.parquet(src)
    q = streaming.score(read_stream_dir(spark, src, li.schema, max_files_per_trigger=1), m, out,
                        checkpoint=f"{out}-ckpt", trigger=streaming.trigger_kwargs(available_now=True),
                        columns=(*B2_BY, *B2_ORDER))
    q.awaitTermination()
    types = ", ".join(f"{c} {li.schema[c].dataType.simpleString()}" for c in (*B2_BY, *B2_ORDER))
    return spark.read.schema(f"{types}, predicted_action string").option("header", True).csv(f"{out}/pred_batch_*")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Runs per user → per-run moving average → one lag → stride → rows and
    mean smoothed value per event type."""
    x = features.event_features(table(spark, sf, "events"), ["value"], B1_BY, B1_ORDER, B1_LABEL,
                                period=1, n=1, step=1, unique_order=True)
    return x.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                       round6(F.avg("value")).alias("avg_value"))
