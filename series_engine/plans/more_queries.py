"""Queries on awkward values, sinks, and the model path with a checkable model
(registered beside ``queries``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas, streaming
from ..functions.columns import round6
from ..operators import clean, evaluate, events, features, match, profile, sampling
from ..session import scratch_path
from ..sinks import writers
from ..sources import readers
from . import model as mdl
from .queries import (B1_BY, B1_LABEL, B1_ORDER, B2_AXES, B2_BY, B2_LABEL, B2_ORDER, B2_ROWS_RUNS,
                      b2_split, query, table)

# --- runs ---------------------------------------------------------------------------

_E_COLS = "event_id, ts, user_id, event_type"


def _runs_sql(source: str) -> str:
    return f"""WITH e AS ({source}), i AS (SELECT *, coalesce(CAST(event_type <> lag(event_type)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT), 0) AS ind FROM e)
SELECT event_id, user_id, event_type, CAST(sum(ind) OVER (PARTITION BY user_id ORDER BY ts, event_id
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i"""


@query("event_runs_outlier", _runs_sql(f"""SELECT {_E_COLS} FROM events UNION ALL
SELECT -user_id - 1, TIMESTAMP '1970-01-01', user_id, 'start' FROM (SELECT DISTINCT user_id FROM events)"""))
def q_event_runs_outlier(spark, sf):
    """Runs with one stray clock value per user, decades before its other rows."""
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    stray = ev.select("user_id").distinct().select(
        (-F.col("user_id") - 1).alias("event_id"), F.lit("1970-01-01").cast(ev.schema["ts"].dataType).alias("ts"),
        "user_id", F.lit("start").alias("event_type"))
    r = events.separate(ev.unionByName(stray), B1_LABEL, "run", B1_BY, B1_ORDER, unique_order=True)
    return r.select("event_id", "user_id", "event_type", "run")


@query("event_runs_null_keys", _runs_sql("""SELECT event_id, ts, CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id,
  nullif(event_type, 'view') AS event_type FROM events"""))
def q_event_runs_null_keys(spark, sf):
    """Runs where NULL is an entity and a label, cut into day chunks."""
    ev = table(spark, sf, "events").select(
        "event_id", "ts", F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"))
    r = events.separate(ev, B1_LABEL, "run", B1_BY, B1_ORDER, chunk_width="day", unique_order=True)
    return r.select("event_id", "user_id", "event_type", "run")


_MOMENT = """m AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-06-01' ELSE ts END AS ts, event_type FROM events)"""


def _moment(spark, sf):
    """A third of all rows at one moment of one user."""
    ev = table(spark, sf, "events")
    third = F.col("event_id") % 3 == 0
    return ev.select("event_id", F.when(third, F.lit(1).cast(ev.schema["user_id"].dataType)).otherwise(F.col("user_id")).alias("user_id"),
                     F.when(third, F.lit("2024-06-01").cast(ev.schema["ts"].dataType)).otherwise(F.col("ts")).alias("ts"), "event_type")


@query("event_runs_moment", f"""WITH {_MOMENT}, i AS (SELECT *, coalesce(CAST(event_type <> lag(event_type)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT), 0) AS ind FROM m)
SELECT event_id, user_id, event_type, CAST(sum(ind) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i""")
def q_event_runs_moment(spark, sf):
    """Runs over a RANGE frame where one moment of one user holds a third of all
    rows: chunks of 500 rows part it."""
    r = events.separate(_moment(spark, sf), B1_LABEL, "run", B1_BY, B1_ORDER, run_order=["ts"], chunk_width="rows:500", unique_order=True)
    return r.select("event_id", "user_id", "event_type", "run")


@query("stride_moment", f"""WITH {_MOMENT}, r AS (SELECT event_id, user_id,
  CAST(rank() OVER (PARTITION BY user_id ORDER BY ts) AS INTEGER) AS rank FROM m) SELECT * FROM r WHERE rank % 4 = 0""")
def q_stride_moment(spark, sf):
    """Every fourth rank, peers sharing one, over the same rows."""
    return features.stride(_moment(spark, sf), 4, B1_BY, ["ts"], chunk_width="rows:500").select("event_id", "user_id", "rank")


_B2N = """n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag,
  CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey END AS l_suppkey, nullif(l_linestatus, 'O') AS l_linestatus FROM lineitem)"""


@query("longest_run_nulls", f"""WITH {_B2N},
i AS (SELECT *, coalesce(CAST(l_linestatus <> lag(l_linestatus) OVER w AS BIGINT), 0) AS ind FROM n
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)),
r AS (SELECT *, CAST(sum(ind) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM i),
g AS (SELECT l_linestatus, l_suppkey, run, count(*) AS n_rows FROM r GROUP BY ALL)
SELECT l_linestatus, l_suppkey, run, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus
  ORDER BY n_rows DESC, l_suppkey NULLS FIRST, run) AS rn FROM g) WHERE rn = 1""")
def q_longest_run_nulls(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("l_suppkey"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("l_linestatus"))
    r = events.separate(li, B2_LABEL, "run", B2_BY, B2_ORDER, unique_order=True)
    best = profile.longest_run(r, B2_BY, "run", B2_LABEL, order=B2_ORDER)
    return best.select("l_linestatus", "l_suppkey", "run", "n_rows")


# --- ranges and joins ------------------------------------------------------------------

DATE_ANCHORS, DATE_DAYS = 20, 5


@query("range_extract_dates", f"""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_shipdate AS DATE) AS day, l_extendedprice FROM lineitem),
a AS (SELECT * FROM d ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT {DATE_ANCHORS})
SELECT a.l_orderkey AS anchor_l_orderkey, d.l_orderkey, d.l_linenumber, d.l_partkey, d.l_suppkey, d.day
FROM d JOIN a ON d.l_suppkey = a.l_suppkey AND d.day BETWEEN a.day - {DATE_DAYS // 2} AND a.day + {DATE_DAYS // 2}""")
def q_range_extract_dates(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            F.col("l_shipdate").cast("date").alias("day"), "l_extendedprice")
    a = d.orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(DATE_ANCHORS)
    r = sampling.ranges(d, a.select("l_orderkey", "l_suppkey", "day"), "l_suppkey", "day", DATE_DAYS * 86_400)
    return r.select("anchor_l_orderkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "day")


MANY_SECONDS = 3600


@query("range_extract_many", f"""WITH m AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id FROM events)
SELECT a.event_id AS anchor_event_id, m.event_id, m.user_id FROM m JOIN m a ON m.user_id = a.user_id
  AND m.ts BETWEEN a.ts - INTERVAL {MANY_SECONDS // 2} SECOND AND a.ts + INTERVAL {MANY_SECONDS // 2} SECOND WHERE a.event_id % 2 = 0""")
def q_range_extract_many(spark, sf):
    """Every second row an anchor, beyond the broadcast bound, a third of all rows
    at one user."""
    ev = table(spark, sf, "events")
    m = ev.select("event_id", "ts", F.when(F.col("event_id") % 3 == 0, F.lit(1).cast(ev.schema["user_id"].dataType))
                  .otherwise(F.col("user_id")).alias("user_id"))
    r = sampling.ranges(m, m.where("event_id % 2 = 0"), "user_id", "ts", MANY_SECONDS, max_broadcast_rows=1000)
    return r.select("anchor_event_id", "event_id", "user_id")


@query("full_outer_profile", """WITH j AS (SELECT e.event_id, e.user_id, e.event_type, c.c_name, c.c_nationkey, c.c_acctbal
  FROM events e FULL OUTER JOIN customer c ON e.user_id = c.c_custkey)
SELECT count(*) - count(event_id) AS event_id, count(*) - count(user_id) AS user_id,
  count(*) - count(event_type) AS event_type, count(*) - count(c_name) AS c_name,
  count(*) - count(c_nationkey) AS c_nationkey, count(*) - count(c_acctbal) AS c_acctbal FROM j""")
def q_full_outer_profile(spark, sf):
    """Row-level full outer join of all events and customers, read off by a
    NULL profile."""
    j = match.full_outer(table(spark, sf, "events").select("event_id", "user_id", "event_type"),
                         table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
                         "user_id", "c_custkey")
    return profile.null_profile(j)


SAMPLE_N, SAMPLE_SEED = 50, 42


@query("seeded_sample_rows", f"""SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5('{SAMPLE_SEED}|' || event_id), event_id LIMIT {SAMPLE_N}""")
def q_seeded_sample_rows(spark, sf):
    s = sampling.anchors(table(spark, sf, "events"), SAMPLE_N, seed=SAMPLE_SEED, key="event_id")
    return s.select("event_id", "user_id", "event_type", "value")


MANY_N = 3000


@query("seeded_sample_many", f"""SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5('{SAMPLE_SEED}|' || event_id), event_id LIMIT {MANY_N}""")
def q_seeded_sample_many(spark, sf):
    """A sample of more rows than one task may merge: a hash threshold and a filter."""
    s = sampling.anchors(table(spark, sf, "events"), MANY_N, seed=SAMPLE_SEED, key="event_id", merged_rows=100)
    return s.select("event_id", "user_id", "event_type", "value")


# --- features at the training width ------------------------------------------------------

WIDE_N, WIDE_P, WIDE_STEP = 100, 5, 20


def _wide_sql() -> str:
    w = "PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey"
    avg = ", ".join(f"avg({c}) OVER ({w} ROWS BETWEEN {WIDE_P} PRECEDING AND CURRENT ROW) AS {c}" for c in B2_AXES)
    out = ", ".join(
        f"round(lag({c}, 1) OVER ({w}), 6) + 0.0 AS {c}_first, round(lag({c}, {WIDE_N}) OVER ({w}), 6) + 0.0 AS {c}_last, "
        f"round(sum({c}) OVER ({w} ROWS BETWEEN {WIDE_N} PRECEDING AND 1 PRECEDING), 4) + 0.0 AS {c}_sum" for c in B2_AXES)
    return f"""WITH s AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate, {avg} FROM lineitem),
g AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER ({w}) - {WIDE_N} AS rank, {out} FROM s)
SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM g WHERE rank > 0 AND rank % {WIDE_STEP} = 0"""


@query("strided_features_wide", _wide_sql())
def q_strided_features_wide(spark, sf):
    """The feature chain at the training settings (100 lags, 5 + 1 rows per
    average, every 20th row) on one run per supplier."""
    li = table(spark, sf, "lineitem").withColumn("one", F.lit("x"))
    x = features.event_features(li, B2_AXES, B2_BY, B2_ORDER, "one", period=WIDE_P, n=WIDE_N, step=WIDE_STEP, unique_order=True)
    out = []
    for c in B2_AXES:
        lags = F.col(f"{c}_lags")
        total = F.round(F.aggregate(lags, F.lit(0.0), lambda s, v: s + v), 4) + F.lit(0.0)
        out += [round6(lags[0]).alias(f"{c}_first"), round6(lags[WIDE_N - 1]).alias(f"{c}_last"), total.alias(f"{c}_sum")]
    return x.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "rank", *out)


# --- model path: one tree of depth one on one lag, which SQL can follow -------------------

KEYS = ", ".join([*B2_BY, *B2_ORDER])


def _stump_params():
    return mdl.ModelParams(cap=200_000.0, features_size=1, moving_avg_period=0, step=1, pca_components=1, num_trees=1,
                           max_depth=1, bootstrap=False, entity=B2_BY, order=B2_ORDER, action=B2_LABEL, axes=["l_discount"], unique_order=True)


def _stump_sql(train: str, test: str, select: str) -> str:
    """Rows ``p`` (keys, true label, predicted label) of the best weighted
    Gini split of the label on the previous row's discount."""
    return f"""WITH {B2_ROWS_RUNS},
lim AS (SELECT CAST(floor(min(l_suppkey) + 0.8 * (max(l_suppkey) - min(l_suppkey))) AS BIGINT) AS cut FROM lineitem),
g AS (SELECT * FROM (SELECT {KEYS}, l_linestatus AS y, lag(l_discount) OVER (PARTITION BY l_suppkey, run
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS x FROM r) WHERE x IS NOT NULL),
tr AS (SELECT x, y FROM g, lim WHERE {train}),
wt AS (SELECT y, CAST(max(count(*)) OVER () AS DOUBLE) / count(*) AS w FROM tr GROUP BY y),
c AS (SELECT x, y, count(*) * any_value(w) AS s FROM tr JOIN wt USING (y) GROUP BY x, y),
v AS (SELECT DISTINCT x AS t FROM tr WHERE x < (SELECT max(x) FROM tr)),
s AS (SELECT t, y, coalesce(sum(s) FILTER (x <= t), 0) AS l, coalesce(sum(s) FILTER (x > t), 0) AS h FROM v, c GROUP BY t, y),
b AS (SELECT t, sum(l) - sum(l * l) / sum(l) + sum(h) - sum(h * h) / sum(h) AS gini, max_by(y, l) AS yl, max_by(y, h) AS yh
  FROM s GROUP BY t ORDER BY 2, 1 LIMIT 1),
p AS (SELECT {KEYS}, y, CASE WHEN x <= t THEN yl ELSE yh END AS predicted_action FROM g, b, lim WHERE {test})
{select}"""


@query("stump_predictions", _stump_sql("true", "true", f"SELECT {KEYS}, predicted_action FROM p"))
def q_stump_predictions(spark, sf):
    """Whole model path: feature chain, label index, PCA, scaling, class
    weights, tree, label names."""
    li = table(spark, sf, "lineitem")
    return mdl.score(mdl.fit(li, _stump_params()), li).select(*B2_BY, *B2_ORDER, "predicted_action")


_TRAIN, _TEST = "l_suppkey <= cut", "l_suppkey > cut"
_METRICS_SQL = """, k AS (SELECT DISTINCT y FROM p),
m AS (SELECT k.y, count(*) FILTER (p.y = k.y) AS actual, count(*) FILTER (predicted_action = k.y) AS predicted,
  count(*) FILTER (p.y = k.y AND predicted_action = k.y) AS tp FROM k, p GROUP BY k.y),
o AS (SELECT y, CAST(row_number() OVER (ORDER BY n DESC, y) - 1 AS DOUBLE) AS class
  FROM (SELECT l_linestatus AS y, count(*) AS n FROM lineitem, lim WHERE l_suppkey <= cut GROUP BY 1))
SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS class, round(avg(CASE WHEN y = predicted_action THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS value FROM p
UNION ALL SELECT 'precision', class, round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END, 6) + 0.0 FROM m JOIN o USING (y)
UNION ALL SELECT 'recall', class, round(tp / actual, 6) + 0.0 FROM m JOIN o USING (y)"""


@query("stump_metrics", _stump_sql(_TRAIN, _TEST, "").rstrip() + _METRICS_SQL)
def q_stump_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    return mdl.evaluate(mdl.fit(train, _stump_params()), test).withColumn("value", round6("value"))


@query("model_roundtrip", _stump_sql(_TRAIN, _TEST, f"SELECT {KEYS}, predicted_action FROM p"))
def q_model_roundtrip(spark, sf):
    """Predictions of the model that was saved and loaded."""
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    path = scratch_path(spark, "model")
    writers.save_model(mdl.fit(train, _stump_params()), path)
    return mdl.score(readers.load_model(path), test).select(*B2_BY, *B2_ORDER, "predicted_action")


@query("stream_score_rows", _stump_sql(_TRAIN, _TEST, f"SELECT {KEYS}, predicted_action FROM p"))
def q_stream_score_rows(spark, sf):
    """Micro-batch scoring; a supplier's rows lie in one file, so batches give
    what one batch job gives."""
    li = table(spark, sf, "lineitem")
    train, test = clean.split_at(li, "l_suppkey", b2_split(li))
    m = mdl.fit(train, _stump_params())
    src, out = scratch_path(spark, "score-src"), scratch_path(spark, "score-out")
    test.repartition("l_suppkey").write.parquet(src)
    q = streaming.score(readers.read_stream_dir(spark, src, li.schema, max_files_per_trigger=2), m, out,
                        checkpoint=f"{out}-ckpt", trigger=streaming.trigger_kwargs(available_now=True), columns=(*B2_BY, *B2_ORDER))
    q.awaitTermination()
    types = ", ".join(f"{c} {li.schema[c].dataType.simpleString()}" for c in (*B2_BY, *B2_ORDER))
    return spark.read.schema(f"{types}, predicted_action string").option("header", True).csv(f"{out}/pred_batch_*")


@query("pca_two_axes", """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q, l_extendedprice / 1000 AS p FROM lineitem),
c AS (SELECT var_samp(q) AS a, covar_samp(q, p) AS b, var_samp(p) AS d FROM a),
e AS (SELECT *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS l FROM c),
v AS (SELECT b / sqrt(b * b + (l - a) * (l - a)) AS x, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS y FROM e)
SELECT l_orderkey, l_linenumber, l_partkey, round(abs(q * x + p * y), 6) + 0.0 AS pc_1, round(abs(p * x - q * y), 6) + 0.0 AS pc_2 FROM a, v""")
def q_pca_two_axes(spark, sf):
    """PCA of two axes, whose eigenvectors have a closed form."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", array_to_vector(
        F.array(F.col("l_quantity").cast("double"), (F.col("l_extendedprice") / 1000).cast("double"))).alias("v"))
    m = PCA(k=2, inputCol="v", outputCol="pc").fit(a)
    pc = vector_to_array("pc")
    return m.transform(a).select("l_orderkey", "l_linenumber", "l_partkey",
                                 *[round6(F.abs(pc[i])).alias(f"pc_{i + 1}") for i in range(2)])


# --- sinks and sources ---------------------------------------------------------------------

@query("append_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def q_append_roundtrip(spark, sf):
    """The table written in two appends and read back."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "append")
    writers.append_parquet(ev.where("event_id % 2 = 0"), path)
    writers.append_parquet(ev.where("event_id % 2 <> 0"), path)
    return spark.read.schema(ev.schema).parquet(path)


@query("metrics_sink", """WITH c AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels),
k AS (SELECT DISTINCT label AS class FROM c),
m AS (SELECT class, count(*) FILTER (label = class) AS a, count(*) FILTER (prediction = class) AS p,
  count(*) FILTER (label = class AND prediction = class) AS t FROM k, c GROUP BY class),
o AS (SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS class, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS value FROM c
UNION ALL SELECT 'precision', class, CASE WHEN p > 0 THEN t / p ELSE 0 END FROM m UNION ALL SELECT 'recall', class, t / a FROM m)
SELECT run, metric, class, round(value, 6) + 0.0 AS value, 'models/' || run AS model_path
FROM o, (SELECT unnest(['first', 'second']) AS run)""")
def q_metrics_sink(spark, sf):
    """Two runs appended to the metrics table."""
    m = evaluate.metrics(table(spark, sf, "labels"), "quality", "toxic")
    path = scratch_path(spark, "metrics")
    for run in ("first", "second"):
        writers.append_metrics(m, path, run, f"models/{run}")
    return spark.read.parquet(path).select("run", "metric", "class", round6("value").alias("value"), "model_path")


@query("demographic_scan", """SELECT CAST(c_custkey AS INTEGER) AS "userId",
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(CAST(round(c_acctbal, 2) AS FLOAT) AS DOUBLE) END AS height, c_mktsegment AS sex,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS age FROM customer""")
def q_demographic_scan(spark, sf):
    """Demographic text files with fields that do not parse: those are NULL."""
    cu, path = table(spark, sf, "customer"), scratch_path(spark, "demographic")
    bad = lambda k, c: F.when(F.col("c_custkey") % k != 0, c.cast("string")).otherwise(F.lit("?"))
    fields = [f.name for f in schemas.DEMOGRAPHIC.fields]
    made = {"userId": F.col("c_custkey").cast("string"), "height": bad(3, F.round("c_acctbal", 2)), "sex": F.col("c_mktsegment"),
            "age": bad(4, F.col("c_nationkey"))}
    cu.select(*[made.get(f, F.lit("1")).alias(f) for f in fields]).write.csv(path)
    d = readers.read_demographic_csv(spark, path)
    return d.select("userId", F.col("height").cast("double").alias("height"), "sex", "age")
