"""Golden micro-fixtures (FIXTURES.md §4) and invariants."""

import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from series_engine import schemas
from series_engine.functions import columns as fx
from series_engine.operators import balance, clean, evaluate, events, features, match, profile, sampling
from series_engine.sources import readers
from tests.conftest import SF001, rows

G1 = [(1, "A", 0, 1.0), (1, "A", 50, 2.0), (1, "A", 100, 3.0), (1, "A", 150, 4.0),
      (1, "B", 200, 30.0), (1, "B", 250, -25.0), (1, "A", 300, 7.0),
      (2, "B", 0, 5.0), (2, None, 50, 6.0), (2, "B", 100, float("nan")), (2, "B", 150, 8.0)]


@pytest.fixture(scope="module")
def g1(spark):
    return spark.createDataFrame(G1, "u int, a string, ts long, x float")


def test_g1_steps(spark, g1):
    x = clean.clip(clean.drop_incomplete(g1), ["x"], 20)
    assert x.count() == 9
    assert x.schema["x"].dataType.simpleString() == "float"
    assert sorted(r.x for r in x.collect())[:2] == [-20.0, 1.0]
    ev = events.separate(x, "a", "event", ["u"], ["ts"], chunk_width=100)
    got = {(r.u, r.ts): r.event for r in ev.collect()}
    assert got == {(1, 0): 0, (1, 50): 0, (1, 100): 0, (1, 150): 0, (1, 200): 1, (1, 250): 1,
                   (1, 300): 2, (2, 0): 0, (2, 150): 0}


@pytest.mark.parametrize("width,block", [(0, 1 << 20), (60, 2), (100, 3)])
def test_g1_chain(spark, g1, width, block):
    x = clean.clip(clean.drop_incomplete(g1), ["x"], 20)
    out = features.event_features(x, ["x"], ["u"], ["ts"], "a", period=1, n=2, step=2,
                                  chunk_width=width, block_rows=block).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.u, r.ts, r.event, r["rank"], r.x, r.x_lags) == (1, 150, 0, 2, 3.5, [2.5, 1.5])


def test_g1_averages_and_lags(spark, g1):
    x = clean.clip(clean.drop_incomplete(g1), ["x"], 20)
    x = events.separate(x, "a", "event", ["u"], ["ts"])
    s = features.smooth(x, ["x"], 1, ["u", "event"], ["ts"], chunk_width=50, block_rows=2)
    assert {(r.u, r.ts): r.x for r in s.collect()} == {
        (1, 0): 1.0, (1, 50): 1.5, (1, 100): 2.5, (1, 150): 3.5, (1, 200): 20.0, (1, 250): 0.0,
        (1, 300): 7.0, (2, 0): 5.0, (2, 150): 6.5}
    lg = features.lags(s, ["x"], 1, ["u", "event"], ["ts"], block_rows=2)
    assert {(r.u, r.ts): r.x_lags for r in lg.collect()} == {
        (1, 50): [1.0], (1, 100): [1.5], (1, 150): [2.5], (1, 250): [20.0], (2, 150): [5.0]}


def test_g2_ties_with_tiebreak(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (1, "b", 2, 1), (1, "a", 2, 2), (1, "a", 3, 3)],
                               "u int, a string, ts int, i int")
    ev = events.separate(df, "a", "event", ["u"], ["ts", "i"], run_order=["ts"], chunk_width=1)
    assert [r.event for r in ev.orderBy("i").collect()] == [0, 2, 2, 2]
    ind = events.change_indicator(df, "a", ["u"], ["ts", "i"])
    assert [r.indicator for r in ind.orderBy("i").collect()] == [0, 1, 1, 0]


def test_g3_csv(spark):
    d = tempfile.mkdtemp(prefix="se-csv-")
    with open(os.path.join(d, "raw.txt"), "w") as f:
        f.write("abc,Walking,100,1.0,2.0,2.5;\n1,Jogging,200,xx,2.0,3.0;\n1,Sitting,300,1.0,2.0\n"
                "1,Standing,400,1.0,2.0,;\n\n2,Walking,500,1.0,2.0,4.5;,extra\n")
    df = readers.read_sensor_csv(spark, d)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "string", "bigint", "float",
                                                                      "float", "float"]
    got = {r.timestamp: r for r in df.collect()}
    assert len(got) == 5
    assert got[100].userId is None and got[100].z == 2.5
    assert got[200].x is None
    assert got[300].z is None and got[400].z is None
    assert got[500].z == 4.5 and got[500].userId == 2


def test_g4_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 2.0)], "prediction double, label double")
    m = {(r.metric, r["class"]): r.value for r in evaluate.metrics(df).collect()}
    assert m[("accuracy", None)] == 0.5
    assert math.isclose(m[("precision", 0.0)], 1 / 3) and m[("precision", 1.0)] == 1.0
    assert m[("precision", 2.0)] == 0.0
    assert m[("recall", 0.0)] == 1.0 and m[("recall", 1.0)] == 0.5 and m[("recall", 2.0)] == 0.0


def test_g5_label_index(spark):
    from pyspark.ml.feature import StringIndexer
    fit = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    m = StringIndexer(inputCol="s", outputCol="i", handleInvalid="keep").fit(fit)
    assert m.labels == ["c", "a", "b"]
    new = spark.createDataFrame([("z",), (None,), ("a",)], "s string")
    assert {r.s: r.i for r in m.transform(new).collect()} == {"z": 3.0, None: 3.0, "a": 1.0}


def test_g6_minmax(spark):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(float(i), 5.0) for i in range(1, 10)], "a double, c double")
    v = VectorAssembler(inputCols=["a", "c"], outputCol="v").transform(df)
    m = MinMaxScaler(inputCol="v", outputCol="s").fit(v)
    new = VectorAssembler(inputCols=["a", "c"], outputCol="v").transform(
        spark.createDataFrame([(19.0, 5.0)], "a double, c double"))
    out = m.transform(new).select(vector_to_array("s").alias("s")).collect()[0].s
    assert out == [2.25, 0.5]


def test_g7_json(spark):
    df = spark.createDataFrame([(None, 1, 0.1)], "a string, b int, c double")
    assert df.select(fx.json_encode("a", "b", "c").alias("j")).collect()[0].j == '{"b":1,"c":0.1}'
    bad = spark.createDataFrame([('{"b":1,"c":"bad"}',)], "j string")
    r = bad.select(fx.json_decode("j", "b int, c double").alias("s")).select("s.*").collect()[0]
    assert (r.b, r.c) == (1, None)


def test_g8_stream_batches(spark):
    """One user, two files of 50 rows, one file per trigger, N=10: each batch
    yields 40 rows with full lag windows (windows restart per batch)."""
    base = tempfile.mkdtemp(prefix="se-stream-")
    for k in range(2):
        rows_ = [(1, "No Label", k * 50 + i, float(i), 0.0, 0.0) for i in range(50)]
        spark.createDataFrame(rows_, schemas.REALTIME).coalesce(1).write.mode("append").parquet(f"{base}/src")
    counts = []

    def process(batch, batch_id):
        f = features.event_features(batch, ["x"], ["userId"], ["timestamp"], "action", period=0, n=10, step=1)
        counts.append(f.count())

    q = (readers.read_stream_dir(spark, f"{base}/src", max_files_per_trigger=1).writeStream
         .foreachBatch(process).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert counts == [40, 40]


def test_g9_class_weights(spark):
    empty = spark.createDataFrame([], "label double")
    out = balance.class_weights(empty)
    assert "weight" in out.columns and out.count() == 0
    one = spark.createDataFrame([(1.0,), (1.0,)], "label double")
    assert {r.weight for r in balance.class_weights(one).collect()} == {1.0}
    two = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    assert {(r.label, r.weight) for r in balance.class_weights(two).collect()} == {(0.0, 1.0), (1.0, 3.0)}


# --- invariants on the driver tables -----------------------------------------------------

@pytest.fixture(scope="module")
def li(spark):
    return spark.read.parquet(f"{SF001}/lineitem.parquet")


B2 = dict(by=["l_suppkey"], order=["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])


def test_event_ids_gap_free(spark, li):
    ev = events.separate(li, "l_linestatus", "run", B2["by"], B2["order"], chunk_width=86400 * 30)
    per = ev.groupBy("l_suppkey").agg(F.min("run").alias("lo"), F.max("run").alias("hi"),
                                      F.countDistinct("run").alias("k")).collect()
    assert all(r.lo == 0 and r.hi == r.k - 1 for r in per)


def test_kept_rows_per_run(spark, li):
    n, step = 3, 2
    ev = events.separate(li, "l_linestatus", "run", B2["by"], B2["order"])
    sizes = ev.groupBy("l_suppkey", "run").count().collect()
    expect = sum(max(0, r["count"] - n) // step for r in sizes)
    got = features.event_features(li, ["l_quantity"], B2["by"], B2["order"], "l_linestatus",
                                  period=1, n=n, step=step, block_rows=97).count()
    assert got == expect == 2456


def test_weights_invariant(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    w = balance.weight_table(ev, "event_type").collect()
    assert min(r.weight for r in w) == 1.0 and all(r.weight >= 1.0 for r in w)


def test_split_covers_non_null(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    train, test = clean.split_at(ev, "user_id", 100)
    assert train.count() + test.count() == ev.filter(F.col("user_id").isNotNull()).count()


def test_sweep_equals_per_threshold_counts(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    sweep = profile.split_sweep(ev, "user_id").collect()
    assert len(sweep) >= 10
    for r in sweep[:3]:
        assert r.train_rows == ev.filter(F.col("user_id") <= r.threshold).count()
        assert r.test_rows == ev.filter(F.col("user_id") > r.threshold).count()


def test_range_join_equals_union_of_filters(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    anchors = sampling.anchors(ev, 5, seed=7, key="event_id").collect()
    half = 3 * 3600
    expect = 0
    import datetime as dt
    for a in anchors:
        d = dt.timedelta(seconds=half)
        expect += ev.filter((F.col("user_id") == a.user_id) & (F.col("ts") >= F.lit(a.ts - d))
                            & (F.col("ts") <= F.lit(a.ts + d))).count()
    a_df = spark.createDataFrame(anchors, ev.schema).select("event_id", "user_id", "ts")
    got_b = sampling.ranges(ev, a_df, "user_id", "ts", 2 * half).count()
    got_s = sampling.ranges(ev, a_df, "user_id", "ts", 2 * half, max_broadcast_rows=1).count()
    assert got_b == got_s == expect


def test_match_audit_equals_row_joins(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    cu = spark.read.parquet(f"{SF001}/customer.parquet")
    a = match.audit(ev, cu, "user_id", "c_custkey").collect()[0]
    assert a.inner_rows == ev.join(cu, ev.user_id == cu.c_custkey).count()
    assert (a.left_only, a.right_only) == (0, 1350)
    assert a.left_rows == ev.count() and a.right_rows == cu.count()
    fo = match.full_outer(ev, cu, "user_id", "c_custkey")
    prof = profile.null_profile(fo, ["user_id", "c_name"]).collect()[0]
    assert (prof.user_id, prof.c_name) == (1350, 0)


def test_quartiles_exact_vs_percentile(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    got = profile.quartiles(ev, "event_type", ["value"], exact=True)
    ref = ev.groupBy("event_type").agg(F.percentile("value", [0.25, 0.5, 0.75]).alias("q"))
    g = {r.event_type: (r.q1, r.median, r.q3) for r in got.collect()}
    for r in ref.collect():
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(g[r.event_type], r.q))


def test_exact_quantiles_small_chunks(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_type", "value")
    got = profile.exact_quantiles(ev, ["event_type"], "value", [0.1, 0.5, 0.99])
    ref = ev.groupBy("event_type").agg(F.percentile("value", [0.1, 0.5, 0.99]).alias("q"))
    g = {r.event_type: (r.q0, r.q1, r.q2) for r in got.collect()}
    for r in ref.collect():
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(g[r.event_type], r.q))


def test_histogram_counts_all_rows(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    h = profile.histogram(ev, "value", 20).collect()
    assert sum(r["count"] for r in h) == ev.count()
    assert max(r.bucket for r in h) == 19


def test_demographic_csv(spark):
    d = tempfile.mkdtemp(prefix="se-demo-")
    with open(os.path.join(d, "demo.txt"), "w") as f:
        f.write("1600,170.5,M,30,70.2,0\n1601,xx,F,abc,60.0,1\n")
    df = readers.read_demographic_csv(spark, d)
    assert df.schema == schemas.DEMOGRAPHIC
    got = {r.userId: r for r in df.collect()}
    assert got[1600].height == 170.5 and got[1600].leg_injury == 0
    assert got[1601].height is None and got[1601].age is None and got[1601].sex == "F"


def test_kafka_options():
    o = readers.kafka_options("broker:9092", "topic-a", maxOffsetsPerTrigger=100)
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "topic-a",
                 "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100"}
    from series_engine import streaming
    assert streaming.kafka_sink_options("broker:9092", "topic-a") == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "topic-a"}
    assert streaming.trigger_kwargs() == {"processingTime": "5 minutes"}
    assert streaming.trigger_kwargs(available_now=True) == {"availableNow": True}


def test_histograms_equal_single(spark):
    cu = spark.read.parquet(f"{SF001}/customer.parquet")
    many = profile.histograms(cu, ["c_acctbal", "c_nationkey"], 10)
    for c in ["c_acctbal", "c_nationkey"]:
        one = profile.histogram(cu, c, 10)
        a = rows(many.filter(F.col("column") == c).select("bucket", "lower", "upper", "count"))
        assert a == rows(one.select("bucket", "lower", "upper", "count"))


def test_exact_quantiles_concentrated(spark):
    """Most values in a sliver of the range plus far outliers and heavy
    duplicates: refinement still finds the exact order statistics."""
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    x = ev.select("event_type", F.when(F.col("event_id") % 97 == 0, F.col("value") * 1e9)
                  .when(F.col("event_id") % 5 == 0, F.lit(3.0))
                  .otherwise(F.col("value") / 1e6).alias("v"))
    got = profile.exact_quantiles(x, ["event_type"], "v", [0.0, 0.3, 0.5, 0.97, 1.0])
    ref = x.groupBy("event_type").agg(F.percentile("v", [0.0, 0.3, 0.5, 0.97, 1.0]).alias("q"))
    g = {r.event_type: (r.q0, r.q1, r.q2, r.q3, r.q4) for r in got.collect()}
    for r in ref.collect():
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(g[r.event_type], r.q))


def test_checkpoint_dir_must_be_shared_on_a_cluster():
    from series_engine.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_overview_detail(spark):
    cu = spark.read.parquet(f"{SF001}/customer.parquet")
    r = profile.overview(cu, "customer").collect()[0]
    assert (r.table_name, r.row_count, r.n_columns) == ("customer", 1500, 5)
    assert r.partitions >= 1 and r.schema.startswith("struct<c_custkey:bigint")
    assert profile.overview(cu, "customer", detail=False).columns == ["table_name", "row_count"]
