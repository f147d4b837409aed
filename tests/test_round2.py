"""Awkward values: infinities, NULL entities and labels, dates, NULL axes."""

import math

from pyspark.sql import functions as F

from series_engine.operators import events, features, match, profile, sampling
from tests.conftest import SF001, rows


def test_quantiles_with_infinities_and_null_groups(spark):
    inf = float("inf")
    data = [("a", float(i)) for i in range(20)] + [("a", inf), ("b", inf), ("b", inf), ("b", -inf), ("b", 1.0), (None, 2.0), (None, 4.0)]
    got = {r.g: r for r in profile.exact_quantiles(spark.createDataFrame(data, "g string, v double"), ["g"], "v", [0.0, .25, .5, 1.0]).collect()}
    assert (got["a"].n, got["a"].q0, got["a"].q1, got["a"].q2, got["a"].q3) == (21, 0.0, 5.0, 10.0, inf)
    assert got["b"].q0 == -inf and got["b"].q3 == inf and math.isinf(got["b"].q2)
    assert got[None].q2 == 3.0


def test_quantiles_read_the_source_a_fixed_number_of_times(spark):
    df = spark.range(60_000).select((F.col("id") % 60_000).alias("g"), F.rand(1).alias("v"))
    q = profile.exact_quantiles(df, ["g"], "v", [0.5])
    assert q.count() == 60_000
    assert q._jdf.queryExecution().analyzed().toString().count("Range (") == 0  # lineage is cut


def test_date_ranges_are_whole_days_inside(spark):
    df = spark.range(12).select(F.lit(1).alias("u"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    for width, want in ((86400, [5]), (3 * 86400, [4, 5, 6]), (2 * 86400, [4, 5, 6]), (5 * 86400, [3, 4, 5, 6, 7])):
        for most in (50_000, 0):
            got = sampling.ranges(df, df.where("id = 5"), "u", "d", width, max_broadcast_rows=most)
            assert sorted(r.id for r in got.collect()) == want


def test_longest_run_keeps_null_labels_and_entities(spark):
    data = [(None, i, "x", i) for i in range(3)] + [(1, 10 + i, None, i) for i in range(4)] + [(1, 20, "x", 9)]
    df = spark.createDataFrame(data, "u int, id int, lab string, t int")
    best = profile.longest_run(events.separate(df, "lab", "run", ["u"], ["t"]), ["u"], "run", "lab", order=["t"], rows=df)
    got = {(r.u, r.id) for r in best.collect()}
    assert got == {(None, 0), (None, 1), (None, 2), (1, 10), (1, 11), (1, 12), (1, 13)}


def chain(spark, xs, n, step, **kw):
    df = spark.createDataFrame([(1, t, "a", x) for t, x in enumerate(xs)], "u int, t int, lab string, x double")
    got = features.event_features(df, ["x"], ["u"], ["t"], "lab", period=0, n=n, step=step, **kw)
    return sorted((r.t, r["rank"], tuple(r.x_lags)) for r in got.collect())


def test_stride_counts_the_rows_that_survive(spark):
    xs = [float(i) if i != 3 else None for i in range(14)]
    assert [t for t, *_ in chain(spark, xs, 2, 2)] == [6, 8, 10, 12]
    for step in (2, 5):  # with every row and with arrays at kept rows only
        full = chain(spark, [float(i) for i in range(40)], 3, step)
        assert full == [(t, t - 2, (t - 1.0, t - 2.0, t - 3.0)) for t in range(3, 40) if (t - 2) % step == 0]


def test_sparse_arrays_equal_window_arrays(spark, monkeypatch):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").where("l_suppkey < 8")
    args = dict(cols=["l_quantity", "l_discount"], by=["l_suppkey"], order=["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
                label="l_linestatus", period=2, n=7, step=5, unique_order=True)
    a = features.event_features(li, **args, block_rows=64)
    monkeypatch.setattr(features, "SPARSE_STEP", 10**9)
    b = features.event_features(li, **args, block_rows=64)
    assert a.columns == b.columns and a.count() > 0 and rows(a) == rows(b)


def test_full_outer_equals_spark(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "w")], "rk int, r string")
    for drop in (True, False):
        ref = left.join(right, left.k == right.rk, "full_outer")
        ref = ref.drop("rk") if drop else ref
        got = match.full_outer(left, right, "k", "rk", drop)
        assert got.columns == ref.columns and rows(got) == rows(ref)


def test_stream_stops_restarts_and_replays(spark, tmp_path):
    """A query that is stopped goes on from its checkpoint; a batch that is
    run again leaves the same files."""
    from series_engine import streaming
    from series_engine.sinks import writers
    from series_engine.sources import readers
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "user_id", "value").limit(300)
    src, out, seen = str(tmp_path / "src"), str(tmp_path / "out"), []

    def run():
        def process(batch, batch_id):
            seen.append(batch_id)
            writers.write_batch_csv(batch, out, batch_id)
        q = (readers.read_stream_dir(spark, src, ev.schema, max_files_per_trigger=1).writeStream.foreachBatch(process)
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(**streaming.trigger_kwargs(available_now=True)).start())
        q.awaitTermination()

    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(src)
    run()
    first = list(seen)
    ev.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    run()
    assert len(seen) > len(first) and len(set(seen)) == len(seen)  # nothing is taken twice
    read = lambda: rows(spark.read.schema(ev.schema).option("header", True).csv(f"{out}/pred_batch_*"))
    done = read()
    assert done == rows(ev)
    commits = sorted((tmp_path / "ckpt" / "commits").glob("[0-9]*"))
    commits[-1].rename(tmp_path / "lost-commit")  # as if the driver was lost before the last commit
    for crc in (tmp_path / "ckpt" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.rename(tmp_path / "lost-crc")
    run()
    assert seen[-1] == max(seen) and seen.count(seen[-1]) == 2 and read() == done
