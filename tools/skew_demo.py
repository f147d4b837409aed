"""Hot-entity demonstration: run numbering and the fused feature chain on a
table where one entity holds a third of all rows, as one window per entity
(chunk_width=0) versus the chunked / blocked path.

    python tools/skew_demo.py [sf_dir] [copies]

The skewed table is derived from ``lineitem`` (``copies`` date-shifted
copies; every third row re-keyed to supplier -1) and written to a scratch
folder under the session's checkpoint folder.  Prints one JSON line with
wall times, the hot entity's share and the largest window group of each plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import functions as F

    from series_engine.operators import events, features, sequence
    from series_engine.session import get_session, scratch_path

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    import tempfile
    evdir = tempfile.mkdtemp(prefix="skew-demo-events-")
    spark = get_session(master="local[8]", shuffle_partitions=32,
                        conf={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                              "spark.eventLog.dir": evdir})
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    parts = [li.withColumn("l_shipdate", F.col("l_shipdate") + F.make_interval(years=F.lit(8 * k)))
               .withColumn("l_orderkey", F.col("l_orderkey") + F.lit(k * 10_000_000)) for k in range(copies)]
    big = parts[0]
    for p in parts[1:]:
        big = big.unionByName(p)
    big = big.withColumn("l_suppkey", F.when(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 3 == 0,
                                             F.lit(-1)).otherwise(F.col("l_suppkey")))
    path = scratch_path(spark, "skewed-lineitem")
    big.write.parquet(path)
    df = spark.read.parquet(path)
    n = df.count()
    hot = df.filter(F.col("l_suppkey") == -1).count()
    by, order = ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    axes = ["l_quantity", "l_extendedprice", "l_discount"]
    width = 30 * 86_400.0

    windows = {}

    def timed(fn, name=None):
        fn().write.format("noop").mode("overwrite").save()  # warm
        t = time.perf_counter()
        w0 = time.time() * 1000
        fn().write.format("noop").mode("overwrite").save()
        if name:
            windows[name] = (w0, time.time() * 1000)
        return round(time.perf_counter() - t, 2)

    out = {"rows": n, "hot_rows": hot, "hot_share": round(hot / n, 3), "chunk_width_s": round(width, 1)}
    out["runs_one_window_per_entity_s"] = timed(lambda: events.separate(
        df, "l_linestatus", "run", by, order, chunk_width=0, unique_order=True), "runs_one")
    out["runs_chunked_s"] = timed(lambda: events.separate(
        df, "l_linestatus", "run", by, order, chunk_width=width, unique_order=True), "runs_chunked")
    out["chain_one_window_per_entity_s"] = timed(lambda: features.event_features(
        df, axes, by, order, "l_linestatus", period=5, n=20, step=20, chunk_width=0, unique_order=True), "chain_one")
    out["chain_chunked_s"] = timed(lambda: features.event_features(
        df, axes, by, order, "l_linestatus", period=5, n=20, step=20, chunk_width=width,
        block_rows=max(hot // 64, 1000), unique_order=True), "chain_chunked")
    # the default path: ranges of equal row count (target scaled to this size)
    sequence.AUTO_CHUNK_ROWS = max(hot // 64, 1000)
    out["chain_auto_s"] = timed(lambda: features.event_features(
        df, axes, by, order, "l_linestatus", period=5, n=20, step=20,
        block_rows=max(hot // 64, 1000), unique_order=True), "chain_auto")
    chunk = sequence.chunk_expr(df, "l_shipdate", width)
    out["largest_group_one_window"] = hot
    out["largest_group_chunked"] = (df.groupBy("l_suppkey", chunk.alias("c")).count()
                                    .agg(F.max("count")).collect()[0][0])
    spark.stop()
    out.update({f"longest_task_{k}_s": v for k, v in _longest_tasks(evdir, windows).items()})
    print(json.dumps(out))


def _longest_tasks(evdir: str, windows: dict) -> dict:
    """Longest task (seconds) that ran inside each timed window, from the
    event log written to a scratch folder."""
    import glob
    import io
    tasks = []
    for f in glob.glob(f"{evdir}/**/events_*", recursive=True) + glob.glob(f"{evdir}/*local*"):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb")
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                i = e["Task Info"]
                tasks.append((i["Launch Time"], i["Finish Time"]))
    return {k: round(max([b - a for a, b in tasks if a >= w0 and b <= w1] or [0]) / 1000, 2)
            for k, (w0, w1) in windows.items()}


if __name__ == "__main__":
    main()
