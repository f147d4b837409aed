"""The workflow jobs end to end on a sensor-format CSV made from ``events``."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from series_engine import schemas
from series_engine.plans import jobs
from series_engine.plans import model as mdl
from series_engine.sources import readers
from tests.conftest import SF0001


def _sensor_csv(spark, path, unlabeled=False):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    action = F.lit(schemas.UNLABELED) if unlabeled else F.col("event_type")
    (ev.select(F.col("user_id").cast("int").alias("userId"), action.alias("action"),
               F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
               F.col("value").cast("float").alias("x"),
               F.get_json_object("props", "$.k").cast("float").alias("y"),
               F.concat((F.col("value") / 2).cast("float").cast("string"), F.lit(";")).alias("z"))
       .coalesce(2).write.mode("overwrite").csv(path))


def test_workflow(spark):
    base = tempfile.mkdtemp(prefix="se-jobs-")
    raw, unl = f"{base}/raw", f"{base}/unlabeled"
    _sensor_csv(spark, raw)
    _sensor_csv(spark, unl, unlabeled=True)
    parsed = readers.read_sensor_csv(spark, raw)
    assert parsed.schema == schemas.REALTIME and parsed.filter(F.col("z").isNull()).count() == 0

    train_p, test_p = jobs.prepare(spark, raw, f"{base}/partitioned", threshold=11,
                                   partition_cols=("action",), num_partitions=4)
    assert glob.glob(f"{train_p}/action=*")
    n_train = spark.read.parquet(train_p).count()
    n_test = spark.read.parquet(test_p).count()
    assert n_train + n_test == parsed.count()

    params = mdl.ModelParams(features_size=2, moving_avg_period=1, step=1, pca_components=2,
                             num_trees=3, max_depth=3, cap=100.0, chunk_width=86_400_000.0)
    jobs.train(spark, train_p, f"{base}/model", params)
    metrics = jobs.evaluate(spark, test_p, f"{base}/model", f"{base}/metrics", run="r1").collect()
    assert {r.metric for r in metrics} == {"accuracy", "precision", "recall"}
    logged = spark.read.parquet(f"{base}/metrics")
    assert logged.filter(F.col("run") == "r1").count() == len(metrics)

    rows = readers.read_sensor_csv(spark, unl)
    picked = jobs.sample(rows, f"{base}/real_time", n=3, seed=1, width=6 * 3600 * 1000)
    assert picked.count() >= 3

    q = jobs.produce(spark, f"{base}/real_time", f"{base}/ckpt-p", fmt="parquet",
                     trigger={"availableNow": True}, path=f"{base}/messages")
    q.awaitTermination()
    q2 = jobs.consume(spark, f"{base}/model", f"{base}/predictions", f"{base}/ckpt-c", fmt="parquet",
                      options={"path": f"{base}/messages"}, trigger={"availableNow": True},
                      source_schema="key string, value string")
    q2.awaitTermination()
    # the same with runs and batches that count once, and series across batches
    from series_engine.sinks import CommitLog, stream_path
    from series_engine.streaming import read_rows
    for _ in range(2):
        jobs.sample(rows, f"{base}/published", n=3, seed=1, width=6 * 3600 * 1000, run="r1")
        jobs.evaluate(spark, test_p, f"{base}/model", f"{base}/metrics-once", run="r1", once=True)
    assert spark.read.parquet(stream_path(f"{base}/published")).count() == picked.count()
    assert CommitLog(spark, f"{base}/metrics-once").read("metrics").count() == len(metrics)
    q3 = jobs.consume(spark, f"{base}/model", f"{base}/across", "", fmt="parquet", options={"path": f"{base}/messages"},
                      trigger={"availableNow": True}, source_schema="key string, value string", across_batches=True)
    q3.awaitTermination()
    across = read_rows(spark, f"{base}/across", "predictions")
    assert across.columns == ["userId", "timestamp", "predicted_action"]
    outs = glob.glob(f"{base}/predictions/pred_batch_*")
    assert outs
    pred = spark.read.option("header", True).csv(f"{base}/predictions/pred_batch_*")
    assert pred.columns == ["userId", "timestamp", "predicted_action"]
    assert os.path.isdir(f"{base}/ckpt-c")
