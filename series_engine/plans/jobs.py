"""End-to-end jobs of the activity workflow, as plain functions (scheduling
is left to whatever runs them).

prepare  raw labeled CSV → typed rows → split by entity threshold →
         hive-partitioned Parquet (train and test folders)
train    partitioned train folder → fitted model → saved model
evaluate partitioned test folder + saved model → metrics table (appended)
sample   unlabeled rows → seeded anchors → rows around each anchor →
         appended to the stream input folder
produce  stream input folder → JSON messages → message sink
consume  message source → decoded rows → per-batch predictions (CSV)
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .. import schemas, streaming
from ..operators import clean, sampling
from ..sinks import commits, writers
from ..sources import readers
from . import model as mdl

# Fixed values of the workflow: id threshold of the train/test split, number
# of anchors per sampling run and the time range around each (ms).
SPLIT_THRESHOLD = 1607
SAMPLES = 5
RANGE_MS = 60_000


def prepare(spark: SparkSession, raw_path: str, out_base: str, threshold=SPLIT_THRESHOLD,
            entity: str = "userId", partition_cols=("userId", "action"), order: str = "timestamp",
            num_partitions: int | None = None) -> tuple[str, str]:
    """Typed load of the raw file, split at ``threshold`` on ``entity`` (NULL
    ids in neither), each side written hive-partitioned."""
    rows = readers.read_sensor_csv(spark, raw_path)
    train, test = clean.split_at(rows, entity, threshold)
    paths = (f"{out_base.rstrip('/')}/training", f"{out_base.rstrip('/')}/testing")
    for df, path in zip((train, test), paths):
        writers.write_partitioned(df, path, list(partition_cols), order=[order],
                                  num_partitions=num_partitions)
    return paths


def train(spark: SparkSession, train_base: str, model_path: str, params: mdl.ModelParams | None = None,
          partitions: int | None = None, schema=None):
    """Fit the model on the partitioned train folder and save it."""
    p = params or mdl.ModelParams(**mdl.TRAINING_PARAMS)
    df = readers.read_partitioned(spark, train_base, partitions, schema)
    m = mdl.fit(df, p)
    writers.save_model(m, model_path)
    return m


def evaluate(spark: SparkSession, test_base: str, model_path: str, metrics_path: str | None = None,
             run: str | None = None, partitions: int | None = None, schema=None, once: bool = False) -> DataFrame:
    """Metrics of the saved model on the partitioned test folder; appended to
    ``metrics_path`` under ``run`` (default: a UTC timestamp) when given.
    ``once=True`` keeps a commit log there: a retried run counts once."""
    m = readers.load_model(model_path)
    df = readers.read_partitioned(spark, test_base, partitions, schema)
    metrics = mdl.evaluate(m, df)
    if metrics_path:
        run = run or datetime.now(timezone.utc).strftime("run %Y-%m-%d %H:%M:%S")
        append = writers.append_metrics_once if once else writers.append_metrics
        append(metrics, metrics_path, run, model_path)
    return metrics


def sample(rows: DataFrame, out_path: str | None = None, n: int = SAMPLES, seed: int = 0,
           entity: str = "userId", time: str = "timestamp", width=RANGE_MS,
           key=None, run: str | None = None) -> DataFrame:
    """``n`` seeded anchors, then every row of the same entity within
    ±width/2 of each anchor (overlaps repeat rows); appended to ``out_path``
    when given.  With a ``run`` id the rows are published once however often
    the run is retried, and a stream over ``sinks.stream_path(out_path)`` sees
    whole runs only."""
    key = key or [entity, time]
    a = sampling.anchors(rows, n, seed=seed, key=key).select(entity, time)
    picked = sampling.ranges(rows, a, entity, time, width).select(*rows.columns)
    if out_path and run is not None:
        commits.publish_once(picked, out_path, run)
    elif out_path:
        writers.append_parquet(picked, out_path)
    return picked


def produce(spark: SparkSession, in_path: str, checkpoint: str, fmt: str = "kafka",
            options: dict | None = None, trigger: dict | None = None, path: str | None = None,
            schema=schemas.REALTIME, key_col: str = "timestamp"):
    """Stream the input folder out as JSON messages."""
    src = readers.read_stream_dir(spark, in_path, schema)
    return streaming.publish(src, checkpoint, fmt=fmt, options=options, key_col=key_col,
                             trigger=trigger, path=path)


def consume(spark: SparkSession, model_path: str, out_path: str, checkpoint: str,
            fmt: str = "kafka", options: dict | None = None, trigger: dict | None = None,
            schema=schemas.REALTIME,
            columns=("userId", "timestamp"), source_schema=None, across_batches: bool = False):
    """Decode messages and score every micro-batch with the saved model.
    ``across_batches=True`` carries the series from batch to batch and commits
    every batch once (``checkpoint`` then lies under ``out_path``; read the
    predictions with ``streaming.read_rows(spark, out_path, "predictions")``)."""
    m = readers.load_model(model_path)
    raw = readers.read_stream(spark, fmt, options or {}, source_schema)
    if across_batches:
        return streaming.score_stream(streaming.decode(raw, schema), m, out_path, trigger=trigger, columns=columns)
    return streaming.score(streaming.decode(raw, schema), m, out_path, checkpoint, trigger=trigger,
                           columns=columns)
