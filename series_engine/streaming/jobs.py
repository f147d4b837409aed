"""Structured Streaming jobs: publish rows as JSON messages, decode them, and
score micro-batches with a fitted model.

Row-based windows are refused on streaming DataFrames, so scoring runs in
``foreachBatch`` where each micro-batch is a static DataFrame: windows
restart with every batch (the first ``windowSize`` rows of each entity in a
batch yield no prediction).  Every query has its own checkpoint location;
per-batch output folders are overwritten, so a replayed batch (after a
failure) leaves the same files."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.columns import json_decode, json_encode
from ..sinks.writers import write_batch_csv


def trigger_kwargs(processing_time: str | None = "5 minutes", available_now: bool = False) -> dict:
    """Keyword arguments for ``DataStreamWriter.trigger``."""
    if available_now:
        return {"availableNow": True}
    return {"processingTime": processing_time}


def kafka_sink_options(bootstrap_servers: str, topic: str, **extra) -> dict:
    """Sink options for ``publish(..., fmt="kafka")``: one topic."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def encode(stream: DataFrame, key_col: str = "timestamp") -> DataFrame:
    """Message columns: ``key`` = key column as text, ``value`` = JSON of the
    whole row (NULL fields omitted)."""
    return stream.select(F.col(key_col).cast("string").alias("key"), json_encode().alias("value"))


def publish(stream: DataFrame, checkpoint: str, fmt: str = "kafka", options: dict | None = None,
            key_col: str = "timestamp", trigger: dict | None = None,
            path: str | None = None) -> StreamingQuery:
    """Encode and write a stream to a message sink (``kafka`` with a
    ``topic`` option, or any file format for tests)."""
    w = (encode(stream, key_col).writeStream.format(fmt).options(**(options or {}))
         .option("checkpointLocation", checkpoint).trigger(**(trigger or trigger_kwargs())))
    return w.start(path) if path else w.start()


def decode(raw: DataFrame, schema: StructType = schemas.REALTIME, value_col: str = "value") -> DataFrame:
    """Message value bytes/text → typed columns; unparsable fields are NULL."""
    return raw.select(json_decode(F.col(value_col).cast("string"), schema).alias("content")).select("content.*")


def score(stream: DataFrame, model, out: str, checkpoint: str, trigger: dict | None = None,
          columns=("userId", "timestamp"),
          predicted: str = "predicted_action") -> StreamingQuery:
    """Score each micro-batch with ``model`` and write one CSV folder per batch
    (``pred_batch_<id>``: entity, time, predicted label).  A batch is fetched
    and decoded once and kept until it is written: scoring looks at it twice
    (entity sizes, then rows)."""
    from ..plans import model as mdl

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            pred = mdl.score(model, batch, out=predicted)
            write_batch_csv(pred.select(*columns, predicted), out, batch_id)
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or trigger_kwargs())).start())
