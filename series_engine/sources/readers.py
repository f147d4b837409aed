"""Typed readers.  Schemas are fixed (never inferred); text fields are parsed
with ``try_cast`` so one bad value nulls a field instead of failing the job
under ANSI mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .. import schemas
from ..functions.columns import strip_and_cast


def read_typed_csv(spark: SparkSession, path: str, schema: StructType, *,
                   strip: dict | None = None, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """CSV with a fixed schema: every field is read as text, ``strip`` maps a
    column to a substring to remove (e.g. a trailing ``;``), then each field is
    ``try_cast`` to its type.  Blank lines are skipped; extra fields are
    ignored; missing or unparsable fields become NULL."""
    strip = strip or {}
    raw = (spark.read.schema(schemas.as_text(schema))
           .option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
           .csv(path))
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in strip:
            c = strip_and_cast(c, strip[f.name], f.dataType.simpleString())
        elif not isinstance(f.dataType, StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw accelerometer lines ``userId,action,timestamp,x,y,z;`` → typed rows
    (z cleaned of ``;`` and cast to float)."""
    target = StructType([f if f.name != "z" else schemas.REALTIME["z"] for f in schemas.SENSOR_RAW.fields])
    return read_typed_csv(spark, path, target, strip={"z": ";"})


def read_demographic_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.DEMOGRAPHIC)


def read_partitioned(spark: SparkSession, base: str, partitions: int | None = None,
                     schema: StructType | None = None) -> DataFrame:
    """Hive-layout Parquet (partition columns recovered from folder names and
    placed last).  ``partitions`` only ever *reduces* the split count without
    a shuffle (``coalesce``); leave it ``None`` at scale and size splits with
    ``spark.sql.files.maxPartitionBytes``.  A ``schema`` fixes partition
    column types instead of inferring them from folder names."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(base)
    if partitions:
        df = df.coalesce(int(partitions))
    return df


def read_stream_dir(spark: SparkSession, path: str, schema: StructType = schemas.REALTIME,
                    max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                    clean_source: str | None = None, archive: str | None = None) -> DataFrame:
    """Streaming Parquet folder with a fixed schema.

    A backlog is taken in batches of at most so many files or so many bytes (one
    larger file is a batch of its own); the two bounds exclude each other.
    ``clean_source`` says what becomes of files that finished batches have read:
    ``"archive"`` moves them under ``archive``, ``"delete"`` removes them, so
    listing the folder does not grow with the stream's age."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    if (clean_source == "archive") != (archive is not None):
        raise ValueError("an archive folder goes with clean_source='archive', and only with it")
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
    if archive:
        r = r.option("sourceArchiveDir", archive)
    return r.parquet(path)


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  **extra) -> dict:
    """Source options for one subscribed topic."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_stream(spark: SparkSession, fmt: str, options: dict,
                schema: StructType | None = None) -> DataFrame:
    """Any streaming source (``kafka`` needs its connector on the classpath)."""
    r = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load()


def load_model(path: str, expect_label_stage: bool = True):
    """Load a fitted ``PipelineModel``; check it carries a label index stage
    when scoring needs label names."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StringIndexerModel
    model = PipelineModel.load(path)
    if expect_label_stage and not any(isinstance(s, StringIndexerModel) for s in model.stages):
        raise ValueError(f"model at {path} has no label index stage")
    return model
