"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session of this library wants: adaptive execution (runtime
# coalescing, skew-join splitting, broadcast conversion by measured size), UTC
# session time and Arrow transfer for the few pandas paths.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "series_engine",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when ``None``.  The checkpoint
    folder is read from ``spark.checkpoint.dir``; only when the cluster leaves
    it unset (local tests) is a scratch folder chosen.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Only a local
    session (tests) may leave it unset: then a scratch folder is created once
    and recorded in the session conf, so later calls agree.  On a cluster an
    unset value is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master or ""
    if not path:
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors "
                               "(a machine-local folder would not survive a lost executor)")
        path = tempfile.mkdtemp(prefix="series-engine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never reused)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df, name: str):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and return the re-read table.  The plan runs once (a reliable RDD
    checkpoint of an unpersisted DataFrame would compute it twice), and the
    files survive executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Bytes of a batch of rows between Spark and a Python worker.
_BATCH_BYTES = 1 << 20


def short_batches(spark: SparkSession) -> None:
    """Rows go to Python workers and back in batches of about ``_BATCH_BYTES``,
    not of 10,000 rows: a batch of texts is held several times over, outside
    the heap and in the worker.  The setting stays, as lazy results need it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run
    and whatever their working folder is: once per application its sources go
    to the executors as a zip file."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="series-engine-py-"), "series_engine_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("series_engine", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
