"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import sequence
from ..operators.joins import join_small
from ..session import scratch_path, write_table
from .commits import append_once


def write_partitioned(df: DataFrame, path: str, cols, order=None, num_partitions: int | None = None,
                      mode: str = "overwrite") -> None:
    """Hive-partitioned Parquet by ``cols``.

    Rows are range-partitioned on ``cols`` followed by ``order`` columns, so a
    hot partition value is spread over several tasks (several files in its
    folder) while small values share one task — no task holds a whole hot key
    and the file count stays near the task count.  Without ``order`` the
    partition columns alone are used.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    keys = cols + ([order] if isinstance(order, str) else list(order or []))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *[F.col(k) for k in keys])
       .write.partitionBy(*cols).mode(mode).parquet(path))


#: Rows whose files tell how many bytes a row takes.
SIZED_SAMPLE_ROWS = 100_000


def _bytes_per_row(df: DataFrame, rows: int) -> float:
    """Bytes of a row in Parquet, from a sample of about ``SIZED_SAMPLE_ROWS``."""
    spark = df.sparkSession
    share = min(1.0, SIZED_SAMPLE_ROWS / max(rows, 1))
    path = scratch_path(spark, "sized-sample")
    # one file, so that its dictionaries and footer count once; only the sample meets in a task, not what it is drawn from
    (df if share == 1.0 else df.sample(share, seed=1)).repartition(1).write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(size / max(spark.read.parquet(path).count(), 1), 1.0)


def write_sized(df: DataFrame, path: str, cols, order=None, target_bytes: int = 128 << 20, touched_only: bool = True) -> None:
    """Hive-partitioned Parquet by ``cols`` with files of about ``target_bytes``.

    Rows are counted per folder; a folder of more rows than a file holds is cut
    into equal files (by position in ``order`` if one is given, so that files
    hold ranges of it whatever its ties, else evenly by where rows were read),
    smaller folders share tasks, and every task writes one file per folder: files
    lie between half and once the target, whatever the skew, but for folders that
    are smaller.  ``touched_only`` replaces the folders that ``df`` has rows for
    and leaves the others' files as they are (a rerun replaces what it wrote);
    otherwise the whole of ``path`` is replaced."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    order = [order] if isinstance(order, str) else list(order or [])
    # one row per folder
    per = write_table(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_se_n")), "sized-folders")
    total = per.agg(F.coalesce(F.sum("_se_n"), F.lit(0))).first()[0]
    mode = df.write.partitionBy(*cols).mode("overwrite").option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    if not total:
        mode.parquet(path)
        return
    held = max(1, int(target_bytes / _bytes_per_row(df.drop(*cols), total)))
    files = F.ceil(F.col("_se_n") / held)
    # tasks: one per file of a large folder, small folders by running sum
    large = per.where(F.col("_se_n") > held).withColumn("_se_files", files)
    small = per.where(F.col("_se_n") <= held).withColumn("_se_files", F.lit(1).cast("long"))
    before = Window.orderBy(F.desc("_se_n"), *cols).rowsBetween(Window.unboundedPreceding, -1)
    large = large.withColumn("_se_task", F.coalesce(F.sum("_se_files").over(before), F.lit(0)))
    first = large.agg(F.coalesce(F.sum("_se_files"), F.lit(0))).first()[0]
    small = small.withColumn("_se_task", F.lit(first) + F.floor(F.coalesce(F.sum("_se_n").over(before), F.lit(0)) / held))
    plan = write_table(large.unionByName(small), "sized-plan")
    tasks = plan.agg(F.max(F.col("_se_task") + F.col("_se_files"))).first()[0]
    if order:
        rows = sequence.index(df, cols, order).withColumnRenamed(sequence.POS, "_se_p").drop(sequence.PEER)
    else:
        rows = df.withColumn("_se_p", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40)))
    side = plan.select(*[F.col(c).alias(f"_se_c_{c}") for c in cols], "_se_n", "_se_files", "_se_task")
    same = lambda big, s: [big[c].eqNullSafe(s[f"_se_c_{c}"]) for c in cols]
    rows = join_small(rows, side, same)
    # position p of n goes to file p * files // n (evenly dealt numbers: of 2^40)
    at = F.col("_se_p") * F.col("_se_files") / (F.col("_se_n") if order else F.lit(1 << 40))
    dealt = rows.withColumn("_se_to", (F.col("_se_task") + F.floor(at)).cast("int")).repartitionById(int(tasks), F.col("_se_to"))
    dealt = dealt.sortWithinPartitions(*cols, *(["_se_p"] if order else [])).select(*df.columns)
    (dealt.write.partitionBy(*cols).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if touched_only else "static").parquet(path))


#: Bytes of a row group in the files of a stream: tasks share a file by its row groups.
TURN_GROUP_BYTES = 8 << 20


def write_in_turn(df: DataFrame, path: str, turn: Column, order, target_bytes: int = 128 << 20) -> int:
    """Parquet files for a file stream to take one after the other: a file for each
    value of ``turn`` (a whole number; rows where it is NULL are left out), smallest
    first, or several, cut by ``order``, where its rows take more than about
    ``target_bytes``.  Rows equal in ``turn`` and ``order`` share a file.  A stream takes the
    oldest file first, so files that tasks wrote side by side are stamped a second
    apart.  A batch of one large file is read by many tasks: its row groups are small
    (``TURN_GROUP_BYTES``).  Returns the number of files."""
    spark = df.sparkSession
    order = [order] if isinstance(order, str) else list(order)
    rows = df.withColumn("_se_turn", turn.cast("long")).where("_se_turn IS NOT NULL")
    n = rows.count()
    held = max(1, int(target_bytes / _bytes_per_row(rows.drop("_se_turn"), n)))
    staged = scratch_path(spark, "in-turn")
    rows.repartitionByRange(max(1, -(-n // held)), "_se_turn", *order).write.partitionBy("_se_turn").option(
        "parquet.block.size", TURN_GROUP_BYTES).parquet(staged)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = []  # one entry per file
    for folder in fs.listStatus(at(staged)):
        name = folder.getPath().getName()
        if name.startswith("_se_turn="):
            made += [(int(name.split("=")[1]), f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder.getPath())
                     if f.getPath().getName().startswith("part-")]
    made.sort(key=lambda f: f[:2])
    fs.mkdirs(at(path))
    now = jvm.java.lang.System.currentTimeMillis()
    for i, (_, _, file) in enumerate(made):
        fs.setTimes(file, now - 1000 * (len(made) - i), -1)
        if not fs.rename(file, at(f"{path.rstrip('/')}/{i:06d}.parquet")):
            raise OSError(f"could not put file {i} into {path}")
    return len(made)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_batch_csv(df: DataFrame, base: str, batch_id: int, prefix: str = "pred_batch_") -> str:
    """One CSV folder (with header) per micro-batch, overwritten on replay so
    a retried batch leaves the same output."""
    out = f"{base.rstrip('/')}/{prefix}{batch_id}"
    df.write.option("header", True).mode("overwrite").csv(out)
    return out


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def _metric_rows(metrics: DataFrame, run: str, model_path: str | None) -> DataFrame:
    return metrics.select(F.lit(run).alias("run"), "metric", "class", "value",
                          F.lit(model_path).cast("string").alias("model_path"),
                          F.current_timestamp().alias("logged_at"))


def append_metrics(metrics: DataFrame, path: str, run: str, model_path: str | None = None) -> None:
    """Append a (run, metric, class, value, model_path, logged_at) table."""
    _metric_rows(metrics, run, model_path).write.mode("append").parquet(path)


def append_metrics_once(metrics: DataFrame, path: str, run: str, model_path: str | None = None) -> bool:
    """As ``append_metrics`` under a commit log: a run that is retried counts once
    (read with ``CommitLog(spark, path).read("metrics")``)."""
    return append_once(_metric_rows(metrics, run, model_path), path, run, kind="metrics")
