"""Files by bytes whatever the skew; updates that leave other folders alone."""

import pytest
from pyspark.sql import functions as F

from series_engine.sinks import writers
from series_engine.sinks.writers import write_sized
from tests.conftest import rows


def table(spark, n=60_000):
    """One folder holds two thirds, some hold a handful, one is NULL."""
    k = F.col("id")
    folder = F.when(k % 3 != 0, F.lit("hot")).when(k % 9 == 0, F.lit("mid")).when(k % 30 == 3, F.lit(None)).otherwise(F.concat(F.lit("s"), k % 7))
    return spark.range(n).select("id", folder.alias("f"), (k % 11).alias("t"), F.md5(k.cast("string")).alias("x"))


def files(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("order", [None, ["t"]])
def test_sizes_follow_the_target(spark, tmp_path, order):
    df, path, target = table(spark), tmp_path / "out", 120_000
    write_sized(df, str(path), "f", order=order, target_bytes=target)
    back = spark.read.schema(df.schema).parquet(str(path))
    assert rows(back, ["id", "f", "t", "x"]) == rows(df, ["id", "f", "t", "x"])
    hot = [s for p, s in files(path).items() if "f=hot" in str(p)]
    assert len(hot) > 5 and all(target / 2.2 < s < 2 * target for s in hot)
    for folder in path.glob("f=*"):
        sizes = [s for s in files(folder).values()]
        assert len(sizes) == 1 or min(sizes) > target / 2.2
    if order:  # files of a folder hold ranges of the order
        ranges = sorted(tuple(r) for r in back.where("f = 'hot'").groupBy(F.input_file_name().alias("p")).agg(
            F.min("t").alias("a"), F.max("t").alias("b")).select("a", "b").collect())
        assert all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))


def test_update_of_one_folder_leaves_the_others(spark, tmp_path):
    df, path = table(spark, 6000), tmp_path / "out"
    write_sized(df, str(path), "f", target_bytes=50_000)
    before = files(path)
    for _ in range(2):  # a rerun replaces what it wrote
        write_sized(df.where("f = 'mid'").withColumn("x", F.lit("new")), str(path), "f", target_bytes=50_000)
    after = files(path)
    kept = {p: s for p, s in before.items() if "f=mid" not in str(p)}
    assert kept.items() <= after.items() and not any(p in after for p in before if "f=mid" in str(p))
    back = spark.read.schema(df.schema).parquet(str(path))
    assert back.count() == 6000 and back.where("x = 'new'").count() == df.where("f = 'mid'").count()
    write_sized(df.limit(0), str(path), "f")
    assert spark.read.schema(df.schema).parquet(str(path)).count() == 6000


def test_size_sample_is_drawn_in_parallel(spark, monkeypatch, tmp_path):
    """The task that writes the sample reads the sample, not the table."""
    monkeypatch.setattr(writers, "SIZED_SAMPLE_ROWS", 100)
    spark.range(0, 8000, 1, 8).withColumn("x", F.md5(F.col("id").cast("string"))).write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        from pyspark import TaskContext
        read.add(1 if TaskContext.get().partitionId() else 0)
        yield from batches

    df = spark.read.parquet(str(tmp_path / "t"))
    own = df.mapInArrow(seen, df.schema)
    assert df.rdd.getNumPartitions() > 1
    size = writers._bytes_per_row(own, 8000)
    assert read.value >= df.rdd.getNumPartitions() - 1 and 20 < size < 200
