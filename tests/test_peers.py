"""Chunk borders inside equal order values: ranks, RANGE sums and run starts stay exact."""

import random

import pytest
from pyspark.sql import functions as F

from series_engine.operators import events, features, sequence
from tests.conftest import rows

SCHEMA = "u int, t int, k int, lab string, v double"


def table(spark, seed, n=400, ties=0.5):
    """Half of all rows at one (entity, time); NULL among entities, times, labels; repeated rows."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        u, t = (1, 5) if rnd.random() < ties else (rnd.choice((None, 1, 1, 2)), rnd.choice((None, 1, 4, 5, 6, 9)))
        out.append((u, t, rnd.choice((0, 0, 1, 2)), rnd.choice(("a", "a", "a", "b", None)), float(rnd.randint(0, 3))))
    return spark.createDataFrame(out + out[:20], SCHEMA)


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(sequence, "AUTO_CHUNK_ROWS", 12)


def both(spark, monkeypatch, df, make, cols):
    """The same with chunks of a few rows and with one window per entity."""
    got = rows(make(None), cols)
    assert got == rows(make(0), cols)
    return got


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("run_order", [None, ["t"]])
def test_positions_runs_and_starts(spark, monkeypatch, small_chunks, seed, run_order):
    df = table(spark, seed, ties=(0.1, 0.5, 0.9, 1.0)[seed])
    make = lambda width: sequence.index(df, ["u"], ["t", "k"], label="lab", run_order=run_order, chunk_width=width)
    assert make(None).select("u").count() == df.count()
    both(spark, monkeypatch, df, make, ["u", "t", "k", "lab", "v", sequence.POS, sequence.PEER, "event", sequence.ESTART])


def test_ranks_without_a_label(spark, monkeypatch, small_chunks):
    df = table(spark, 11)
    make = lambda width: features.stride(df, 3, ["u"], ["t"], chunk_width=width)
    both(spark, monkeypatch, df, make, ["u", "t", "rank"])


def test_small_chunks_share_tasks(spark):
    """Chunks of a few rows are cut inside a range, so their number is not that of the tasks."""
    df = spark.range(5000).select(F.lit(1).alias("u"), (F.col("id") % 40).alias("t"), "id")
    dealt = sequence.ranged(df, ["u"], ["t", "id"], 10)
    per = dealt.groupBy("_se_chunk").agg(F.count("*").alias("n"), F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b"))
    per = per.orderBy("_se_chunk").collect()
    assert sum(r.n for r in per) == 5000 and max(r.n for r in per) <= 10
    assert all(x.b < y.a for x, y in zip(per, per[1:]))
    assert len(dealt.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_one_moment_fills_many_chunks(spark, small_chunks):
    """No chunk holds more than about the target, though all rows are peers, or equal."""
    df = spark.range(600).select(F.lit(1).alias("u"), F.lit(7).alias("t"), (F.col("id") % 2).cast("string").alias("lab"))
    dealt = sequence.ranged(df.withColumn("_se_tb", sequence.row_tiebreak(df)), ["u"], ["t", "_se_tb"])
    per = [r.n for r in dealt.groupBy("_se_chunk").agg(F.count("*").alias("n")).collect()]
    assert sum(per) == 600 and max(per) <= 36
    runs = events.separate(df, "lab", by=["u"], order=["t"])
    assert [tuple(r) for r in runs.groupBy("event").count().collect()] == [(1, 600)]
