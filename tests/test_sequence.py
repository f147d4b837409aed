"""The chunked / blocked series machinery must equal plain per-entity windows
for every chunk width and block size (brute force on real fixtures)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from series_engine.operators import events, features, sequence
from tests.conftest import SF001, rows

B1_BY = ["user_id"]
B1_ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def ev(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


@pytest.fixture(scope="module")
def li(spark):
    return spark.read.parquet(f"{SF001}/lineitem.parquet")


def plain_runs(df, label, by, order, run_order=None):
    w = Window.partitionBy(*by).orderBy(*order)
    wr = Window.partitionBy(*by).orderBy(*(run_order or order)).rangeBetween(
        Window.unboundedPreceding, 0)
    return (df.withColumn("ind", F.coalesce((F.col(label) != F.lag(label).over(w)).cast("long"), F.lit(0)))
              .withColumn("event", F.sum("ind").over(wr).cast("long")).drop("ind"))


@pytest.mark.parametrize("width", [0, 3600, 6 * 3600, 86400 * 3])
def test_positions_match_row_number(spark, ev, width):
    got = sequence.index(ev, B1_BY, B1_ORDER, chunk_width=width)
    w = Window.partitionBy(*B1_BY).orderBy(*B1_ORDER)
    exp = ev.withColumn(sequence.POS, F.row_number().over(w) - 1)
    assert rows(got.select("event_id", sequence.POS)) == rows(exp.select("event_id", sequence.POS))


@pytest.mark.parametrize("width", [0, 3600, 86400 * 2])
def test_event_ids_and_starts(spark, ev, width):
    # coarse labels make long runs that cross chunk borders
    df = ev.withColumn("lab", (F.col("value") > 30).cast("string"))
    got = sequence.index(df, B1_BY, B1_ORDER, label="lab", chunk_width=width)
    exp = plain_runs(df, "lab", B1_BY, B1_ORDER)
    w = Window.partitionBy("user_id", "event").orderBy(*B1_ORDER)
    wu = Window.partitionBy(*B1_BY).orderBy(*B1_ORDER)
    exp = (exp.withColumn("pos", F.row_number().over(wu) - 1)
              .withColumn(sequence.ESTART, F.min("pos").over(Window.partitionBy("user_id", "event"))))
    assert rows(got.select("event_id", "event", sequence.ESTART)) == \
        rows(exp.select("event_id", "event", sequence.ESTART))


@pytest.mark.parametrize("width", [0, 86400 * 7, 86400 * 60])
def test_range_runs_with_peers(spark, li, width):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    got = events.separate(li, "l_linestatus", "run", ["l_suppkey"], order,
                          run_order=["l_shipdate"], chunk_width=width)
    exp = plain_runs(li, "l_linestatus", ["l_suppkey"], order, ["l_shipdate"]).withColumnRenamed("event", "run")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "run"]
    assert rows(got.select(*key)) == rows(exp.select(*key))


@pytest.mark.parametrize("block", [4, 7, 1 << 20])
def test_smooth_and_lags_blocks(spark, ev, block):
    w = Window.partitionBy(*B1_BY).orderBy(*B1_ORDER)
    got = features.smooth(ev, ["value"], 2, B1_BY, B1_ORDER, chunk_width=3600, block_rows=block)
    exp = ev.withColumn("value", F.avg("value").over(w.rowsBetween(-2, 0)))
    assert rows(got.select("event_id", "value")) == rows(exp.select("event_id", "value"))

    got = features.lags(ev, ["value"], 3, B1_BY, B1_ORDER, chunk_width=3600, block_rows=block)
    exp = (ev.withColumn("value_lags", F.array(*[F.lag("value", i).over(w) for i in (1, 2, 3)]))
             .withColumn("l3", F.lag("value", 3).over(w)).filter(F.col("l3").isNotNull()))
    assert rows(got.select("event_id", "value_lags")) == rows(exp.select("event_id", "value_lags"))


@pytest.mark.parametrize("width,block", [(0, 1 << 20), (86400 * 30, 5), (86400 * 200, 11)])
def test_event_features_chain(spark, li, width, block):
    by, order = ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    cols, p, n, step = ["l_quantity", "l_discount"], 1, 3, 2
    got = features.event_features(li, cols, by, order, "l_linestatus", period=p, n=n, step=step,
                                  chunk_width=width, block_rows=block)
    # brute force: the lag-column form with plain windows
    x = plain_runs(li, "l_linestatus", by, order)
    we = Window.partitionBy(*by, "event").orderBy(*order)
    x = x.withColumns({c: F.avg(c).over(we.rowsBetween(-p, 0)) for c in cols})
    x = x.select("*", *[F.lag(c, i).over(we).alias(f"{c}_{i}") for c in cols for i in range(1, n + 1)])
    x = x.dropna()
    x = x.withColumn("rank", F.rank().over(we)).filter(F.col("rank") % step == 0)
    x = x.withColumns({f"{c}_lags": F.array(*[F.col(f"{c}_{i}") for i in range(1, n + 1)]) for c in cols})
    key = ["l_orderkey", "l_linenumber", "l_partkey", "event", "rank", "l_quantity", "l_discount",
           "l_quantity_lags", "l_discount_lags"]
    assert rows(got.select(*key)) == rows(x.select(*key))


def test_stride_rank_with_ties(spark):
    # G2: ordered by ts only, ties share a rank and leave gaps
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "a", 2), (1, "a", 3)], "u int, a string, ts int")
    got = features.stride(df, 1, ["u"], ["ts"], chunk_width=1)
    assert sorted(r["rank"] for r in got.collect()) == [1, 2, 2, 4]


def test_tied_order_is_deterministic(spark, ev):
    """Order by day only (many ties): the row-hash tie-break makes positions
    and run ids identical for every chunk width and shuffle layout."""
    df = ev.withColumn("day", F.to_date("ts"))
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, width in [("3", 0), ("8", 86400), ("5", 3 * 86400)]:
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            x = sequence.index(df, B1_BY, ["day"], label="event_type", chunk_width=width)
            results.append(rows(x.select("event_id", sequence.POS, "event", sequence.ESTART)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
