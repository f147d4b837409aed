"""Property test: for random series (NULL entities and labels, tied and NULL
order values) and random chunk widths / block sizes, the chunked and
blocked operators equal plain per-entity windows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from series_engine.operators import events, features, sequence
from tests.conftest import rows

ROW = st.tuples(st.sampled_from([None, 0, 1, 2]),                      # entity
                st.one_of(st.none(), st.integers(0, 30)),              # order value (ties, NULL)
                st.sampled_from([None, "a", "b", "c"]),                # label
                st.floats(-50, 50, allow_nan=False, width=32))         # measurement

SCHEMA = "u int, t int, lab string, x double, id int"


def _plain(df, n, p):
    w = Window.partitionBy("u").orderBy("t", "id")
    x = (df.withColumn("ind", F.coalesce((F.col("lab") != F.lag("lab").over(w)).cast("long"), F.lit(0)))
           .withColumn("event", F.sum("ind").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    we = Window.partitionBy("u", "event").orderBy("t", "id")
    x = x.withColumn("x", F.avg("x").over(we.rowsBetween(-p, 0)))
    x = x.withColumn("x_lags", F.array(*[F.lag("x", i).over(we) for i in range(1, n + 1)]))
    x = x.withColumn("ln", F.lag("x", n).over(we)).filter(F.col("ln").isNotNull())
    return x.withColumn("rank", F.rank().over(we))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(ROW, min_size=1, max_size=40), width=st.sampled_from([0, 1, 3, 7, 50]),
       block=st.integers(1, 9), n=st.integers(1, 3), p=st.integers(0, 2), step=st.integers(1, 3))
def test_chain_equals_plain_windows(spark, data, width, block, n, p, step):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], SCHEMA)
    got = features.event_features(df, ["x"], ["u"], ["t", "id"], "lab", period=p, n=n, step=step,
                                  chunk_width=width, block_rows=block)
    exp = _plain(df, n, p).filter(F.col("rank") % step == 0)
    cols = ["id", "event", "rank", "x", "x_lags"]
    assert rows(got.select(*cols)) == rows(exp.select(*cols))

    runs = events.separate(df, "lab", "event", ["u"], ["t", "id"], run_order=["t"], chunk_width=width)
    w = Window.partitionBy("u").orderBy("t", "id")
    wr = Window.partitionBy("u").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    ref = (df.withColumn("ind", F.coalesce((F.col("lab") != F.lag("lab").over(w)).cast("long"), F.lit(0)))
             .withColumn("event", F.sum("ind").over(wr)))
    assert rows(runs.select("id", "event")) == rows(ref.select("id", "event"))

    pos = sequence.index(df, ["u"], ["t", "id"], chunk_width=width)
    ref = df.withColumn(sequence.POS, F.row_number().over(w) - 1)
    assert rows(pos.select("id", sequence.POS)) == rows(ref.select("id", sequence.POS))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(st.sampled_from(["g1", "g2"]),
                                  st.one_of(st.integers(-3, 3).map(float),
                                            st.floats(-1e6, 1e6, allow_nan=False, width=32))),
                       min_size=1, max_size=60),
       chunks=st.integers(2, 5), sort_rows=st.integers(1, 6),
       probs=st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_equal_percentile(spark, values, chunks, sort_rows, probs):
    import math

    from series_engine.operators import profile
    df = spark.createDataFrame(values, "g string, v double")
    got = profile.exact_quantiles(df, ["g"], "v", probs)
    ref = df.groupBy("g").agg(F.percentile("v", [float(p) for p in probs]).alias("q"),
                              F.count(F.lit(1)).alias("n"))
    g = {r.g: r for r in got.collect()}
    for r in ref.collect():
        assert g[r.g].n == r.n
        for i, q in enumerate(r.q):
            assert math.isclose(g[r.g][f"q{i}"], q, rel_tol=1e-9, abs_tol=1e-9)
