"""Profiles of appended tables: exact fields exact, sketches within their bound."""

from pyspark.sql import functions as F

from series_engine.operators import profile_state as ps


def test_merged_profile(spark, tmp_path):
    df = spark.range(50_000).select(
        "id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 11 == 0, float("nan")).otherwise(F.sqrt("id")).alias("v"),
        (F.col("id") % 3).cast("string").alias("lab"), F.array("id").alias("a"), F.timestamp_seconds("id").alias("at"))
    base = str(tmp_path / "p")
    log = ps.ProfileLog(spark, base, labels=["lab"])
    for i in range(4):
        part = df.where(F.col("id") % 4 == i)
        assert log.add(part, i) and not log.add(part, i)
        if i == 2:
            log.compact()
    assert log.add(df.limit(0), "empty")
    state = log.state()
    assert set(state.inputFiles()) and all("/states/" in f for f in state.inputFiles())  # rows are not read again
    got = {r.column: r for r in ps.report(state, (0.1, 0.5, 0.9)).collect()}
    exact = df.agg(F.sum(F.col("v").isNull().cast("long")), F.sum(F.isnan("v").cast("long"))).first()
    v = got["v"]
    assert (v.n_rows, v.n_null, v.n_nan) == (50_000, exact[0], exact[1])
    known = df.where("v IS NOT NULL AND NOT isnan(v)")
    assert (v.low, v.high) == tuple(known.agg(F.min("v"), F.max("v")).first())
    n = known.count()
    for p, q in zip((0.1, 0.5, 0.9), v.quantiles):
        assert abs(known.where(F.col("v") <= q).count() / n - p) < 0.02
    assert abs(got["id"].n_distinct - 50_000) < 0.05 * 50_000 and got["lab"].n_distinct == 3
    assert got["a"].n_rows == 50_000 and got["a"].n_distinct is None and got["a"].quantiles is None
    assert got["at"].low_text == "1970-01-01 00:00:00" and got["at"].low is None
    assert [tuple(r) for r in ps.label_counts(state).collect()] == [("lab", "0", 16667), ("lab", "1", 16667), ("lab", "2", 16666)]


def test_empty_table(spark):
    r = ps.report(ps.merge(ps.column_state(spark.createDataFrame([], "x double, s string")))).collect()
    assert {(x.column, x.n_rows, x.n_null, x.quantiles, x.n_distinct) for x in r} == {("x", 0, 0, None, 0), ("s", 0, 0, None, 0)}
