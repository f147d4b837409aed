"""A stream cut anywhere into batches gives the rows of one batch job."""

import random

import pytest
from pyspark.sql import functions as F

from series_engine.operators import features
from series_engine.sinks.commits import CommitLog
from series_engine.streaming import state as st
from tests.conftest import rows

SCHEMA = "u int, t long, seq int, lab string, x double, y double"
ARGS = dict(cols=["x", "y"], by=["u"], order=["t"], label="lab", period=2, n=3, step=2)


def series(seed=1, n=250):
    """Entities of very unequal length with runs of labels; one holds a third."""
    rnd = random.Random(seed)
    out, clock = [], {}
    for i in range(n):
        u = 0 if rnd.random() < 0.4 else rnd.choice((1, 2, 3, 4, 5, 6))
        clock[u] = clock.get(u, 0) + rnd.choice((1, 1, 5))
        out.append((u, clock[u], i, "ab"[(clock[u] // 23) % 2] if u != 3 else "c", rnd.random(), float(i % 7)))
    return out


def cuts(data, seed, batches):
    rnd = random.Random(seed)
    at = sorted(rnd.sample(range(len(data) + 1), batches - 1))
    return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])]


def batch_job(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return features.event_features(df, **{**ARGS, **kw}, unique_order=True, complete_axes=True)


@pytest.mark.parametrize("batches,kw", [(6, {"snapshot_every": 3}), (3, {"block_rows": 8, "chunk_width": 20})])
def test_cut_stream_equals_batch_job(spark, tmp_path, batches, kw):
    data, every = series(batches), kw.pop("snapshot_every", 20)
    chain = st.Chain(**ARGS, unique_order=True, **kw)
    state = st.HaloState(spark, str(tmp_path / "s"), chain, every)
    for i, part in enumerate(cuts(data, batches, batches)):
        assert st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)
        assert not st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)  # run again: nothing
    want = batch_job(spark, data, **kw)
    got = st.read_rows(spark, str(tmp_path / "s"))
    assert want.count() > 20 and rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))
    last = state.before(10 ** 6)
    most = last.groupBy("u").agg(F.count("*").alias("k"), F.max("_run_len").alias("r")).collect()
    assert len(most) == 7 and all(m.k == min(m.r, chain.reach) for m in most)
    if every == 3:
        assert len(state._folders(6)) == 1 and len(state._folders(5)) == 3


@pytest.mark.parametrize("point", ["rows", "commit"])
def test_batch_that_dies_half_way_is_run_again(spark, tmp_path, monkeypatch, point):
    data = series(7)
    parts = cuts(data, 3, 3)
    state = st.HaloState(spark, str(tmp_path / "s"), st.Chain(**ARGS, unique_order=True), 2)
    for i, part in enumerate(parts):
        if i == 1:
            def die(*a, **k):
                raise RuntimeError("killed")
            if point == "commit":
                monkeypatch.setattr(CommitLog, "commit", die)
            else:
                real = CommitLog.attempt
                monkeypatch.setattr(CommitLog, "attempt", lambda self, kind, id_, real=real: (
                    str(tmp_path / "no" / "\0bad") if kind == point else real(self, kind, id_)))
            with pytest.raises(Exception):
                st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)
            monkeypatch.undo()
        assert st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)
    want = batch_job(spark, data)
    assert rows(st.read_rows(spark, str(tmp_path / "s")), sorted(want.columns)) == rows(want, sorted(want.columns))


def test_late_and_incomplete_rows(spark, tmp_path):
    data = series(9, 120)
    first, second = data[:60], data[60:]
    stray = [(0, 1, -1, "a", 0.5, 0.5), (99, 1, -2, "a", 0.5, 0.5)]      # entity 0 is past its t = 1; 99 is new
    broken = [(0, 10 ** 6, -3, "a", None, 1.0), (None, 5, -4, "a", 1.0, 1.0), (0, 10 ** 6, -5, "a", float("nan"), 1.0)]
    state = st.HaloState(spark, str(tmp_path / "s"), st.Chain(**ARGS, unique_order=True))
    st.process_batch(spark.createDataFrame(first, SCHEMA), 0, state)
    st.process_batch(spark.createDataFrame(second + stray + broken, SCHEMA), 1, state)
    want = batch_job(spark, data)
    assert rows(st.read_rows(spark, str(tmp_path / "s")), sorted(want.columns)) == rows(want, sorted(want.columns))
    assert [r.seq for r in st.read_rows(spark, str(tmp_path / "s"), "late").collect()] == [-1]
    st.process_batch(spark.createDataFrame([], SCHEMA), 2, state)
    assert [r.seq for r in st.read_rows(spark, str(tmp_path / "s"), "late").collect()] == [-1]
    assert state.before(3).where("u = 99").count() == 1


def test_stream_restarts_after_a_lost_commit(spark, tmp_path):
    """Files cut entities; the query stops in the middle and loses its last note."""
    from series_engine.sources import readers
    from series_engine.streaming import trigger_kwargs
    data = series(5, 300)
    parts, base, src = cuts(data, 2, 4), str(tmp_path / "s"), str(tmp_path / "src")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        q = st.features_stream(readers.read_stream_dir(spark, src, schema, max_files_per_trigger=1), base,
                               st.Chain(**ARGS, unique_order=True), trigger_kwargs(available_now=True), snapshot_every=2)
        q.awaitTermination()

    for half in (parts[:2], parts[2:]):
        for part in half:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        run()
        commits = sorted((tmp_path / "s" / "_checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        commits[-1].rename(tmp_path / f"lost-{commits[-1].name}")
        for crc in (tmp_path / "s" / "_checkpoint" / "commits").glob(f".{commits[-1].name}.crc"):
            crc.rename(tmp_path / f"lost-crc-{commits[-1].name}")
    run()
    want = batch_job(spark, data)
    assert rows(st.read_rows(spark, base), sorted(want.columns)) == rows(want, sorted(want.columns))


def test_compacted_log_gives_the_same_rows(spark, tmp_path):
    """Merged batches keep rows, late rows and state; folders grow with the levels alone."""
    data, base = series(5), str(tmp_path / "s")
    chain = st.Chain(**ARGS, unique_order=True)
    state, merges = st.HaloState(spark, base, chain, 3), 0
    parts = cuts(data, 5, 8)
    for i, part in enumerate(parts):
        late = [r for r in parts[1] if r[0] == 0][:1] if i == 4 else []
        assert st.process_batch(spark.createDataFrame(part + late, SCHEMA), i, state)
        merges += st.compact(spark, base, chain, 2)
        assert not st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)  # a merged batch counts as recorded
    log = CommitLog(spark, base)
    assert merges >= 4 and len(log.records()) <= 4 and log.ids() >= {str(i) for i in range(8)}
    want = batch_job(spark, data)
    assert rows(log.read("rows").select(*want.columns)) == rows(want)
    assert log.read("late").count() == 1
    assert log.sweep("rows") == 0


def test_a_merge_that_dies_has_not_happened(spark, tmp_path, monkeypatch):
    data, base = series(6, 120), str(tmp_path / "s")
    chain = st.Chain(**ARGS, unique_order=True)
    state = st.HaloState(spark, base, chain, 20)
    for i, part in enumerate(cuts(data, 6, 4)):
        st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)

    def die(*a, **k):
        raise RuntimeError("killed")
    want = batch_job(spark, data)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(RuntimeError):
            st.compact(spark, base, chain, 3)
    log = CommitLog(spark, base)
    assert rows(log.read("rows").select(*want.columns)) == rows(want)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_delete", die)  # recorded, its old files not yet removed
        with pytest.raises(RuntimeError):
            st.compact(spark, base, chain, 3)
    assert rows(log.read("rows").select(*want.columns)) == rows(want) and len(log.records()) == 2


def test_backlog_in_batches_of_bytes(spark, tmp_path):
    from series_engine.sources import readers
    src, archive, out = (str(tmp_path / n) for n in ("src", "archive", "out"))
    for i in range(6):
        spark.range(i * 1000, i * 1000 + 1000).coalesce(1).write.mode("append").parquet(src)
    size = max(f.stat().st_size for f in (tmp_path / "src").glob("*.parquet"))
    seen = []
    q = (readers.read_stream_dir(spark, src, "id long", max_bytes_per_trigger=int(2.5 * size), clean_source="archive", archive=archive)
         .writeStream.foreachBatch(lambda df, i: seen.append(df.count())).option("checkpointLocation", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sum(seen) == 6000 and len([n for n in seen if n]) >= 3 and max(seen) <= 2000
    with pytest.raises(ValueError):
        readers.read_stream_dir(spark, src, "id long", max_files_per_trigger=1, max_bytes_per_trigger=1)
    with pytest.raises(ValueError):
        readers.read_stream_dir(spark, src, "id long", clean_source="archive")


def test_files_in_turn_are_bounded_and_in_order(spark, tmp_path):
    """A stretch of many rows is several files of several tasks, taken in order; the
    stream over them gives the rows of one batch job."""
    from series_engine.sinks import writers
    from series_engine.sources import readers
    data = series(5, 1200)
    df, path, base = spark.createDataFrame(data + [(9, None, 0, "a", 1.0, 1.0)], SCHEMA), str(tmp_path / "src"), str(tmp_path / "out")
    n = writers.write_in_turn(df, path, F.floor(F.col("t") / 400), ["t"], target_bytes=4000)
    made = sorted((tmp_path / "src").glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    parts = [spark.read.parquet(str(f)) for f in made]
    spans = [tuple(p.agg(F.min("t"), F.max("t"), F.count("*"), F.min(F.floor(F.col("t") / 400)), F.max(F.floor(F.col("t") / 400))).first()) for p in parts]
    assert len(made) == n > 5 and sum(s[2] for s in spans) == 1200 and max(s[2] for s in spans) < 500
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:])) and all(s[3] == s[4] for s in spans)
    chain = st.Chain(**ARGS, unique_order=True)
    st.features_stream(readers.read_stream_dir(spark, path, df.schema, max_files_per_trigger=1), base, chain,
                       st.trigger_kwargs(available_now=True), snapshot_every=2, compact_fan=2).awaitTermination()
    want, got = batch_job(spark, data), st.read_rows(spark, base)
    assert want.count() > 100 and rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


def test_small_files_in_turn_are_one_each(spark, tmp_path):
    from series_engine.sinks import writers
    df = spark.range(90).withColumn("k", F.col("id") % 3)
    assert writers.write_in_turn(df, str(tmp_path / "a"), F.col("k"), "id") == 3
    assert rows(spark.read.parquet(str(tmp_path / "a"))) == rows(df)
    assert writers.write_in_turn(df.limit(0), str(tmp_path / "b"), F.col("k"), "id") == 0 and (tmp_path / "b").is_dir()


def test_batch_of_short_entities_is_shuffled_by_entity_once(spark, tmp_path):
    """Rows and halos meet in one shuffle, in front of every window of the batch."""
    data, chain = series(4), st.Chain(**ARGS, unique_order=True)
    state = st.HaloState(spark, str(tmp_path / "s"), chain)
    st.process_batch(spark.createDataFrame(data[:120], SCHEMA), 0, state)
    made, halos, late = st._advance_whole(spark.createDataFrame(data[120:], SCHEMA), state.stored(1), chain, 1, True, lambda df: df)
    for df in (made, halos, late):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("unique", [True, False])
def test_short_and_cut_entities_give_the_same(spark, tmp_path, monkeypatch, unique):
    """Rows, halos, snapshots and late rows do not depend on which way a batch goes."""
    from series_engine.operators import sequence
    data = [(u, t // 2 if not unique else t, *rest) for u, t, *rest in series(11, 300)]
    stray = [(0, 1, -1, "a", 0.5, 0.5), (1, 1, -2, "a", 0.5, 0.5), (99, 1, -3, "a", 0.5, 0.5)]
    parts, found = cuts(data, 11, 4), []
    parts[2] = parts[2] + stray
    parts.insert(3, [(2, 1, -4, "b", 0.5, 0.5)])  # an entity with late rows alone
    for way in ("whole", "cut"):
        with monkeypatch.context() as m:
            if way == "cut":
                m.setattr(st, "_fits_whole", lambda batch, c: False)
                m.setattr(sequence, "AUTO_CHUNK_ROWS", 30)
            base = str(tmp_path / way)
            state = st.HaloState(spark, base, st.Chain(**ARGS, unique_order=unique), 3)
            kept = []
            for i, part in enumerate(parts):
                assert st.process_batch(spark.createDataFrame(part, SCHEMA), i, state)
                kept.append(rows(state.before(i + 1)))
            late = st.read_rows(spark, base, "late")
            found.append((rows(st.read_rows(spark, base)), kept, rows(late), st.read_rows(spark, base).columns))
    assert found[0] == found[1] and len(found[0][0]) > 20 and len(found[0][2]) >= 3
    assert state.is_snapshot(2) and len(kept[2]) > 10


def test_full_files_are_not_rewritten_by_a_merge(spark, tmp_path, monkeypatch):
    """A row is written again until its file is full, not once a level."""
    data, base = series(5), str(tmp_path / "s")
    chain = st.Chain(**ARGS, unique_order=True)
    state = st.HaloState(spark, base, chain, 2)
    monkeypatch.setattr(st, "MERGED_BYTES", 1000, raising=False)  # every file is full
    log, parts = CommitLog(spark, base), cuts(data, 5, 5)
    for i, part in enumerate(parts):
        st.process_batch(spark.createDataFrame(part, SCHEMA).coalesce(1), i, state)
        before = set(log.folders("rows"))
        st.compact(spark, base, chain, 2)
        assert before == set(log.folders("rows"))
    assert len(log.records()) <= 3 and log.sweep("rows") == 0 and log.sweep("state") == 0
    want = batch_job(spark, data)
    assert rows(log.read("rows").select(*want.columns)) == rows(want)


def test_files_of_a_stream_can_be_shared_by_tasks(spark, tmp_path, monkeypatch):
    from series_engine.sinks import writers
    monkeypatch.setattr(writers, "TURN_GROUP_BYTES", 100_000, raising=False)
    df = spark.range(200_000).select("id", F.rand(1).alias("x"))
    assert writers.write_in_turn(df, str(tmp_path / "a"), F.lit(0), "id") == 1
    import pyarrow.parquet as pq
    (file,) = (tmp_path / "a").glob("*.parquet")
    assert pq.ParquetFile(str(file)).num_row_groups > 4
