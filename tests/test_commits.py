"""Batches and runs count once, whenever a writer dies."""

import pytest

from series_engine.sinks import commits
from series_engine.sinks.commits import CommitLog, append_once, publish_once
from tests.conftest import rows


def frame(spark, a, b):
    return spark.range(a, b).withColumnRenamed("id", "k")


def test_append_once_and_rerun(spark, tmp_path):
    base = str(tmp_path / "out")
    log = CommitLog(spark, base)
    assert log.read("rows", "k long").count() == 0
    assert append_once(frame(spark, 0, 10), base, "run a/1")
    assert not append_once(frame(spark, 0, 10), base, "run a/1")
    assert append_once(frame(spark, 10, 20), base, "b")
    assert rows(log.read("rows")) == [(i,) for i in range(20)] or sorted(log.read("rows").collect()) == [(i,) for i in range(20)]
    assert log.ids() == {"run a/1", "b"}


def test_killed_between_files_and_record(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    append_once(frame(spark, 0, 5), base, 1)

    def die(*a, **k):
        raise RuntimeError("killed")
    monkeypatch.setattr(CommitLog, "commit", die)
    with pytest.raises(RuntimeError):
        append_once(frame(spark, 5, 9), base, 2)
    log = CommitLog(spark, base)
    assert log.read("rows").count() == 5  # half a batch is never read
    monkeypatch.undo()
    assert append_once(frame(spark, 5, 9), base, 2)
    assert sorted(r.k for r in log.read("rows").collect()) == list(range(9))
    assert log.sweep("rows") == 1 and log.read("rows").count() == 9


def test_first_of_two_writers_counts(spark, tmp_path):
    base = str(tmp_path / "out")
    log = CommitLog(spark, base)
    a, b = log.attempt("rows", 7), log.attempt("rows", 7)
    frame(spark, 0, 3).write.parquet(a)
    frame(spark, 0, 4).write.parquet(b)
    assert log.commit(7, {"rows": b}) and not log.commit(7, {"rows": a})
    assert log.read("rows").count() == 4


def test_publish_shows_whole_runs_to_a_stream(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "in")

    def seen():
        out = str(tmp_path / f"seen-{len(list(tmp_path.iterdir()))}")
        q = (spark.readStream.schema("k long").parquet(commits.stream_path(base)).writeStream.format("parquet")
             .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start(out))
        q.awaitTermination()
        return sorted(r.k for r in spark.read.schema("k long").parquet(out).collect())

    assert publish_once(frame(spark, 0, 4), base, "r1")
    rename = CommitLog._rename

    def die_before(self, *a):
        raise RuntimeError("killed before the files show")
    monkeypatch.setattr(CommitLog, "_rename", die_before)
    with pytest.raises(RuntimeError):
        publish_once(frame(spark, 4, 8), base, "r2")
    assert seen() == list(range(4))

    def die_after(self, source, target):
        done = rename(self, source, target)
        if "/data/" in target:
            raise RuntimeError("killed before the record")
        return done
    monkeypatch.setattr(CommitLog, "_rename", die_after)
    with pytest.raises(RuntimeError):
        publish_once(frame(spark, 4, 8), base, "r2")
    monkeypatch.undo()
    assert publish_once(frame(spark, 4, 8), base, "r2") and not publish_once(frame(spark, 4, 8), base, "r2")
    assert seen() == list(range(8)) and CommitLog(spark, base).ids() == {"r1", "r2"}


def test_compaction_bounds_files_and_keeps_ids(spark, tmp_path):
    base = str(tmp_path / "out")
    log = CommitLog(spark, base)
    for i in range(7):
        append_once(frame(spark, 10 * i, 10 * i + 10).repartition(4), base, i)
        if i in (3, 6):
            assert log.compact("rows", keep=1) == (3 if i == 3 else 4)
    assert sorted(r.k for r in log.read("rows").collect()) == list(range(70))
    assert len(log.records()) == 2 and all(log.committed(i) for i in range(7))
    assert not append_once(frame(spark, 0, 10), base, 0)
    files = list((tmp_path / "out" / "rows").rglob("*.parquet"))
    assert len(files) <= 5
    assert log.sweep("rows") == 0
