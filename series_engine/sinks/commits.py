"""Commit log of an output folder: each batch or run counts once, or not at all.

A committed folder looks like this::

    base/_commits/<id>.json          one record per committed id, written last
    base/<kind>/<id>-<attempt>/...   files of one attempt
    base/data/<id>/...               the same for ``publish`` (see there)

Every attempt writes files of its own.  The record names the attempt's folders
and appears in one step (written under another name, then renamed, never over a
record that is there).  Readers take the folders that records name and nothing
else, so files of an attempt that was killed, or that lost a race, are never read
and a rerun of a committed id does nothing.  ``compact`` replaces many records by
one, so neither the files of a folder nor its records grow with the batches.

File operations go through the Hadoop file system of the path, so any store Spark
writes to will do whose rename is one step (HDFS, local, most object-store
committers).
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class CommitLog:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- files ---

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _rename(self, source: str, target: str) -> bool:
        """In one step, never over an existing target."""
        if self._exists(target):
            return False
        self._fs.mkdirs(self._path(target).getParent())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(self.base).toUri() if "://" in self.base else self._jvm.java.net.URI.create("file:///"),
            self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        try:
            context.rename(self._path(source), self._path(target), options)
        except Exception:
            if self._exists(target):
                return False
            raise
        return True

    def _delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    # --- records ---

    def _record_path(self, id_) -> str:
        return f"{self.base}/_commits/{quote(str(id_), safe='')}.json"

    def records(self) -> list[dict]:
        """Records in force, by the time of their commit: those that a compaction
        replaced are left out.  One short entry per commit since the last one."""
        folder = f"{self.base}/_commits"
        if not self._exists(folder):
            return []
        found = []
        for status in self._fs.listStatus(self._path(folder)):
            name = status.getPath().getName()
            if not name.endswith(".json") or name.startswith((".", "_")):
                continue
            stream = self._fs.open(status.getPath())
            try:
                found.append(json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
        replaced = {x for r in found for x in r.get("replaces", [])}
        return sorted((r for r in found if r["id"] not in replaced), key=lambda r: (r["at"], r["id"]))

    def ids(self) -> set[str]:
        """Every committed id, replaced ones too."""
        return {x for r in self.records() for x in (r["id"], *r.get("replaces", []))}

    def committed(self, id_) -> bool:
        return self._exists(self._record_path(id_)) or str(id_) in self.ids()

    def commit(self, id_, folders: dict[str, str | list[str]], **facts) -> bool:
        """Record the attempt's folders under ``id_``; False if another attempt was first."""
        stamp = self._jvm.java.lang.System.currentTimeMillis()
        record = {"id": str(id_), "at": stamp, "folders": folders, **facts}
        temp = f"{self.base}/_commits/.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(temp), False)
        try:
            stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
        finally:
            stream.close()
        if self._rename(temp, self._record_path(id_)):
            return True
        self._delete(temp)
        return False

    # --- data ---

    def attempt(self, kind: str, id_) -> str:
        """A new folder for one attempt at writing ``id_``."""
        return f"{self.base}/{kind}/{quote(str(id_), safe='')}-{uuid.uuid4().hex[:12]}"

    @staticmethod
    def named(record: dict, kind: str) -> list[str]:
        """The folders of a kind that a record names: none, one, or a list where a
        merge left full folders as they are."""
        found = record["folders"].get(kind, [])
        return [found] if isinstance(found, str) else list(found)

    def folders(self, kind: str) -> list[str]:
        return [f for r in self.records() for f in self.named(r, kind)]

    def size(self, folder: str) -> tuple[int, int]:
        """Bytes and number of a folder's data files."""
        sizes = [s.getLen() for s in self._fs.listStatus(self._path(folder)) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        return sum(sizes), len(sizes)

    def read(self, kind: str, schema: StructType | str | None = None, fmt: str = "parquet", **options) -> DataFrame:
        """The rows of all committed folders of a kind (an empty table of ``schema``
        if there are none)."""
        paths = self.folders(kind)
        reader = self.spark.read.options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        if not paths:
            if schema is None:
                raise ValueError(f"nothing is committed in {self.base} and no schema was given")
            return self.spark.createDataFrame([], schema)
        return reader.format(fmt).load(paths)

    def compact(self, kind: str, fmt: str = "parquet", keep: int = 0, schema: StructType | str | None = None, **options) -> int:
        """Rewrite all but the last ``keep`` commits of a log of one kind into one
        folder with files of Spark's advisory size, recorded as their replacement;
        their files go after the record is there (a reader that has listed them
        before is to be let finish first).  Returns the number replaced."""
        records = self.records()
        old = records[:len(records) - keep]
        if len(old) < 2:
            return 0
        if any(set(r["folders"]) != {kind} for r in old):
            raise ValueError("only logs of one kind of folder are compacted here")
        reader = self.spark.read.options(**options)
        reader = reader.schema(schema) if schema is not None else reader
        rows = reader.format(fmt).load([f for r in old for f in self.named(r, kind)])
        target = self.attempt(kind, "compacted")
        rows.hint("rebalance").write.format(fmt).options(**options).save(target)
        replaces = [x for r in old for x in (r["id"], *r.get("replaces", []))]
        self.commit(f"compacted-{uuid.uuid4().hex[:12]}", {kind: target}, replaces=replaces)
        for r in old:
            for folder in self.named(r, kind):
                self._delete(folder)
            self._delete(self._record_path(r["id"]))
        return len(old)

    def sweep(self, kind: str) -> int:
        """Remove the files of attempts that no record names (killed or beaten
        ones); to be run when no writer is at work.  Returns their number."""
        root = f"{self.base}/{kind}"
        if not self._exists(root):
            return 0
        known = {f.rsplit("/", 1)[-1] for f in self.folders(kind)}
        lost = [s.getPath() for s in self._fs.listStatus(self._path(root)) if s.getPath().getName() not in known]
        for path in lost:
            self._fs.delete(path, True)
        return len(lost)


def append_once(df: DataFrame, base: str, id_, kind: str = "rows", fmt: str = "parquet", **options) -> bool:
    """Append ``df`` to a committed folder under ``id_``.  False, and nothing
    written, if the id is committed already; an attempt that died leaves no rows."""
    log = CommitLog(df.sparkSession, base)
    if log.committed(id_):
        return False
    target = log.attempt(kind, id_)
    df.write.format(fmt).options(**options).save(target)
    return log.commit(id_, {kind: target})


def publish_once(df: DataFrame, base: str, id_, fmt: str = "parquet") -> bool:
    """As ``append_once`` for folders that a file stream reads (``stream_path``):
    a file stream cannot follow a log, so the attempt is written out of its sight
    and its folder appears under ``base/data`` in one step.  A run that died
    between that step and the record is recorded by the rerun, not written again."""
    log = CommitLog(df.sparkSession, base)
    if log.committed(id_):
        return False
    final = f"{log.base}/data/{quote(str(id_), safe='')}"
    if not log._exists(final):
        staged = log.attempt("_staging", id_)
        df.write.format(fmt).save(staged)
        log._rename(staged, final)
    return log.commit(id_, {"data": final})


def stream_path(base: str) -> str:
    """Path for a file stream over what ``publish_once`` wrote."""
    return f"{base.rstrip('/')}/data/*"
