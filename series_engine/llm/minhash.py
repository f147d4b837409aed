"""Near-duplicate documents by fast similarity sketching.

*Sketch* (Dahlgaard, Knudsen and Thorup 2017).  In round ``i`` every shingle
is hashed to one of ``t`` bins and leaves ``i`` plus a hashed fraction there;
a bin keeps the smallest value.  After ``t`` rounds of free placement ``t``
rounds follow in which all shingles go to one given bin each, so every
coordinate is filled; most sets are done after a few rounds.  Two sets agree
on a coordinate with probability equal to their similarity, with the
concentration of independent draws.

*Banding.*  Rows per band are as many as ``max_sketch`` coordinates allow at a
chance of at most ``miss`` to share no band at the threshold.  A band key that
several sets share links them to its smallest member; components of these
links are the candidate groups.

*Verification* is exact and whole.  A group's texts meet in blocks of bounded
size, where the intersections of all shingle sets are counted and linked sets
joined.  A group that needs more than one block is dealt anew a few times,
which joins what belongs together in linear work; what is then outside the
group's largest component is compared with every block of the group.  Equal
sets are one class throughout, and no list of pairs is ever made.

Defined results: texts without words (or NULL) have an empty set and are
linked with nothing; rows with NULL ids are grouped like others but never name
a component unless all ids of it are NULL; repeated rows are one class; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, has_word, only, small, text_keys, text_or_empty
from series_engine.llm.components import components
from series_engine.llm.substring import Windows, word_hashes
from series_engine.session import short_batches

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles, A-Z lower-cased."""
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes: ASCII letters only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(Windows(word_hashes(words)).of(min(size, len(words))))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The ``t`` coordinates of a non-empty set: round in the upper, hashed
    fraction in the lower half."""
    best = np.full(t, _FULL)
    start, step = 0, 2
    while start < 2 * t and (open_bins := np.flatnonzero(best == _FULL)).size:
        last = min(start + step, t if start < t else 2 * t)
        rounds = np.arange(start, last, dtype=np.uint64)
        if start >= t:  # only bins still open get a round of their own
            rounds = rounds[np.isin(rounds - np.uint64(t), open_bins)]
        if len(rounds):
            h = _mix(items[None, :] ^ _mix(rounds + np.uint64(1))[:, None])
            value = (rounds[:, None] << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            if start < t:
                np.minimum.at(best, ((h >> np.uint64(32)) % np.uint64(t)).ravel().astype(np.int64), value.ravel())
            else:
                best[(rounds - np.uint64(t)).astype(np.int64)] = value.min(axis=1)
        start, step = last, max(1, min(step * 2, (1 << 18) // len(items)))
    return best


def bands(similarity: float, miss: float = 1e-6, max_sketch: int = 400) -> tuple[int, int]:
    """Number of bands and rows per band for a threshold."""
    best = (1, 1)
    for rows in range(1, 64):
        n = max(1, math.ceil(math.log(miss) / math.log1p(-similarity**rows))) if similarity < 1 else 1
        if n * rows <= max_sketch:
            best = (n, rows)
    return best


def band_keys(coords: np.ndarray, n: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = _mix(np.arange(1, n + 1, dtype=np.uint64))
        for column in coords.reshape(n, rows).T:
            key = _mix(key ^ column) + np.uint64(0x9E3779B97F4A7C15)
    return key


#: Rows of a block's matrix that are compared at a time.
_ROWS = 256


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the index of the first set of its component, linking sets
    with ``100 * intersection >= percent * union``.  All intersections are
    counted: shingles of few sets pair by pair, frequent ones by a product of
    incidence matrices."""
    m = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros((m, m), dtype=np.float32 if size.max(initial=0) < 1 << 24 else np.float64)
    owner = np.repeat(np.arange(m), size)
    _, feature, count = np.unique(np.concatenate(sets) if m else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    order = np.argsort(feature, kind="stable")
    owner, starts = owner[order], np.concatenate([[0], np.cumsum(count)[:-1]])
    for d in np.unique(count[(count > 1) & (count <= 32)]).tolist():
        own = owner[starts[count == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(i + 1, d):
                np.add.at(both, (own[:, i], own[:, j]), 1)
    often = np.flatnonzero(count > 32)
    for k in range(0, len(often), 1024):
        part = often[k:k + 1024]
        incidence = np.zeros((m, len(part)), dtype=both.dtype)
        for c, f in enumerate(part.tolist()):
            incidence[owner[starts[f]:starts[f] + count[f]], c] = 1
        for i in range(0, m, _ROWS):
            both[i:i + _ROWS] += incidence[i:i + _ROWS] @ incidence.T
    # owners ascend within a feature, so pairs lie above the diagonal
    root = np.arange(m)
    for i in range(0, m, _ROWS):
        near = both[i:i + _ROWS].astype(np.int64)
        close = near * 100 >= percent * (size[i:i + _ROWS, None] + size[None, :] - near)
        for x, row in enumerate(close, i):
            if size[x]:
                found = np.unique(root[x + 1:][row[x + 1:] & (size[x + 1:] > 0)])
                for r in found[found != root[x]].tolist():
                    low, high = sorted((r, int(root[x])))
                    root[root == high] = low
    return root.tolist()


def _sketched(batches: Iterator[pa.RecordBatch], size: int, n: int, rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {k: [] for k in ("_set", "_size", "_bands")}
        for text in b.column("_t").to_pylist():
            s = shingles(text, size)
            out["_size"].append(len(s))
            if len(s):
                with np.errstate(over="ignore"):
                    out["_set"].append(int(_mix(_mix(s ^ np.uint64(len(s))).sum(dtype=np.uint64)[None]).view(np.int64)[0]))
                out["_bands"].append(band_keys(sketch(s, n * rows), n, rows).view(np.int64))
            else:
                out["_set"].append(None)
                out["_bands"].append(None)
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), b.column("_k1"), b.column("_k2"), pa.array(out["_set"], pa.int64()), pa.array(out["_size"], pa.int64()),
             pa.array(out["_bands"], pa.list_(pa.int64()))], names=["_id", "_k1", "_k2", "_set", "_size", "_bands"])


def _block_links(size: int, percent: int):
    def links(table: pa.Table) -> pa.Table:
        nodes = table.column("_set").to_pylist()
        order = sorted(range(len(nodes)), key=nodes.__getitem__)
        texts = table.column("_t")
        root = linked([shingles(texts[i].as_py(), size) for i in order], percent)
        pairs = [(nodes[order[i]], nodes[order[r]]) for i, r in enumerate(root) if i != r]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})
    return links


def classes(docs: DataFrame, size: int = 5, similarity: float = 0.8, block_shingles: int = 400_000, mixes: int = 2,
            block_sets: int = 2000, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``_id, _k1, _k2, _set, _size, component``: every row with its set (NULL
    if empty) and the component of its set; ``component`` is a set too."""
    short_batches(docs.sparkSession)
    n, rows = bands(similarity)
    percent = round(100 * similarity)
    kind = dict(docs.dtypes)[id_col]
    t = only(docs, id_col, text).select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text}`")).alias("_t"))
    t = t.select("_id", *text_keys(F.col("_t")), "_t")
    signed = cut(t.mapInArrow(lambda it: _sketched(it, size, n, rows),
                              f"_id {kind}, _k1 long, _k2 int, _set long, _size long, _bands array<long>"), "near-sketches")
    sets = signed.where("_set IS NOT NULL").groupBy("_set").agg(
        F.min(F.struct("_k1", "_k2")).alias("_key"), F.max("_size").alias("_size"), F.first("_bands").alias("_bands"))
    sets = cut(sets, "near-sets")
    keyed = sets.select("_set", F.explode("_bands").alias("_band"))
    pivots = keyed.groupBy("_band").agg(F.min("_set").alias("b"), F.max("_set").alias("_m")).where("b <> _m").select("_band", "b")
    candidates = keyed.join(pivots, "_band").select(F.col("_set").alias("a"), "b").where("a <> b").distinct()
    groups = components(candidates).withColumnsRenamed({"node": "_set", "component": "_group"})
    members = groups.join(sets.select("_set", "_key", "_size"), "_set")
    blocks = F.greatest(F.ceil(F.sum("_size") / block_shingles), F.ceil(F.count("*") / block_sets)).cast("int")
    load = members.groupBy("_group").agg(blocks.alias("_blocks"))
    members = cut(members.join(small(cut(load, "near-loads")), "_group").select(
        "_set", "_group", "_blocks", "_size", F.col("_key._k1").alias("_k1"), F.col("_key._k2").alias("_k2")), "near-members")
    texts = t.select("_k1", "_k2", "_t").join(small(members.select("_k1", "_k2")), ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    members = cut(members.join(texts, ["_k1", "_k2"]).select("_set", "_group", "_blocks", "_size", "_t"), "near-texts")
    check, schema = _block_links(size, percent), "a long, b long"

    def dealt(rows: DataFrame, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64("_set", F.lit(salt)), F.col("_blocks"))
        return rows.withColumn("_block", block).select("_group", "_block", "_set", "_t").groupBy("_group", "_block").applyInArrow(check, schema)

    links = cut(dealt(members, 0), "near-links")
    large = members.where("_blocks > 1")
    if large.limit(1).count():
        for salt in range(1, mixes + 1):
            links = links.unionAll(cut(dealt(large, salt), "near-links"))
        found = components(links).withColumnsRenamed({"node": "_set", "component": "_comp"})
        placed = cut(large.join(found, "_set", "left").withColumn("_comp", F.coalesce("_comp", "_set")), "near-placed")
        counts = placed.groupBy("_group", "_comp").agg(F.count("*").alias("_n"))
        main = counts.groupBy("_group").agg(F.max_by("_comp", F.struct("_n", "_comp")).alias("_main"))
        placed = placed.join(main, "_group")
        rest = placed.where("_comp <> _main")
        share = rest.groupBy("_group").agg(blocks.alias("_rest"))
        placed = cut(placed.join(share, "_group"), "near-rest")
        # each block of the rest with each block of the whole group
        cell = lambda own, n, other, m: (F.pmod(F.xxhash64("_set", F.lit(own)), n).alias(own), F.explode(F.sequence(F.lit(0), m - 1)).alias(other))
        x = placed.where("_comp <> _main").select("_group", "_set", "_t", *cell("_i", F.col("_rest"), "_j", F.col("_blocks")))
        y = placed.select("_group", "_set", "_t", *cell("_j", F.col("_blocks"), "_i", F.col("_rest"))).select("_group", "_set", "_t", "_i", "_j")
        crossed = x.unionByName(y).dropDuplicates(["_group", "_i", "_j", "_set"]).groupBy("_group", "_i", "_j").applyInArrow(
            lambda table: check(table), schema)
        links = links.unionAll(cut(crossed, "near-links"))
    found = components(links).withColumnsRenamed({"node": "_set"})
    return (signed.drop("_bands").join(cut(found, "near-components"), "_set", "left")
            .withColumn("component", F.coalesce("component", "_set")))


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, text: str = "text",
                    id_col: str = "doc_id", **options) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every document."""
    rows = cut(classes(docs, size, similarity, text=text, id_col=id_col, **options), "near-classes")
    names = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("_id").alias("_first"))
    out = rows.join(cut(names, "near-names"), "component", "left")
    named = F.when(F.col("component").isNull(), F.col("_id")).otherwise(F.col("_first"))
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("n_shingles"), named.alias("component_id"),
                      F.col("_id").eqNullSafe(named).alias("kept"))


def deduplicate(docs: DataFrame, size: int = 5, similarity: float = 0.8, text: str = "text", id_col: str = "doc_id",
                **options) -> DataFrame:
    """The documents, all columns as they are, with one row of each group of
    near-duplicates: the one with the smallest id (NULL last)."""
    rows = cut(classes(docs, size, similarity, text=text, id_col=id_col, **options), "near-classes")
    key = [F.col("_id").isNull().alias("_null"), "_id", "_k1", "_k2"]
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(*key)).alias("_f")).select("_f.*")
    col = F.col(f"`{text}`")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"),
                        *text_keys(text_or_empty(col)), has_word(text_or_empty(col)).alias("_some"))
    keyed = keyed.alias("d")
    first = small(cut(first, "near-first")).alias("f")
    same = [F.col("d._k1") == F.col("f._k1"), F.col("d._k2") == F.col("f._k2"), F.col("d._id").eqNullSafe(F.col("f._id"))]
    chosen = keyed.where("_some").join(first, same, "left_semi")
    # equal rows with one id are one group too
    own = Window.partitionBy("_k1", "_k2", "_id").orderBy("_k1")
    chosen = chosen.withColumn("_r", F.row_number().over(own)).where("_r = 1")
    return chosen.select("_row.*").unionByName(keyed.where("NOT _some").select("_row.*"))
