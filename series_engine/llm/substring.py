"""Substring dedup by level-wise doubling.

A window of ``window`` words is removed when its word sequence also starts
anywhere else.  Windows are sought at growing lengths: a short window inside
every long one is looked up first, and only where it is repeated is the
search extended to twice the length, up to ``window`` itself, until no
candidates survive.

At each length a candidate is represented by one of the shorter windows inside
it, the one with the smallest hash.  Equal long windows hold equal short ones,
so they choose the same representative and none is lost, while neighbouring
candidates mostly share theirs: at nine words about one window in fourteen is
looked up.  At the last length a candidate represents itself.

A look-up is one aggregation by the window's hash.  It returns the windows
that occur once, which end their candidates, so a passage that a third of all
documents share is one number in every task and never a group; the repeated
windows need no answer.  Texts are stored once, bucketed by a 96-bit key, and
each level joins them, unmoved, with the windows that died.

Words have 64-bit hashes, from running sums over a text's bytes (by array code,
a slab of words at a time).  Short windows are told apart by 64 bits of them,
where an equal hash only keeps a candidate; those of the last length by 96, 32 of
which come from a second hash.

Defined results: NULL and empty texts have no words and keep nothing; each of
several equal rows has its windows repeated in the others; NULL and repeated
ids are carried through; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import cut, distinct_texts, only, text_keys, text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def lengths(window: int, base: int) -> list[int]:
    """Lengths of the levels: ``window`` halved until ``base`` is reached, and back."""
    out = [window]
    while out[0] > base:
        out.insert(0, (out[0] + 1) // 2)
    return out


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


@functools.cache
def _cached_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        power, back = np.full((2, n + 1), 1, dtype=np.uint64)
        power[1:], back[1:] = _BASE, _INVERSE
        return np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse from 0 to ``n`` at least; those of
    texts of usual length are kept."""
    size = max(1 << 10, 1 << n.bit_length())
    return _cached_powers(size) if size <= 1 << 20 else _cached_powers.__wrapped__(n)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose low bits alone would order windows badly, mixed."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


class Windows:
    """Hashes of all windows of any length of one text, from running sums."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        power, self.back = _powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(hashes * power[:n], out=self.sums[1:])

    def of(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        with np.errstate(over="ignore"):
            return _mixed((self.sums[length:] - self.sums[:n]) * self.back[:n])


#: A random number for each byte value.
_BYTES = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)))

#: Bytes that are summed in one go; longer words have a hash of their own kind.
_SLAB, _WORD = 1 << 16, 64


def hashed(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text in UTF-8, from running sums over its
    bytes, a bounded slab of words at a time."""
    raw = np.frombuffer(text, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = (raw == 32) | (raw - np.uint8(9) < 5)
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    short = np.minimum(size, _WORD)
    power, back = _powers(_SLAB + _WORD)
    out = np.empty(len(start), np.uint64)
    sums = np.zeros(_SLAB + _WORD + 1, np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            at = start[first]
            last = int(np.searchsorted(start, at + _SLAB))
            n = int(start[last - 1] + short[last - 1] - at)
            np.cumsum(_BYTES[raw[at:at + n]] * power[:n], out=sums[1:n + 1])
            begin, width = start[first:last] - at, short[first:last]
            out[first:last] = (sums[begin + width] - sums[begin]) * back[begin] + width.astype(np.uint64)
            first = last
    out = _mixed(out)
    for i in np.flatnonzero(size > _WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(text[start[i]:start[i] + size[i]])
    return out


def representatives(hashes: np.ndarray, within: int) -> np.ndarray:
    """For each candidate start ``p`` the start of the smallest of the
    ``within`` shorter windows from ``p`` on (by the upper half of the hash; the
    first, if several), by minima over ranges of doubled width."""
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= within:
        key, width = np.minimum(key[:-width], key[width:]), 2 * width
    if within > width:
        key = np.minimum(key[:width - within], key[within - width:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def search(words: np.ndarray, window: int, levels: list[int], dead: list[np.ndarray]):
    """Starts of the candidates that survive the given levels; with their
    representatives at the next level and those windows' hashes, if there is one."""
    if len(words) < window:
        return np.zeros(0, np.int64), None, None
    w = Windows(words)
    alive = np.ones(len(words) - window + 1, bool)
    for length, gone in zip(levels, dead, strict=False):
        if len(gone) and alive.any():
            end = np.zeros(len(words) - length + 1, bool)
            end[gone] = True
            alive &= ~(end[representatives(w.of(length), window - length + 1)] if length < window else end)
    if len(dead) == len(levels) or not alive.any():
        return np.flatnonzero(alive), None, None
    length = levels[len(dead)]
    h = w.of(length)
    if length == window:
        at = np.flatnonzero(alive)
    else:
        chosen = np.zeros(len(h), bool)
        chosen[representatives(h, window - length + 1)[alive]] = True
        at = np.flatnonzero(chosen)
    return np.flatnonzero(alive), at, h[at]


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _dead(column: pa.Array, levels: int) -> Iterator[list[np.ndarray]]:
    """Per text, the starts of the windows that died, level by level."""
    ends, tags = column.offsets.to_numpy(), column.values.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        level, at = tags[a:b] >> 32, tags[a:b] & 0xFFFFFFFF
        yield [at[level == k] for k in range(levels)]


def _looked_up(batches: Iterator[pa.RecordBatch], window: int, levels: list[int], level: int) -> Iterator[pa.RecordBatch]:
    last = level == len(levels) - 1
    for b in batches:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for k1, k2, n, text, dead in zip(b.column("_k1").to_pylist(), b.column("_k2").to_pylist(), b.column("_n").to_pylist(),
                                         _texts(b.column("_t")), _dead(b.column("_dead"), level), strict=True):
            words = hashed(text)
            _, at, h = search(words, window, levels, dead)
            if at is not None and len(at):
                second = Windows(_mixed(words ^ np.uint64(_BASE))).of(window)[at] if last else np.zeros(len(at), np.uint64)
                for o, v in zip(out, (h.view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32),
                                      np.full(len(at), k1, np.int64), (np.int64(k2) << np.int64(32)) | at,
                                      np.full(len(at), min(n, 2), np.int32)), strict=True):
                    o.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out], names=["_h", "_c", "_k1", "_tag", "_n"])


def _removed(batches: Iterator[pa.RecordBatch], window: int, levels: list[int], done: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "longest")}
        for text, dead in zip(_texts(b.column("_t")), _dead(b.column("_dead"), done), strict=True):
            words = text.split()  # bytes are split at the blanks of WORD and nowhere else
            alive = search(hashed(text), window, levels[:done], dead)[0]
            n_removed = longest = 0
            kept = words
            if len(alive):
                edge = np.zeros(len(words) + 1, np.int64)
                edge[alive] += 1
                edge[alive + window] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                run = np.diff(np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))))[::2]
                n_removed, longest = int(covered.sum()), int(run.max())
                kept = itertools.compress(words, (~covered).tolist())
            for k, v in zip(out, (len(words), n_removed, hashlib.sha256(b" ".join(kept)).hexdigest(), longest), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([b.column("_k1"), b.column("_k2"), *(pa.array(v, pa.string() if k == "kept_sha256" else pa.int64())
                                                                             for k, v in out.items())], names=["_k1", "_k2", *out])


def dedup_substrings(docs: DataFrame, window: int = 35, base: int = 9, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, n_words, n_removed, kept_sha256, longest`` of every document: words
    outside repeated windows are kept; ``longest`` is the longest removed run."""
    levels = lengths(window, base)
    texts = distinct_texts(docs, text, "substring-texts")
    spark = docs.sparkSession
    dead = spark.createDataFrame([], "_k1 long, _k2 int, _at long")
    done = 0

    def joined(dead: DataFrame) -> DataFrame:
        lists = dead.groupBy("_k1", "_k2").agg(F.collect_list("_at").alias("_dead"))
        return texts.join(lists, ["_k1", "_k2"], "left")

    for level in range(len(levels)):
        found = joined(dead).mapInArrow(lambda it, k=level: _looked_up(it, window, levels, k), "_h long, _c int, _k1 long, _tag long, _n int")
        once = (found.groupBy("_h", "_c").agg(F.sum("_n").alias("_n"), F.min("_k1").alias("_k1"), F.min("_tag").alias("_tag"))
                .where("_n = 1").select("_k1", F.shiftright("_tag", 32).cast("int").alias("_k2"),
                                        (F.col("_tag").bitwiseAND(F.lit(0xFFFFFFFF)) + (level << 32)).alias("_at")))
        once = cut(once, f"substring-once-{levels[level]}")
        dead, done = (once if not done else dead.unionAll(once)), done + 1
    result = joined(dead).mapInArrow(
        lambda it: _removed(it, window, levels, done), "_k1 long, _k2 int, n_words long, n_removed long, kept_sha256 string, longest long")
    rows = only(docs, id_col, text).select(F.col(f"`{id_col}`").alias("_id"), *text_keys(text_or_empty(F.col(f"`{text}`"))))
    return (rows.join(result, ["_k1", "_k2"])
            .select(F.col("_id").alias(id_col), "n_words", "n_removed", "kept_sha256", "longest"))
