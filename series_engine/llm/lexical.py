"""Ranked lexical search: every item's best documents, by presence masks.

The items are the stated queries; they are dealt into blocks of bounded rows and
characters, whose terms every task can hold.  For a block the documents are read
once: each becomes its number of terms and the block's terms it holds with their
counts, written as a table.  Document frequencies are summed from that table
before anything is shuffled.

Documents are then ranked where they lie.  In a batch of documents every term has
its list of documents; for an item each term sets its bit in the presence mask of
its documents, and documents are grouped by mask.  A mask bounds the score of its
documents from above: every term of the mask at its largest count in the batch and
the length part of the shortest document of the group.  Masks are evaluated by
descending bound, exactly, until the bound falls below the tenth best score that
the task already has for the item: what remains cannot enter.  A task gives at
most ``top`` rows an item, and the best of these are the result, so no list of an
item's documents ever meets in one place, however common its terms are.

Terms are maximal runs of ASCII letters and digits and of code points from U+0080
on, with only A-Z lower-cased.  With N documents that hold a term, L terms in all
of them, n terms in a document, df documents holding a term, tf its count:
``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 10 + (90 n N) div L`` and a
document's score is the sum of ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the
item's distinct terms, in whole numbers.

Defined results: NULL and empty texts, of documents or items, hold no term, and an
item without terms, or whose terms no document holds, has no rows; only scores
above 0 are ranked; equal scores go by ascending key, NULL keys last, and rows of
one key and score in any order; a document that occurs twice ranks twice; an item
row that is repeated (same id and text) is one item, a NULL id is an id; extra
columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, text_or_empty

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Items, and characters of items, whose terms are held at once.
BLOCK_ITEMS, BLOCK_CHARS = 1000, 2_000_000
#: Documents that are looked through before the rest is bounded again.
_FIRST = 256


def lowered(term: str) -> str:
    return term.lower() if term.isascii() else term.translate(_LOWER)


def term_counts(text: str | None) -> Counter:
    """Terms of a text with their counts."""
    found = Counter(TERM.findall(text or ""))
    out: Counter = Counter()
    for t, n in found.items():
        out[lowered(t)] += n
    return out


def _held(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Of every document with a term: its number of terms, the known ones, their counts."""
    get = number.get
    for b in batches:
        at, totals, ends, terms, counts = [], [], [0], [], []
        for i, text in enumerate(b.column("_t").to_pylist()):
            found = Counter(TERM.findall(text or ""))
            if not found:
                continue
            own: dict[int, int] = {}
            for t, n in found.items():
                k = get(t)
                if k is None:
                    k = get(lowered(t))
                    if k is None:
                        continue
                own[k] = own.get(k, 0) + n
            at.append(i)
            totals.append(found.total())
            terms.extend(own)
            counts.extend(own.values())
            ends.append(len(terms))
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [b.column("_key").take(pa.array(at, pa.int32())), pa.array(totals, pa.int64()),
             pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["_key", "_n", "_terms", "_tfs"])


class Batch:
    """Documents of a batch with the list of documents of every term."""

    def __init__(self, keys, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        self.keys, self.m = keys, m
        order = np.argsort(term, kind="stable")  # by term, then by document
        self.doc, self.tf = doc[order], tf[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, term, tf)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[term], self.start[term + 1]
        return self.doc[a:b], self.tf[a:b]


def _part(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of(batch: Batch, terms: np.ndarray, weights: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the batch's documents that may be among the ``top`` of
    an item whose ``top``-th score so far is ``floor``: all that are above it or
    equal to it and among the batch's own best."""
    words = -(-len(terms) // 64)
    mask = np.zeros((len(batch.m), words), np.uint64)
    for j, t in enumerate(terms):
        mask[batch.of(t)[0], j // 64] |= np.uint64(1 << j % 64)
    rows = np.flatnonzero(mask.any(axis=1))
    none = np.zeros(0, np.int64)
    if not len(rows):
        return none, none
    own = mask[rows, 0] if words == 1 else np.ascontiguousarray(mask[rows]).view([("", np.uint64)] * words).ravel()
    order = np.argsort(own, kind="stable")
    own = own[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    rows = rows[order]
    ends = np.append(first[1:], len(rows))
    shortest = np.minimum.reduceat(batch.m[rows], first)
    bound = np.zeros(len(first), np.int64)
    for j, t in enumerate(terms):
        has = (mask[rows[first], j // 64] >> np.uint64(j % 64)) & np.uint64(1) != 0
        bound[has] += weights[j] * _part(batch.most[t], shortest[has])
    masks = np.argsort(-bound, kind="stable")
    found, scores, done, step = [none], [none], 0, _FIRST
    while done < len(masks):
        if bound[masks[done]] < max(floor, 1):
            break
        # whole groups of up to ``step`` documents, one at least, at a time
        size = np.cumsum(ends[masks[done:]] - first[masks[done:]])
        take = masks[done:done + max(1, int(np.searchsorted(size, step, side="right")))]
        take = take[bound[take] >= max(floor, 1)]
        done += len(take)
        some = np.sort(np.concatenate([rows[first[g]:ends[g]] for g in take]))
        score = np.zeros(len(some), np.int64)
        for j, t in enumerate(terms):
            d, tf = batch.of(t)
            if not len(d):
                continue
            at = np.minimum(np.searchsorted(d, some), len(d) - 1)
            hit = d[at] == some
            score[hit] += weights[j] * _part(tf[at[hit]], batch.m[some[hit]])
        keep = score >= max(floor, 1)
        found.append(some[keep])
        scores.append(score[keep])
        best = np.concatenate(scores)
        if len(best) >= top:
            floor = max(floor, int(np.partition(best, -top)[-top]))
        step *= 4
    return np.concatenate(found), np.concatenate(scores)


def _ranked(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weight: np.ndarray, n_docs: int, n_all: int,
            top: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a task for every item: (item number, key, score)."""
    best: list[list[tuple[int, bool, object]]] = [[] for _ in items]  # (-score, key is NULL, key), sorted
    kind = None
    for b in batches:
        if not b.num_rows:
            continue
        kind = b.schema.field("_key").type
        lists = b.column("_terms")
        lengths = np.diff(lists.offsets.to_numpy())
        term, tf = lists.flatten().to_numpy(), b.column("_tfs").flatten().to_numpy()
        n = b.column("_n").to_numpy()
        batch = Batch(b.column("_key"), 10 + (90 * n * n_docs) // n_all, np.repeat(np.arange(b.num_rows), lengths), term, tf, len(weight))
        for i, terms in enumerate(items):
            floor = -best[i][-1][0] if len(best[i]) >= top else 0
            rows, scores = best_of(batch, terms, weight[terms], floor, top)
            if len(rows):
                keys = batch.keys.take(pa.array(rows)).to_pylist()
                new = [(-int(s), k is None, 0 if k is None else k) for s, k in zip(scores, keys)]
                best[i] = sorted(best[i] + new)[:top]
    flat = [(i, None if null else key, -score) for i, own in enumerate(best) for score, null, key in own]
    if flat:
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], kind),
                                          pa.array([f[2] for f in flat], pa.int64())], names=["_i", "_key", "_score"])


def _weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block(docs: DataFrame, asked: list, top: int) -> DataFrame:
    """``_i, _key, _score`` of one block of items; ``asked`` has their texts."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["_key"]
    number: dict[str, int] = {}
    items = [np.array([number.setdefault(t, len(number)) for t in term_counts(text)], np.int64) for text in asked]
    held = cut(docs.mapInArrow(lambda it: _held(it, number), f"_key {kind}, _n long, _terms array<int>, _tfs array<long>"), "search-held")
    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("l")).first()
    # one row for each term of the block
    df = {r.t: r.n for r in held.select(F.explode("_terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    if not df:
        return spark.createDataFrame([], f"_i int, _key {kind}, _score long")
    weight = np.array([_weight(df.get(t, 0), size.n) for t in range(len(number))], np.int64)
    return held.mapInArrow(lambda it: _ranked(it, items, weight, size.n, size.l, top), f"_i int, _key {kind}, _score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", block_items: int = BLOCK_ITEMS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item, rank, key, score`` of every item's ``top`` best documents."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_t"))
    asked = cut(items.select(F.col(f"`{item}`").alias("_item"), text_or_empty(F.col(f"`{item_text}`")).alias("_q")).distinct(), "search-items")
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("_q")), F.lit(0)).alias("c")).first()
    blocks = max(1, -(-size.n // block_items), -(-size.c // block_chars))
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("_item", "_q"), F.lit(blocks)))
    kind, doc_kind = asked.schema["_item"].dataType.simpleString(), rows.schema["_key"].dataType.simpleString()
    out = None
    for b in range(blocks):  # a block's items are bounded by the two parameters
        mine = dealt.where(F.col("_block") == b).orderBy("_item", "_q").collect()
        if not mine:
            continue
        ids = spark.createDataFrame([(i, r._item) for i, r in enumerate(mine)], f"_i int, _item {kind}")
        found = _block(rows, [r._q for r in mine], top).withColumn("_rank", F.row_number().over(
            Window.partitionBy("_i").orderBy(F.desc("_score"), F.asc_nulls_last("_key")))).where(F.col("_rank") <= top)
        part = found.join(F.broadcast(ids), "_i").select("_item", "_rank", "_key", "_score")
        part = cut(part, "search-found") if blocks > 1 else part
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], f"_item {kind}, _rank int, _key {doc_kind}, _score long")
    return out.select(F.col("_item").alias(item), F.col("_rank").alias("rank"), F.col("_key").alias(key), F.col("_score").alias("score"))
