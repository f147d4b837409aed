"""Packing documents into fixed-length sequences by minimum bin slack.

A document's ids are cut into full windows and a remainder.  The remainders
are packed from the histogram of their lengths alone, which has fewer entries
than a window has tokens however many documents there are: again and again
the longest remaining length opens a window, a subset-sum over a bitset finds
the multiset of remaining lengths that comes closest to filling it,
backtracking gives the counts, and the pattern is used as often as the counts
allow.  Where no multiset fills a window, one remainder is cut to fill it and
its rest goes back into the histogram, so that only the last window has
padding.  Documents then find their window by their rank among the remainders
of their length; ranks come from running counts over ranges, so a length that
a third of all documents share is spread like any other.

Defined results: NULL and empty texts are the end id alone; identical rows are
documents of their own, told apart by ``uid``; NULL or repeated ids are
carried through; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import cut, only, running, small

END = 1
#: Runs without a break beyond this go to the library whose merge is not quadratic.
_LONG_RUN = re.compile(r"\S{2000}")


def vocabulary(name: str) -> str:
    """Where the installed public tokenizer file of this name is."""
    import public_tokenizers
    return public_tokenizers.path(name)


@cache
def encoder(path: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids of the tokenizer file at ``path`` (byte-level BPE; the
    installed 50k vocabulary by default).

    If the same vocabulary lies beside it as ranks, most texts go through the
    rank form of the same merges, which is several times faster; texts with a
    special token's string or a very long run go through the file itself."""
    import os

    import tiktoken
    from tokenizers import Tokenizer

    path = path or vocabulary("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def slow(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    ranks_path = re.sub(r"\.json$", ".tiktoken", path)
    if not os.path.exists(ranks_path):
        return slow
    import public_tokenizers
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special) or _LONG_RUN.search(text):
            return slow(text)
        return fast.encode_ordinary(text)

    return encode


def ids_of(text: str | None, path: str | None = None) -> np.ndarray:
    """A document's ids with the end id, as little-endian unsigned 32 bit."""
    return np.array([*encoder(path)(text or ""), END], dtype="<u4")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


# ---------------------------------------------------------------- the plan


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset within ``counts`` (length: how many) whose sum comes
    closest to ``room`` without passing it, as length: used.

    Bit ``s`` of the bitset says that sum ``s`` can be reached; lengths enter
    from the longest, a count by doubling, until ``room`` itself is reached."""
    bits, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        before, left, step = bits, min(counts[length], room // length), 1
        while left:
            k = min(step, left)
            bits |= (bits << (k * length)) & full
            left, step = left - k, step * 2
        steps.append((length, before))
        if bits >> room & 1:
            break
    at, used = bits.bit_length() - 1, {}
    for length, before in reversed(steps):
        k = 0
        while not before >> (at - k * length) & 1:
            k += 1
        if k:
            used[length], at = k, at - k * length
    return used


def plan(counts: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int, int, int]], int]:
    """Places for all remainders: rows ``(length class, first rank, end rank,
    from, tokens, sequence, offset)`` and the number of sequences.

    The remainder of rank ``k`` of its class puts ``tokens`` ids, ``from`` its
    first, at ``offset`` of ``sequence + k - first rank``."""
    stock: dict[int, list[tuple[int, int, int, int]]] = {n: [(n, 0, c, 0)] for n, c in counts.items() if c > 0}
    left = {n: c for n, c in counts.items() if c > 0}
    rows, sequences = [], 0

    def take(length: int, n: int) -> list[tuple[int, int, int, int]]:
        """``n`` remainders of a length, as runs ``(class, first, end, from)``."""
        left[length] -= n
        if not left[length]:
            del left[length]
        out, queue = [], stock[length]
        while n:
            cls, a, b, at = queue[0]
            k = min(n, b - a)
            out.append((cls, a, a + k, at))
            n -= k
            if a + k == b:
                queue.pop(0)
            else:
                queue[0] = (cls, a + k, b, at)
        return out

    while left:
        seed = max(left)
        rest = dict(left)
        rest[seed] -= 1
        used = best_fill({n: c for n, c in rest.items() if c}, window - seed)
        used[seed] = used.get(seed, 0) + 1
        slack = window - sum(n * k for n, k in used.items())
        spare = [n for n, c in left.items() if c > used.get(n, 0)]
        cut_one = max(spare) if slack and spare else 0
        need = dict(used)
        if cut_one:
            need[cut_one] = need.get(cut_one, 0) + 1
        times = min(left[n] // k for n, k in need.items())
        offset = 0
        for length, k in sorted(used.items(), reverse=True):
            for _ in range(k):
                done = 0
                for cls, a, b, at in take(length, times):
                    rows.append((cls, a, b, at, length, sequences + done, offset))
                    done += b - a
                offset += length
        if cut_one:
            done, back = 0, []
            for cls, a, b, at in take(cut_one, times):
                rows.append((cls, a, b, at, slack, sequences + done, offset))
                back.append((cls, a, b, at + slack))
                done += b - a
            stock.setdefault(cut_one - slack, []).extend(back)
            left[cut_one - slack] = left.get(cut_one - slack, 0) + times
        sequences += times
    return rows, sequences


def _lookup(rows: list[tuple[int, int, int, int, int, int, int]]):
    """Rank intervals with one list of places each: arrays to search."""
    own: dict[int, list] = defaultdict(list)
    for r in rows:
        own[r[0]].append(r)
    starts, places = [], []
    for cls in sorted(own):
        mine = sorted(own[cls], key=lambda r: (r[1], r[3]))
        edges = sorted({r[1] for r in mine} | {r[2] for r in mine})
        per = {a: [] for a in edges}
        index = {a: i for i, a in enumerate(edges)}
        for r in mine:
            for a in edges[index[r[1]]:index[r[2]]]:
                per[a].append(r)
        for a in edges[:-1]:
            starts.append((cls, a))
            places.append(per[a])
    return starts, places


# ---------------------------------------------------------------- on Spark


def _tokenized(batches: Iterator[pa.RecordBatch], window: int, path: str | None) -> Iterator[pa.RecordBatch]:
    """Token count and checksums of the full windows and of the remainder."""
    for b in batches:
        n, full, last = [], [], []
        for text in b.column("_t").to_pylist():
            ids = ids_of(text, path)
            whole = len(ids) // window
            n.append(len(ids))
            full.append([_crc(ids[i * window:(i + 1) * window]) for i in range(whole)])
            last.append(_crc(ids[whole * window:]))
        yield pa.RecordBatch.from_arrays(
            [b.column("_doc_id"), b.column("_k1"), b.column("_k2"), pa.array(n, pa.int64()),
             pa.array(full, pa.list_(pa.int64())), pa.array(last, pa.int64())],
            names=["_doc_id", "_k1", "_k2", "_n", "_full", "_last"])


def _recut(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    """Checksums of the pieces of remainders that were cut."""
    for b in batches:
        uid, start, crc = [], [], []
        for u, text, starts, lengths in zip(*(b.column(c).to_pylist() for c in ("uid", "_t", "_starts", "_lengths")), strict=True):
            ids = ids_of(text, path)
            for s, n in zip(starts, lengths, strict=True):
                uid.append(u)
                start.append(s)
                crc.append(_crc(ids[s:s + n]))
        yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(start, pa.int64()), pa.array(crc, pa.int64())],
                                         names=["uid", "start", "_crc"])


def pack(docs: DataFrame, window: int = 2048, text: str = "text", id_col: str = "doc_id",
         path: str | None = None) -> DataFrame:
    """Every document's pieces: ``uid, doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``."""
    id_type = dict(docs.dtypes)[id_col]
    t = only(docs, id_col, text).select(F.col(f"`{id_col}`").alias("_doc_id"), F.col(f"`{text}`").alias("_t"))
    keyed = t.withColumn("_t", F.coalesce("_t", F.lit(""))).select(
        "_doc_id", "_t", F.xxhash64("_t").alias("_k1"), F.xxhash64(F.lit(1), "_t").alias("_k2"))
    sized = keyed.mapInArrow(lambda it: _tokenized(it, window, path),
                             f"_doc_id {id_type}, _k1 long, _k2 long, _n long, _full array<long>, _last long")
    sized = cut(sized.withColumn("uid", F.monotonically_increasing_id()), "pack-sizes")
    counts = sized.select((F.col("_n") % window).cast("int").alias("c")).where("c > 0").groupBy("c").agg(F.count("*").alias("n"))
    counts = {r.c: r.n for r in counts.collect()}  # fewer rows than a window has tokens
    rows, planned = plan(counts, window)
    spark = docs.sparkSession
    search = spark.sparkContext.broadcast(_lookup(rows))  # bounded by the histogram's patterns

    order = sized.select("uid", (F.col("_n") % window).cast("int").alias("_class"), F.size("_full").cast("long").alias("_wholes"))
    ranked = running(order, ["_class", "uid"], {"_before": "_wholes"}, "pack-ranks")
    first, at = {}, 0  # global row at which a class begins
    for c in [0, *sorted(counts)]:
        first[c] = at
        at += counts.get(c, 0)
    zero = sized.where(F.col("_n") % window == 0).count()
    first = {c: v + (zero if c else 0) for c, v in first.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, places = search.value
        cls = np.array([s[0] for s in starts], dtype=np.int64)
        low = np.array([s[1] for s in starts], dtype=np.int64)
        shift = 1 << 40
        keys = cls * shift + low
        for b in batches:
            c, row = (np.asarray(b.column(x).to_pylist(), dtype=np.int64) for x in ("_class", "_row"))
            rank = row - np.array([first[x] for x in c.tolist()], dtype=np.int64)
            found = np.searchsorted(keys, c * shift + rank, side="right") - 1
            out = {k: [] for k in ("uid", "from", "length", "seq", "offset", "pieces")}
            for u, k, i, r in zip(b.column("uid").to_pylist(), c.tolist(), found.tolist(), rank.tolist(), strict=True):
                for p in places[i] if k else []:
                    for name, v in zip(out, (u, p[3], p[4], p[5] + r - p[1], p[6], len(places[i])), strict=True):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))

    spots = cut(ranked.select("uid", "_class", "_row").mapInArrow(
        place, "uid long, `from` long, length long, seq long, offset long, pieces long"), "pack-places")
    wholes = ranked.select("uid", "_before")
    base = F.col("_n") - F.col("_n") % window
    ends = sized.where(F.col("_n") % window > 0).join(spots, "uid").select(
        "uid", "_doc_id", "_k1", "_k2", (base + F.col("from")).alias("start"), "length",
        F.when(F.col("pieces") == 1, F.col("_last")).alias("ids_crc32"), F.col("_n").alias("doc_tokens"),
        F.col("seq").alias("sequence_id"), "offset")
    full = sized.where("size(_full) > 0").join(wholes, "uid").select(
        "uid", "_doc_id", "_k1", "_k2", F.posexplode("_full").alias("_i", "ids_crc32"), "_n", "_before").select(
        "uid", "_doc_id", "_k1", "_k2", (F.col("_i") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"),
        "ids_crc32", F.col("_n").alias("doc_tokens"), (planned + F.col("_before") + F.col("_i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    # checksums of cut remainders: their texts are tokenized once more
    loose = cut(ends.where("ids_crc32 IS NULL").groupBy("uid", "_k1", "_k2").agg(
        F.collect_list(F.struct("start", "length")).alias("_p")), "pack-cut")
    keys = small(loose.select("_k1", "_k2").distinct())
    texts = keyed.join(keys, ["_k1", "_k2"]).select("_k1", "_k2", "_t").dropDuplicates(["_k1", "_k2"])
    again = loose.join(texts, ["_k1", "_k2"]).select("uid", "_t", F.col("_p.start").alias("_starts"), F.col("_p.length").alias("_lengths"))
    crcs = small(cut(again.mapInArrow(lambda it: _recut(it, path), "uid long, start long, _crc long"), "pack-recut"))
    ends = ends.join(crcs, ["uid", "start"], "left").withColumn("ids_crc32", F.coalesce("ids_crc32", "_crc")).drop("_crc")
    return full.unionByName(ends).drop("_k1", "_k2").withColumnRenamed("_doc_id", id_col)
