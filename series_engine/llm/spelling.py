"""Spelling variants: words one edit apart, and the form each is a variant of.

Words are counted in the tasks that read the texts and summed by Spark.  Two words
one edit apart share what lies before the edit and what lies after it.  So of a
pair whose shorter word has ``m`` code points, either the first ``m // 2`` agree or
the last ``m - m // 2`` do, and words meet in groups of a common start or end.  A
group of more than ``group_words`` words is halved again in the same way, on the
part between its common start and end, until it is small or at most one code point
wide (a bound by the alphabet alone), so no start or end that very many words share
is ever one group.  Which group a pair belongs to follows from the length of its
common start, so it is found once.

A group is a sorted list.  For every word the words after it are scanned in order
with the edit matrix of the two: only three cells a row (one insertion or deletion
either way) are kept, rows of the part that a word shares with the one before it
(their LCP) are used again, and where a row has no cell of at most one edit, all
words that share the prefix up to that row are skipped in one step.

Defined results: NULL and empty texts hold no words; a NULL ``doc_id`` is written as
nothing before the colon; repeated rows count as often as they occur; of forms with
one count the smallest in code-point order is taken; a word without near words has
0 of them, no form, and is its own root; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import cut, parallelism, small

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Every so many (document, word) pairs, by hash, a code point is deleted.
DELETE_ONE_IN = 199
#: Words that a task counts before it hands them on.
_HELD = 200_000


def _counted(batches: Iterator[pa.RecordBatch], min_chars: int, one_in: int) -> Iterator[pa.RecordBatch]:
    from collections import Counter
    total: dict[str, int] = {}

    def out():
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    for b in batches:
        for key, text in zip(b.column("_key").to_pylist(), b.column("_t").to_pylist()):
            start = zlib.crc32(f"{'' if key is None else key}:".encode())
            for run, n in Counter(RUN.findall(text or "")).items():
                if len(run) < min_chars:
                    continue
                run = run.lower() if run.isascii() else run.translate(_LOWER)
                h = zlib.crc32(run.encode(), start)
                if h % one_in == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < min_chars:
                        continue
                total[run] = total.get(run, 0) + n
            if len(total) > _HELD:
                yield out()
                total = {}
    if total:
        yield out()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 6, min_count: int = 5,
               one_in: int = DELETE_ONE_IN) -> DataFrame:
    """``word, n``: the words of at least ``min_chars`` code points and ``min_count`` occurrences."""
    t = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_t"))
    counted = t.mapInArrow(lambda it: _counted(it, min_chars, one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _group(m: Column, a: Column, c: Column) -> Column:
    """Key of the words with a common start of ``a`` and a common end of ``c``."""
    word = F.col("word")
    return F.concat_ws(":", m, a, c, F.substr(word, F.lit(1), a), F.substr(word, F.length(word) - c + 1, c))


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: in the group of a longer common start and of a longer common end."""
    half = F.floor((F.col("m") - F.col("a") - F.col("c")) / 2).cast("int")
    ways = F.array(F.struct((F.col("a") + half).alias("a"), F.col("c").alias("c")),
                   F.struct(F.col("a").alias("a"), (F.col("m") - F.col("a") - half).alias("c")))
    out = rows.select("word", "n", "m", F.explode(ways).alias("w")).select("word", "n", "m", "w.a", "w.c")
    return out.withColumn("g", _group(F.col("m"), F.col("a"), F.col("c")))


def grouped(vocab: DataFrame, group_words: int) -> DataFrame:
    """``g, word, n, m, a, c``: the words in groups of at most about ``group_words``
    in one of which every pair of near words meets."""
    shorter = F.array(F.length("word"), F.length("word") - 1)  # a word may be the shorter or the longer of a pair
    rows = vocab.select("word", "n", F.explode(shorter).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("c"))
    rows = _halved(rows.where("m > 0"))
    done = None
    while True:  # every round halves the open part: as many rounds as the longest word has bits
        sizes = rows.groupBy("g").agg(F.count("*").alias("k"), F.max(F.col("m") - F.col("a") - F.col("c")).alias("wide"))
        sizes = cut(sizes.where("k > 1"), "spelling-sizes")
        large = (F.col("k") > group_words) & (F.col("wide") > 1)
        rest = rows.join(small(sizes.where(~large).select("g")), "g")
        done = rest if done is None else done.unionAll(rest)
        if not sizes.where(large).limit(1).count():
            return done
        rows = cut(_halved(rows.join(small(sizes.where(large).select("g")), "g").drop("g")), "spelling-halved")


def near_in_list(words: list[str], shared: int) -> Iterator[tuple[int, int, int]]:
    """``(i, j, common)`` for all i < j of a sorted list of different words with a
    common start of ``shared`` that are exactly one edit apart; ``common`` is the
    length of their common start."""
    n = len(words)
    lcp = [0] * n  # with the word before
    for j in range(1, n):
        x, y, d = words[j - 1], words[j], shared
        top = min(len(x), len(y))
        while d < top and x[d] == y[d]:
            d += 1
        lcp[j] = d
    for i in range(n - 1):
        q = words[i]
        size = len(q)
        padded = q + "\0\0\0"
        # rows[d]: edits from the first d code points of the list's word to the first d - 1, d, d + 1 of q
        rows: list[tuple[int, int, int]] = [(1, 0, 1)] * (shared + 1)
        known = shared  # rows up to this depth belong to the word before
        common = size   # with q
        j = i + 1
        while j < n:
            w = words[j]
            common = min(common, lcp[j])
            d = min(known, lcp[j])
            del rows[d + 1:]
            x0, x1, x2 = rows[d]
            end, dead = len(w), False
            while d < end:
                ch = w[d]
                y0 = x0 if d and d <= size and padded[d - 1] == ch else x0 + 1
                if x1 < y0:
                    y0 = x1 + 1
                y1 = x1 if d < size and padded[d] == ch else x1 + 1
                if x2 < y1:
                    y1 = x2 + 1
                if y0 < y1:
                    y1 = y0 + 1
                y2 = x2 if d + 1 < size and padded[d + 1] == ch else x2 + 1
                if y1 < y2:
                    y2 = y1 + 1
                d += 1
                x0, x1, x2 = y0, y1, y2
                rows.append((x0, x1, x2))
                if x0 > 1 and x1 > 1 and x2 > 1:
                    dead = True
                    break
            known = d
            if dead:
                # all words that go on from this prefix are as far away
                past = bisect_left(words, w[:d] + "\U0010ffff", j + 1)
                if past > j + 1:
                    common = min(common, min(lcp[j + 1:past]))
                j = past
                continue
            if -1 <= size - end <= 1 and (x0, x1, x2)[size - end + 1] == 1:
                yield i, j, common
            j += 1


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of near words of rows that are sorted by group, then word."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(k).to_pylist() for k in ("g", "m", "a", "c", "word", "n")))

    found: list[tuple[str, int, str, int]] = []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), (pa.string(), pa.int64()) * 2)],
                                          names=["u", "nu", "v", "nv"])

    for (_, m, a, c), members in groupby(rows(), itemgetter(0, 1, 2, 3)):  # the first names the others
        list_ = [(r[4], r[5]) for r in members]
        words = [w for w, _ in list_]
        for i, j, common in near_in_list(words, a):
            x, y = words[i], words[j]
            if min(len(x), len(y)) == m and (c == 0 or common < m - c):
                found.append((x, list_[i][1], y, list_[j][1]))
        if len(found) > 20_000:
            yield out()
            found = []
    if found:
        yield out()


def near_pairs(vocab: DataFrame, group_words: int = 64) -> DataFrame:
    """``u, nu, v, nv``: every pair of words one edit apart, once."""
    rows = grouped(vocab, group_words)
    dealt = rows.repartition(parallelism(vocab), "g").sortWithinPartitions("g", "word")
    return dealt.mapInArrow(_near, "u string, nu long, v string, nv long")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 6, min_count: int = 5, ratio: int = 5,
             one_in: int = DELETE_ONE_IN, group_words: int = 64) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word: its near words, the
    most frequent of them if it occurs ``ratio`` times as often, and where forms
    of forms end."""
    vocab = cut(vocabulary(docs, key, text, min_chars, min_count, one_in), "spelling-words")
    pairs = near_pairs(vocab, group_words)
    both = F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("o"), F.col("nv").alias("k")),
                   F.struct(F.col("v").alias("word"), F.col("u").alias("o"), F.col("nu").alias("k")))
    best = pairs.select(F.explode(both).alias("p")).groupBy("p.word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.k")).alias("k"), F.col("p.o").alias("o"))).alias("b"))
    joined = vocab.join(best, "word", "left")
    is_form = -F.col("b.k") >= ratio * F.col("n")
    words = cut(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(is_form, F.col("b.o")).alias("form"), F.when(is_form, -F.col("b.k")).alias("form_n")), "spelling-near")
    # forms grow by the ratio at every step: few rounds of going twice as far reach the ends
    roots = cut(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("end"))
        went = cut(roots.join(small(further), "root", "left").select("word", F.coalesce("end", "root").alias("root"),
                                                                     F.col("end").isNotNull().alias("moved")), "spelling-roots")
        roots = went.select("word", "root")
        if not went.where("moved").limit(1).count():
            break
    return words.join(small(roots), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
