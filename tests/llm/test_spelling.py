import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from series_engine.llm import spelling
from tests.llm.helpers import AWKWARD, clash, docs


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, one_in=199, min_chars=6, min_count=5, ratio=5):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, k, len(near[w]), form[w], words.get(form[w]), root(w)) for w, k in words.items()}


def got(spark, rows, **kw):
    df = clash(docs(spark, rows), "word", "n", "g", "m", "a", "c", "_key", "form")
    return [tuple(r) for r in spelling.variants(df, **kw).select("word", "n", "n_near", "form", "form_n", "root").collect()]


def texts(rnd, n, letters="abé", lengths=(6, 7, 8, 9)):
    made = ["".join(rnd.choices(letters, k=rnd.choice(lengths))) for _ in range(n)]
    weights = [1 / (i + 1) for i in range(n)]
    return [(i, " ".join(w.upper() if rnd.random() < 0.1 else w for w in rnd.choices(made, weights, k=80)) + ".", "en", "s", 0)
            for i in range(150)]


@pytest.mark.parametrize("group_words", [2, 64])
def test_words_equal_brute_force(spark, group_words):
    rows = AWKWARD + texts(random.Random(3), 250)
    out = got(spark, rows, group_words=group_words, one_in=7)
    want = brute([r[:2] for r in rows], one_in=7)
    assert len(out) == len(want) and set(out) == want
    assert any(r[5] != r[0] and r[3] != r[5] for r in out)  # a form of a form


def test_a_common_start_of_all_words_is_split(spark):
    rnd = random.Random(9)
    words = sorted({"commonstart" + "".join(rnd.choices("abcd", k=rnd.choice((3, 4, 5)))) for _ in range(600)})
    vocab = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    groups = spelling.grouped(vocab, 16)
    most = groups.groupBy("g").agg(F.count("*").alias("k"), F.max(F.col("m") - F.col("a") - F.col("c")).alias("wide")).collect()
    assert max(r.k for r in most if r.wide > 1) <= 16
    pairs = Counter(frozenset((r.u, r.v)) for r in spelling.near_pairs(vocab, 16).collect())
    assert set(pairs.values()) == {1}
    assert set(pairs) == {frozenset(p) for p in combinations(words, 2) if one_edit(*p)}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=1, max_size=7), max_size=25))
def test_list_scan_equals_brute_force(words):
    ordered = sorted(words)
    found = list(spelling.near_in_list(ordered, 0))
    want = {(i, j) for i, j in combinations(range(len(ordered)), 2) if one_edit(ordered[i], ordered[j])}
    assert len(found) == len(want) and {(i, j) for i, j, _ in found} == want
    for i, j, common in found:
        a, b = ordered[i], ordered[j]
        assert a[:common] == b[:common] and a[common:common + 1] != b[common:common + 1]


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, AWKWARD[:3]) == []
