import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from series_engine.llm import lexical
from tests.llm.helpers import AWKWARD, clash, docs

RUN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in RUN.findall(text or "")]


def brute(rows, items, top=10):
    """Every document scored for every item: the sorted (score, key) lists."""
    d = [(k, Counter(terms(t))) for k, t in rows]
    n_docs, n_all = sum(bool(c) for _, c in d), sum(c.total() for _, c in d)
    df = Counter(t for _, c in d for t in c)
    out = {}
    for item, text in set(items):
        scored = []
        for key, c in d:
            s = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * c.total() * n_docs // n_all
                s += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, key is None, key or 0))
        out[item] = [(i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(sorted(scored)[:top])]
    return out


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").repartition(2)


def check(spark, rows, items, **kw):
    df = clash(docs(spark, rows), "_key", "_t", "_n", "score", "rank", "item_id")
    got = lexical.search(df, clash(asked(spark, items), "_item", "_q", "doc_id"), **kw).collect()
    want = brute([(r[0], r[1]) for r in rows], items, kw.get("top", 10))
    have = {}
    for r in got:
        have.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert {k: sorted(v) for k, v in have.items()} == {k: v for k, v in want.items() if v}


ITEMS = [(1, "Alpha BETA one two"), (2, None), (3, ""), (4, "nowhere-to-be-found"), (5, "w end é Ω three"), (5, "w end é Ω three"),
         (None, "five six seven"), (8, "gamma  one\tten É")]


def test_awkward_rows(spark):
    check(spark, AWKWARD, ITEMS)


@pytest.mark.parametrize("kw", [{}, {"top": 3}, {"block_items": 3}])
def test_random_texts_with_many_terms(spark, monkeypatch, kw):
    monkeypatch.setattr(lexical, "_FIRST", 8)  # several rounds of masks
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(rnd.choices(vocab, weights, k=rnd.choice((1, 3, 30, 200)))), "en", "s", 0) for i in range(500)]
    rows += [(1000 + i, rows[3][1], "en", "s", 0) for i in range(200)]  # ties
    items = [(i, " ".join(rnd.choices(vocab, weights, k=k))) for i, k in enumerate((1, 2, 10, 40, 400, 3000))] + [(77, "v0")]
    check(spark, rows, items, **kw)


def test_masks_leave_documents_unscored():
    """Evaluation stops once the bound is below the tenth best score."""
    import numpy as np
    n = 100_000
    doc, term = np.concatenate([np.arange(n), np.arange(20)]), np.concatenate([np.zeros(n, np.int64), np.ones(20, np.int64)])
    batch = lexical.Batch(None, np.full(n, 100), doc, term, np.ones(n + 20, np.int64), 2)
    rows, scores = lexical.best_of(batch, np.array([0, 1]), np.array([10, 5000]), 0, 10)
    assert sorted(rows) == list(range(20)) and len(set(scores)) == 1


def test_empty_tables(spark):
    assert lexical.search(docs(spark, []), asked(spark, ITEMS)).count() == 0
    assert lexical.search(docs(spark), asked(spark, [])).count() == 0
    assert lexical.search(docs(spark).where(F.col("text").isNull()), asked(spark, ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]
