import random
import re
from collections import defaultdict

import numpy as np

from series_engine.llm import minhash
from series_engine.llm.components import components
from tests.llm.helpers import AWKWARD, clash, docs


def sets_of(rows, size):
    out = []
    for _, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute(rows, size, percent):
    sets, root = sets_of(rows, size), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    comp = defaultdict(list)
    for i in range(len(rows)):
        comp[find(i)].append(rows[i][0])
    return sorted(((r[0], len(sets[i]), min((x for x in comp[find(i)] if x is not None), default=None)) for i, r in enumerate(rows)), key=repr)


def corpus(rng, groups, copies):
    vocabulary, rows = [f"w{i}" for i in range(400)], []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(2, 90))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w).upper() if rng.random() < .2 else "\n".join(w), "en", "s", 0))
    return rows


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for m in (1, 3, 40, 900):
        common, a, b = (rng.integers(0, 2**63, size=k, dtype=np.uint64) for k in (m, m // 2, m // 3))
        x, y = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
        sx, sy = minhash.sketch(x, 400), minhash.sketch(y, 400)
        assert (sx != minhash._FULL).all() and (minhash.sketch(x[::-1].copy(), 400) == sx).all()
        j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((sx == sy).mean() - j) < .13


def test_linked_equals_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        rows = corpus(rng, 3, 45)
        got = minhash.linked([minhash.shingles(r[1], 3) for r in rows], 85)
        sets, want = sets_of(rows, 3), list(range(len(rows)))
        changed = True
        while changed:
            changed = False
            for i in range(len(rows)):
                for j in range(i):
                    if want[i] != want[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                        want[i] = want[j] = min(want[i], want[j])
                        changed = True
        assert got == want
    assert minhash.linked([], 85) == []


def test_components(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(50)] + [(100 + rng.randrange(200), 100 + rng.randrange(200)) for _ in range(110)] + [(900, 1000 + i) for i in range(60)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equal_brute_force_in_one_and_in_many_blocks(spark):
    rng = random.Random(11)
    rows = [*AWKWARD, (None, "alpha beta gamma DELTA", None, "b", 22), *[(1000 + r[0], *r[1:]) for r in corpus(rng, 25, 14)]]
    want = brute(rows, 3, 85)
    for options in ({}, {"block_shingles": 150}):
        got = minhash.near_duplicates(clash(docs(spark, rows), "_set", "_t", "component"), 3, .85, **options).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    assert all(r.kept for r in minhash.near_duplicates(docs(spark, AWKWARD[:3])).collect())


def test_blocks_are_bounded_by_sets(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join([*base[:rng.randint(12, 14)], f"end{i % 60}"]), "en", "s", 0) for i in range(150)]
    rows += [(1000 + i, " ".join(rng.choice(base) for _ in range(20)), "en", "s", 0) for i in range(20)]
    got = minhash.near_duplicates(docs(spark, rows), 3, 0.85, block_sets=12).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 3, 85)


def test_many_short_sets_in_one_block():
    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**63, 12, dtype=np.uint64)
    sets = [np.unique(np.append(common, x)) for x in rng.integers(0, 2**63, 3000, dtype=np.uint64)]
    assert minhash.linked(sets, 85) == [0] * 3000 and minhash.linked(sets, 90) == list(range(3000))


def test_texts_go_to_python_in_short_batches(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F
    from series_engine.llm import toxicity

    def most():
        def rows(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
        wide = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("abcdefghij"), 1000).alias("t"))
        return max(r.n for r in wide.mapInArrow(rows, "n long").collect()) * 10_000

    table = docs(spark, AWKWARD)
    for call in (lambda: minhash.near_duplicates(table), lambda: toxicity.reject(table, toxicity.Model({}))):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        assert most() == 4_000_000
        call()
        assert most() < 1_500_000
