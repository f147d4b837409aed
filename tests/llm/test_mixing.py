from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from series_engine.llm import mixing
from tests.llm.helpers import AWKWARD, clash, docs


def targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    budget, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        unit = (budget - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if unit * w[s] > most * sizes[s]}
        if not over:
            return out | {s: unit * w[s] for s in free}
        out |= {s: most * sizes[s] for s in over}
        free -= over
    return out


def corpus():
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 90))), "en", f"s{min(i % 9, 4)}", 0) for i in range(300)]
    rows += [(1000, " ".join(["w"] * 4000), "en", "s1", 0), (1001, "one", "en", "zz", 0), (1002, "two words", "en", None, 0)]
    return rows + AWKWARD


def test_targets_bounds_and_reruns(spark):
    rows = corpus()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    got = mixing.mix(clash(docs(spark, rows), "size", "shard", "copy", "_order"), block_words=16, shard_blocks=32)
    per = mixing.per_document(got).collect()
    assert len(per) == len(rows)
    want, taken = targets(dict(sizes)), defaultdict(int)
    for r in per:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    draws = got.where("shard IS NOT NULL").collect()
    by_shard = defaultdict(list)
    for r in draws:
        by_shard[r.shard].append(r.position)
    counts = [len(v) for _, v in sorted(by_shard.items())]
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert max(counts) - min(counts) <= 1 and max(counts) <= 32
    # drawn once per block and epoch, and the same again from other partitions
    keys = {(r.doc_id, r.text_hash, r.copy, r.block, r.epoch): (r.shard, r.position, r.taken) for r in draws}
    assert len(keys) == len(draws)
    again = mixing.mix(docs(spark, rows[::-1]).repartition(5), block_words=16, shard_blocks=32).where("shard IS NOT NULL").collect()
    assert {(r.doc_id, r.text_hash, r.copy, r.block, r.epoch): (r.shard, r.position, r.taken) for r in again} == keys


def test_split_is_hypergeometric(spark):
    got = spark.range(4000).select(mixing._hypergeometric(
        F.lit(1000).cast("long"), F.lit(300).cast("long"), F.lit(400).cast("long"),
        mixing._uniform(F.lit(1), F.col("id"))).alias("k")).toPandas().k.to_numpy()
    mean, var = 400 * .3, 400 * .3 * .7 * 600 / 999
    assert abs(got.mean() - mean) < 4 * (var / 4000) ** .5 and abs(got.var() / var - 1) < .1
    tiny = spark.range(50).select(mixing._hypergeometric(
        F.lit(5).cast("long"), F.lit(5).cast("long"), F.lit(3).cast("long"), F.lit(.3)).alias("k")).distinct().collect()
    assert [r.k for r in tiny] == [3]


def test_empty(spark):
    assert mixing.per_document(mixing.mix(docs(spark, []))).count() == 0
    none = mixing.per_document(mixing.mix(docs(spark, AWKWARD[:3]))).collect()
    assert len(none) == 3 and all(r.taken == 0 and r.target == 0 for r in none)
