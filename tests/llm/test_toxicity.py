import itertools
import random

from pyspark.sql import functions as F

from series_engine.llm import toxicity as tox
from tests.llm.helpers import AWKWARD, clash, docs


SF01 = "/root/testdata/sf0.1"


def brute_segments(s):
    """Maximal scoring segments by their recursive definition."""
    def best(lo, hi):
        top = None
        for a, b in itertools.combinations(range(lo, hi + 1), 2):
            v = sum(s[a:b])
            if v > 1e-9 and (top is None or v > top[0] + 1e-9 or abs(v - top[0]) <= 1e-9 and (b - a) < top[2] - top[1]):
                top = (v, a, b)
        return [] if top is None else [*best(lo, top[1]), top, *best(top[2], hi)]
    return [(round(v, 6), a, b - 1) for v, a, b in best(0, len(s))]


def test_segments_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        s = [round(rng.uniform(.1, 3), 3) if rng.random() < .4 else -.7 for _ in range(rng.randint(0, 14))]
        at = [i for i, x in enumerate(s) if x > 0]
        got = tox.segments(at, [s[i] for i in at], -.7)
        assert [(round(v, 6), a, b) for v, a, b in got] == brute_segments(s), s


def test_held_out_accuracy_and_bounds(spark):
    # 1,344 held-out documents; fewer would say little
    d, lab = spark.read.parquet(f"{SF01}/documents.parquet").repartition(8), spark.read.parquet(f"{SF01}/labels.parquet")
    got = tox.score_documents(d, lab).cache()
    assert got.count() == d.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    test = got.where("held_out").join(lab, "doc_id").collect()
    hit = sum(r.predicted for r in test if r.toxic == 1)
    wrong = sum(r.predicted for r in test if r.toxic == 0)
    assert hit >= .88 * sum(r.toxic for r in test) and wrong <= .01 * len(test)
    # labels of the held-out third change nothing
    flip = lab.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in tox.score_documents(d, flip).collect()}
    assert all(again[r.doc_id] == r.score for r in got.collect())


def test_awkward_rows(spark):
    lab = spark.createDataFrame([(100 + i, 1, i % 2) for i in range(200)] + [(None, 1, 1), (100, 0, None)], "doc_id long, quality int, toxic int")
    rows = [*AWKWARD, *[(100 + i, f"plain words number{i} here " + ("nastyword" if i % 2 else "kindword"), "en", "s", 0) for i in range(200)]]
    got = {}
    for r in tox.score_documents(clash(docs(spark, rows), "id", "score", "label"), lab).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and got[5][0].score == got[5][1].score
    assert not got[None][0].held_out and got[101][0].score > got[100][0].score
    assert got[1][0].score == got[2][0].score < .5
    assert tox.score_documents(docs(spark, []), lab).count() == 0
    none = tox.score_documents(docs(spark), lab.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}


def test_few_short_labelled_documents(spark):
    lab = spark.createDataFrame([(100 + i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (100, 0, None)], "doc_id long, quality int, toxic int")
    rows = [*AWKWARD, *[(100 + i, f"plain words number{i} here " + ("nastyword" if i % 2 else "kindword"), "en", "s", 0) for i in range(40)]]
    got = {r.doc_id: r for r in tox.score_documents(docs(spark, rows), lab).collect()}
    assert got[101].score > got[100].score and got[1].score < .5


def test_only_confirmed_near_copies_are_one_witness(spark):
    """Documents that share a passage are all learned from; copies and near-copies once a class."""
    passage = " ".join(f"shared{k}" for k in range(20))
    own = [f"{passage} " + " ".join(f"w{i}x{k}" for k in range(6 + i)) for i in range(40)]
    near = [" ".join([*(f"copy{k}" for k in range(60)), f"end{i}"]) for i in range(10)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*own, *near, near[0]])]
    lab = spark.createDataFrame([(i, i % 2) for i in range(len(rows))], "doc_id long, toxic int")
    got = sorted((r.text, r.label) for r in tox.labelled(docs(spark, rows), lab, 1000, "text", "doc_id", "toxic").collect())
    assert [x for x in got if x[0].startswith("shared")] == sorted((t, i % 2) for i, t in enumerate(own))
    assert [x for x in got if x[0].startswith("copy")] == [(near[0], 0), (near[1], 1)]


def test_words_are_summed_over_short_batches():
    import pandas as pd
    from series_engine.llm import toxicity
    batch = pd.DataFrame({"text": ["one two"], "label": [1], "held": [0]})
    found = list(toxicity._word_counts(iter([batch] * 50)))
    assert len(found) == 1 and set(found[0].itertuples(index=False, name=None)) == {("=one", 1, 0, 50), ("=two", 1, 0, 50), ("", 1, 0, 50)}
