from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from series_engine.llm import minhash, mixing, packing, toxicity
from tests.conftest import SF0001
from tests.llm.helpers import AWKWARD, docs
from tests.llm.test_line_dedup import brute as dropped_lines
from tests.llm.test_minhash import sets_of
from tests.llm.test_packing import verify


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output on a small table with awkward rows."""
    sf, path = SF0001, tmp_path_factory.mktemp("stages")
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    df, out = df.unionByName(docs(spark, AWKWARD)), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, sf).write.parquet(f"{path}/{k}")
        got = spark.read.parquet(f"{path}/{k}")
        out.append((df, got))
        df = got
    return out


def bag(df, *cols):
    return Counter(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_columns(stages):
    assert all(a.columns == b.columns for a, b in stages[:-1])


def test_toxicity(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SF0001}/labels.parquet").where(~toxicity.held_out())
    scored = toxicity.score(before, toxicity.fit(before, labels)).where("predicted = 0")
    assert bag(after, "doc_id") == bag(scored, "doc_id") and not bag(after) - bag(before)


def test_line_dedup(stages):
    before, after = stages[1]
    rows = before.collect()
    drop = dropped_lines([r.text for r in rows], 10)
    want = Counter((r.doc_id, r.text and "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.text, i) not in drop)) for r in rows)
    assert bag(after, "doc_id", "text") == want


def test_near_duplicates(stages):
    before, after = stages[2]
    rows = [tuple(r) for r in before.collect()]
    sets, root = sets_of(rows, 5), list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and root[i] != root[j]:
                root = [root[j] if x == root[i] else x for x in root]
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root[i]].append(r)
    kept = bag(after)
    for g in groups.values():
        stay = sum((Counter([r]) & kept).total() for r in set(g))
        assert stay == 1 if sets[rows.index(g[0])] else stay == len(g)
        best = min(g, key=lambda r: (r[0] is None, r[0] or 0))
        assert kept[best] >= 1
    assert not kept - Counter(rows) and len(groups) == kept.total()


def test_mixing(stages):
    before, after = stages[3]
    size = lambda t: len(mixing_words(t))
    per = {(r.doc_id, r.source): r.taken for r in mixing.per_document(mixing.mix(before)).groupBy("doc_id", "source").agg(F.sum("taken").alias("taken")).collect()}
    got, own = Counter(), {}
    for r in before.collect():
        own.setdefault((r.doc_id, r.source), []).append(mixing_words(r.text))
    for r in after.collect():
        got[r.doc_id, r.source] += size(r.text)
        words = mixing_words(r.text)
        assert any(set(words) <= set(w) and len(words) <= len(w) for w in own[r.doc_id, r.source])
    assert all(got[k] == v for k, v in per.items())


def mixing_words(text):
    import re
    return [x for x in re.split(r"[\x20\x09-\x0d]+", text or "") if x]


def test_packing(stages):
    before, _ = stages[4]
    verify(packing.pack(before).collect(), [(r.doc_id, r.text) for r in before.collect()], 2048)


def test_run_and_empty(spark, stages):
    assert corpus_pipeline.run(spark, SF0001).columns == stages[-1][1].columns
    df = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF0001)
        assert df.count() == 0
        if "text" not in df.columns:
            break
    assert minhash.bands(.8)[0] > 1
