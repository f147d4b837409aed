import numpy as np

from series_engine.llm import ann
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(axis=1))
        out[q] = sorted((v, i) for v, i in zip(d.tolist(), ids) if i != q)[:k]
    return out


def check(got, want, least):
    hit = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q in want if want[q]}
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, len(want[q]) + 1))
        assert [(r.score, r.vec_id) for r in rs] == sorted((r.score, r.vec_id) for r in rs)
        hit += len({r.vec_id for r in rs} & {i for _, i in want[q]})
        total += len(want[q])
    assert hit >= least * total, hit / max(total, 1)


def test_radii_cover_every_code():
    rng = np.random.default_rng(1)
    codes = ann.Codes(np.zeros(1), np.zeros((1, 64)), [16] * 4, 0)
    a, b = (rng.integers(0, 1 << 16, size=(400, 4)).astype(np.uint16) for _ in range(2))
    b[:200] = a[:200] ^ (1 << rng.integers(0, 16, size=(200, 4)).astype(np.uint16))
    d = ann.hamming(a, b).astype(int)
    for radius in range(0, 65):
        inside = d.sum(axis=2) <= radius
        assert (inside <= (d <= np.array(codes.radii(radius))).any(axis=2)).all()


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = table.collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64)
    for options in ({}, {"cell": 60, "query_cell": 3}):
        got = ann.search(table, "vec_id % 20 = 0", **options).collect()
        check(got, brute(ids, x, [i for i in ids if i % 20 == 0], 10), .9)


def test_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    rows = [(i, [float(v) for v in x[0 if i < 40 else i]], 0) for i in range(60)]
    bad = [(100, None, 0), (110, [0.0] * 5, 0), (120, [1.0, None, 1.0, 1.0, 1.0], 0), (130, [float("nan")] * 5, 0),
           (140, [float("inf"), 1.0, 1.0, 1.0, 1.0], 0), (150, [1.0], 0), (None, [1.0] * 5, 0), (0, rows[0][1], 0)]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "'x' AS _v", "1 AS score").repartition(3)
    want = brute(list(range(60)), np.array([r[1] for r in rows], dtype=np.float64), range(0, 60, 10), 10)
    got = ann.search(df, "vec_id % 10 = 0").collect()
    check(got, want, .9)
    first = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 10)
    assert [v for _, v, _ in first] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9] and {s for *_, s in first} == {0.0}


def test_few_rows(spark):
    assert ann.search(spark.createDataFrame([], SCHEMA), "vec_id % 10 = 0").count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)
    assert ann.search(one, "vec_id % 10 = 0").count() == 0
    three = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [1.0, 2.5], 0), (2, [-1.0, 0.0], 0)], SCHEMA)
    got = ann.search(three, "vec_id % 10 = 0").collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 1), (2, 2)]
