import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from series_engine.llm import more_queries, winnowing as W
from tests.llm.helpers import AWKWARD, DOC, clash, docs


def units(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text) if x]
    return [u for x in w for u in (list(x) if len(x) > W.LONG_RUN else [x])]


def brute(text, k=W.K, window=W.WINDOW):
    """{(position, hash)} with the definition's own loops."""
    c = [zlib.crc32(u.encode()) & W.CODE_MASK for u in units(text)]
    if not c:
        return set()
    grams = [c[i:i + k] for i in range(len(c) - k + 1)] or [c]
    hashes = []
    for g in grams:
        h = 0
        for x in g:
            h = (h * W.BASE + x) % W.PRIME
        hashes.append(h)
    out = set()
    for i in range(max(len(hashes) - window, 0) + 1):
        part = hashes[i:i + window]
        j = max(p for p, h in enumerate(part) if h == min(part))
        out.add((i + j, part[j]))
    return out


def like(a, b):
    x, y = {h for _, h in a}, {h for _, h in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def parse(s):
    return {tuple(map(int, p.split(":"))) for p in s.split()}


def check(spark, rows, shuffled=False):
    df = clash(docs(spark, rows) if shuffled else spark.createDataFrame(rows, DOC), "row", "own", "block", "numbers", "_o", "n_chars2")
    got = more_queries.fingerprint_columns(W.fingerprint_edits(df)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = Counter()
    for r, nxt in zip(order, order[1:] + order[:1]):
        t, u = r[1] or "", nxt[1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        a, b, c = brute(t), brute(e), brute(u)
        want[r[0], len(t), frozenset(a), frozenset(b), round(like(a, b), 9), round(like(a, c), 9)] += 1
    assert Counter((r.doc_id, r.n_chars, frozenset(parse(r.fingerprint)), frozenset(parse(r.edited_fingerprint)),
                    round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    return got


def test_awkward_rows_equal_brute_force(spark):
    long_run = "x" * 40 + " " + "漢字" * 60
    rows = AWKWARD + [(20 + i, " ".join(f"w{(i * j) % 7}" for j in range(n)), "en", "s", 0)
                      for i, n in enumerate((1, 3, 4, 5, 10, 11, 12, 13, 24, 60, 200))] + [(50, long_run, "zh", "s", 0), (51, long_run[:90], "zh", "s", 0)]
    check(spark, rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n漢\U0001F600", max_size=120), min_size=1, max_size=12))
def test_random_texts_equal_brute_force(spark, texts):
    check(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])


def test_equal_rows_and_a_hot_key(spark):
    rows = [(7, "same text " * 30, "en", "a", 0)] * 40 + [(None, None, None, None, None)] * 20 + [(9, "other words " * 20, "en", "a", 0)]
    got = check(spark, rows)
    assert len({r.fingerprint for r in got if r.doc_id == 7}) == 1


def test_rows_may_come_in_other_partitions_the_second_time(spark):
    check(spark, AWKWARD, shuffled=True)


def test_shared_passage_is_always_found(spark):
    passage = " ".join(f"p{i}" for i in range(W.K + W.WINDOW - 1))
    rows = [(i, " ".join(f"{i}x{j}" for j in range(i)) + " " + passage + " " + " ".join(f"{i}y{j}" for j in range(3 * i)), "en", "s", 0)
            for i in range(1, 12)]
    out = docs(spark, rows).select(F.transform(W.fingerprint(F.col("text")), lambda x: x["hash"]).alias("h")).collect()
    assert all(set(a.h) & set(b.h) for a in out for b in out)


def test_single_and_empty_tables(spark):
    assert more_queries.fingerprint_columns(W.fingerprint_edits(docs(spark, []))).count() == 0
    one = more_queries.fingerprint_columns(W.fingerprint_edits(docs(spark, [(1, "abcd", "", "", 0)]))).first()
    assert one.near_next == 1.0 and one.n_chars == 4 and one.edited_fingerprint != one.fingerprint
