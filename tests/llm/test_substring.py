import hashlib
import random
import re
from collections import Counter

from series_engine.llm import substring
from tests.llm.helpers import AWKWARD, clash, docs


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0d]+", r[1] or "") for r in rows]
    n = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for r, w in zip(rows, words):
        gone = {p for i in range(len(w) - window + 1) if n[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def corpus(rng, n, vocabulary):
    rows = []
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(w), "en", "s", 0))
    rows += [(1000 + i, r[1], *r[2:]) for i, r in enumerate(rows[:5])]
    return rows


def test_lengths():
    assert substring.lengths(35, 9) == [9, 18, 35] and substring.lengths(4, 9) == [4] and substring.lengths(64, 9) == [8, 16, 32, 64]


def test_equal_brute_force(spark):
    rng = random.Random(9)
    for window, base, vocabulary in [(35, 9, [f"w{i}" for i in range(500)]), (6, 2, list("ab")), (5, 9, list("abc")), (12, 3, list("abcdefgh"))]:
        rows = [*AWKWARD[:-1], (7, "w " * 300, "en", "s", 0), *corpus(rng, 60, vocabulary)]
        got = substring.dedup_substrings(clash(docs(spark, rows), "_t", "_k1", "n_words"), window, base).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows, window)


def test_empty(spark):
    assert substring.dedup_substrings(docs(spark, [])).count() == 0
    got = substring.dedup_substrings(docs(spark)).collect()
    assert {r.doc_id: r.n_removed for r in got}[7] == 30000


def test_hashes_follow_the_words():
    words = ["é", "x" * 64, "x" * 65, "x" * 65 + "y", " ", "a b", "\x0e", "\x08", "\U0001F600", "ab", "ba", "x"]
    rng = random.Random(4)
    text = "".join(rng.choice(words) + rng.choice([" ", "\n", "\t\r", "\x0b\x0c "]) for _ in range(40_000))
    found = re.findall(substring.WORD, text)
    hashes = substring.hashed(text.encode()).tolist()
    assert text.encode().split() == [w.encode() for w in found] and len(hashes) == len(found) > 1 << 14
    assert len(dict(zip(found, hashes))) == len(set(hashes)) == len(set(zip(found, hashes))) == len(words)
    assert len(substring.hashed(b"")) == len(substring.hashed(b" \n")) == 0


def test_representatives_equal_brute_force():
    rng = random.Random(5)
    values = [rng.randrange(6) << 32 | rng.randrange(1 << 32) for _ in range(200)]
    for within in (1, 2, 3, 18, 27, 200):
        want = [min(range(p, p + within), key=lambda j: (values[j] >> 32, j)) for p in range(200 - within + 1)]
        assert substring.representatives(substring.np.array(values, dtype="uint64"), within).tolist() == want


def test_no_table_is_left(spark):
    substring.dedup_substrings(docs(spark)).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("substring_texts")]
