import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from series_engine.llm import packing
from tests.conftest import SF001
from tests.llm.helpers import AWKWARD, clash, docs

TOK = Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))


def ids(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_tokenizer_file(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(150).collect()]
    texts += ["", " ", "a\n\n  b\t", "it's we'll DON'T", "x<|endoftext|>y", "   z", "\U0001F600́", "q" * 5000, "  lead", "12345 67", "\x00\x1c"]
    assert all(packing.encoder()(t) == ids(t)[:-1] for t in texts)


def test_best_fill_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 15): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 40)
        used = packing.best_fill(counts, room)
        assert all(k <= counts[n] for n, k in used.items())
        sums = [sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])]
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def check_plan(counts, window):
    rows, n = packing.plan(counts, window)
    fill, seen = defaultdict(list), defaultdict(list)
    for cls, a, b, at, tokens, seq, off in rows:
        for k in range(a, b):
            fill[seq + k - a].append((off, tokens))
            seen[cls, k].append((at, tokens))
    assert len(seen) == sum(counts.values()) and sorted(fill) == list(range(n))
    for spans, size in [*((v, None) for v in fill.values()), *((v, k[0]) for k, v in seen.items())]:
        at = 0
        for a, length in sorted(spans):
            assert a == at and length > 0
            at += length
        assert at == size if size else at <= window
    short = [s for s in fill if sum(x for _, x in fill[s]) < window]
    assert len(short) <= 1


def test_plans_leave_slack_in_one_window_only():
    rng = random.Random(2)
    for _ in range(60):
        window = rng.choice([8, 32, 100])
        check_plan({rng.randint(1, window - 1): rng.choice([1, 2, 7, 50]) for _ in range(rng.randint(0, 20))}, window)
    check_plan({1500: 1000}, 2048)
    check_plan({2047: 3, 1: 1}, 2048)


def verify(rows, texts, window):
    want = defaultdict(list)
    for d, t in texts:
        want[d].append(ids(t))
    seqs, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        by_doc[r.uid].append(r)
    assert len(by_doc) == len(texts)
    for rs in by_doc.values():
        own = next(w for w in want[rs[0].doc_id] if all(zlib.crc32(np.array(w[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in rs))
        at = 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own)
            at += r.length
        assert at == len(own)
        want[rs[0].doc_id].remove(own)
    short = 0
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= window
        short += at < window
    assert short <= 1


def test_round_trip(spark):
    rows = AWKWARD + [(i, "word " * (i % 70), "en", "s", 0) for i in range(1000, 1200)] + [(7000, "<|endoftext|> x" * 9, "en", "s", 0)]
    got = packing.pack(clash(docs(spark, rows), "uid", "start", "_n"), window=64).collect()
    verify(got, [(r[0], r[1]) for r in rows], 64)


def test_all_of_one_length_are_cut(spark):
    rows = [(i, "word " * 40, "en", "s", 0) for i in range(200)]
    verify(packing.pack(docs(spark, rows), window=64).collect(), [(r[0], r[1]) for r in rows], 64)


def test_empty(spark):
    assert packing.pack(docs(spark, [])).count() == 0
