import re
from collections import Counter

from series_engine.llm import quality
from tests.llm.helpers import AWKWARD, clash, docs


def brute(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    hit = {p for i, x in enumerate(tri) if n[x] > 1 for p in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_equal_brute_force(spark):
    rows = AWKWARD + [
        (10, "a b c a b c a b c x", "en", "s", 1),
        (11, "a b c d a b c e\n# x\n# x\n\n#  x", "en", "s", 1),
        (12, "a a a a", "en", "s", 1), (13, "a b", "en", "s", 1), (14, "a b c", "en", "s", 1),
    ]
    got = quality.ledger(clash(docs(spark, rows), "_t", "_w", "h", "n_words", "failure_bits")).collect()
    want = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter((r.doc_id, *[r[c] for c in COLS]) for r in got) == want


def test_empty_table(spark):
    assert quality.ledger(docs(spark, [])).count() == 0
    assert quality.ablation(quality.ledger(docs(spark, [])), "v2").count() == 0


def test_policies_and_ablation_read_bits_only(spark):
    words = " ".join(f"w{i}" for i in range(60))
    led = quality.ledger(docs(spark, [
        (1, words, "en", "s", 1), (2, words + " ###### ######", "en", "s", 1), (3, "short", "en", "s", 1),
        (4, "## ##", "en", "s", 1)])).select("doc_id", "failure_bits")
    kept = {p: {r[0] for r in led.where(quality.passes(p)).collect()} for p in quality.POLICIES}
    assert kept["base"] == {1, 2} and kept["v2"] == {1}
    ab = {r.rule: r for r in quality.ablation(led, "v2").collect()}
    assert ab["symbols"].failed == 2 and ab["symbols"].rejected_alone == 1 and ab["symbols"].kept_without == 2
    assert ab["few_words"].failed == 2 and ab["few_words"].rejected_alone == 1
