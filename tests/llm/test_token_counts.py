import random
from collections import Counter

from series_engine.llm import token_counts as tc
from tests.llm.helpers import AWKWARD, clash, docs


def viterbi(word, scores, longest):
    """Forward scores of one word alone."""
    w = tc.START + word
    best = [(0.0, 0)]
    for end in range(1, len(w) + 1):
        n = len(w[end - 1].encode())
        options = [(best[end - 1][0] - n * tc.BYTE_COST, best[end - 1][1] + n)]
        for start in range(max(0, end - longest), end):
            if w[start:end] in scores:
                options.append((best[start][0] + scores[w[start:end]], best[start][1] + 1))
        best.append(max(options, key=lambda x: (x[0], -x[1])))
    return best[-1][1]


def test_trie_equals_one_word_at_a_time():
    scores = tc.piece_scores()
    longest = max(map(len, scores))
    rng = random.Random(6)
    words = ["the", "thereof", "there", "éü", "\U0001F600x", "a" * 300, *("".join(rng.choices(["th", "ing", "er", "ö", "7"], k=rng.randint(1, 9))) for _ in range(400))]
    trie = tc.Trie(tc.pieces())
    assert [trie.insert(w) for w in words] == [viterbi(w, scores, longest) for w in words]
    assert [trie.insert(w) for w in words] == [viterbi(w, scores, longest) for w in words]  # nothing grows twice
    assert viterbi("the", scores, longest) == 1


def test_documents(spark):
    scores = tc.piece_scores()
    longest = max(map(len, scores))
    rows = [*AWKWARD, (9, "\x00nul the \x85 nel\x1cfs", "en", "s", 0)]
    want = Counter()
    for i, t, *_ in rows:
        ws = tc.WORD.findall(t or "")
        want[i, len(ws), len(set(ws)), sum(viterbi(w, scores, longest) for w in ws), len(t or "")] += 1
    for nodes in (5, 300_000):
        got = tc.count_tokens(clash(docs(spark, rows), "_id", "_t", "n_tokens"), max_nodes=nodes).collect()
        assert Counter(tuple(r) for r in got) == want
    assert tc.count_tokens(docs(spark, [])).count() == 0
