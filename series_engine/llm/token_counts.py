"""Token counts under a unigram model, shared over a trie of pre-tokens.

The distinct words of the texts are inserted in a trie.  A trie node stands
for a prefix, and the best score of splitting that prefix into pieces (the
Viterbi forward score) does not depend on what follows it: it is computed once
per node, from the nodes above it, however many words share the prefix.  The
words' terminal counts are stored, so a word seen again is one lookup.

The pieces and their order come from a public vocabulary file; nothing is
trained.  A piece of rank ``r`` scores ``-ln(r + 1)`` less a constant per
piece, a fixed rule that prefers few and frequent pieces.  A character that
the pieces cannot spell costs one token per UTF-8 byte.

Every task keeps one trie for the rows it reads and starts a new one when it
has ``max_nodes`` nodes, which changes memory and time but no count.

Defined results: NULL and empty texts count 0; repeated rows and NULL ids are
carried through; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import only

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: How the vocabulary marks the start of a word.
START = "▁"
#: Score of a piece besides its rank, and of a byte that stands for itself.
PIECE_COST = 1.0
BYTE_COST = 14.0


@cache
def piece_scores(path: str | None = None) -> dict[str, float]:
    """Score of every piece of a vocabulary file."""
    import sentencepiece
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p: -math.log(r + 1) - PIECE_COST for r, p in enumerate(names)}


class Pieces:
    """All pieces that end at a character, found by one step per character
    (the automaton of Aho and Corasick)."""

    def __init__(self, scores: dict[str, float]):
        self.step: dict[tuple[int, str], int] = {}
        own: list[tuple[int, float] | None] = [None]
        level: list[list[tuple[int, str, int]]] = []
        for piece, score in scores.items():
            state = 0
            for depth, ch in enumerate(piece):
                below = self.step.get((state, ch))
                if below is None:
                    below = self.step[state, ch] = len(own)
                    own.append(None)
                    if len(level) <= depth:
                        level.append([])
                    level[depth].append((state, ch, below))
                state = below
            own[state] = (len(piece), score)
        #: The state of the longest proper suffix, and the pieces ending in a state.
        self.back = [0] * len(own)
        self.ends: list[tuple[tuple[int, float], ...]] = [()] * len(own)
        for edges in level:
            for above, ch, state in edges:
                self.back[state] = self.next(self.back[above], ch) if above else 0
                mine = own[state]
                self.ends[state] = ((mine,) if mine else ()) + self.ends[self.back[state]]

    def next(self, state: int, ch: str) -> int:
        while (below := self.step.get((state, ch))) is None and state:
            state = self.back[state]
        return below or 0


@cache
def pieces(path: str | None = None) -> Pieces:
    return Pieces(piece_scores(path))


class Trie:
    """Prefixes with their forward score and token count."""

    def __init__(self, found: Pieces):
        self.pieces = found
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.state: list[int] = [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """The word's token count; only its new prefixes are scored."""
        child, best, tokens, state, ends = self.child, self.best, self.tokens, self.state, self.pieces.ends
        node, path = 0, [0]
        for at, ch in enumerate(START + word):
            below = child.get((node, ch))
            if below is None:
                here = self.pieces.next(state[node], ch)
                n = 1 if ch < "\x80" else len(ch.encode("utf-8", "surrogatepass"))
                top, count = best[node] - n * BYTE_COST, tokens[node] + n
                for length, score in ends[here]:
                    above = path[at + 1 - length]
                    total = best[above] + score
                    if total > top or total == top and tokens[above] + 1 < count:
                        top, count = total, tokens[above] + 1
                below = child[node, ch] = len(best)
                best.append(top)
                tokens.append(count)
                state.append(here)
            node = below
            path.append(node)
        self.terminal[word] = tokens[node]
        return tokens[node]


def _counted(batches: Iterator[pa.RecordBatch], path: str | None, max_nodes: int) -> Iterator[pa.RecordBatch]:
    trie = Trie(pieces(path))
    for b in batches:
        words, distinct, tokens, chars = [], [], [], []
        for text in b.column("_t").to_pylist():
            own = Counter(WORD.findall(text or ""))
            total = 0
            for w, k in own.items():
                n = trie.terminal.get(w)
                total += (trie.insert(w) if n is None else n) * k
            if len(trie.best) > max_nodes:
                trie = Trie(trie.pieces)
            words.append(own.total())
            distinct.append(len(own))
            tokens.append(total)
            chars.append(len(text or ""))
        yield pa.RecordBatch.from_arrays([b.column("_id"), *(pa.array(v, pa.int64()) for v in (words, distinct, tokens, chars))],
                                         names=["_id", "n_words", "n_distinct_words", "n_tokens", "n_chars"])


def count_tokens(docs: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None,
                 max_nodes: int = 600_000) -> DataFrame:
    """``id, n_words, n_distinct_words, n_tokens, n_chars`` of every document."""
    kind = dict(docs.dtypes)[id_col]
    t = only(docs, id_col, text).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_t"))
    return t.mapInArrow(lambda it: _counted(it, path, max_nodes),
                        f"_id {kind}, n_words long, n_distinct_words long, n_tokens long, n_chars long").withColumnRenamed("_id", id_col)
