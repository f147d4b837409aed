"""Toxicity by maximum-scoring segments of token log-odds.

*Tokens.*  A unit is a lower-cased word without edge punctuation, or one of
its prefixes, so that inflected and compound forms share evidence.  Its score
is the log-odds ratio between toxic and clean labelled documents under a
Dirichlet prior, lowered by a multiple of its standard error: rare units get
no say.  Prefixes stand for words too rare for a score of their
own and are counted over these alone, so a word does not inherit a prefix that
it shares with a common toxic one.  A word scores as its longest known unit; a
word without a positive score gets a small constant below zero.

*Segments.*  All maximal scoring segments of a text are found in one linear
scan (Ruzzo and Tompa 1999).

*Calibration.*  In clean text the number of segments scoring ``s`` or more is
about ``K n exp(-lambda s)`` for ``n`` words (Karlin and Altschul); lambda
solves ``sum p(s) exp(lambda s) = 1`` over the clean score distribution.  A
document's evidence is the summed significance of its segments, and a logistic
curve over its logarithm, fitted on labelled documents that the unit scores
have not seen, maps it to a probability.

The model is fitted on at most ``max_train`` labelled documents, whose
words bound its units: none is cut off; scoring covers every document and whole texts.
Labelled copies and near-copies of one class, confirmed by four fifths of their
three-word shingles, are one witness; documents that merely share a passage are
all learned from.

Defined results: NULL or empty text has no evidence and gets the score of
that; NULL ids are scored and never used to learn; of several labels of one
document the largest counts; without labels of both classes every score is 0;
repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, only
from series_engine.llm.components import components
from series_engine.llm.line_dedup import near_pairs, shingles
from series_engine.session import short_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = string.punctuation + "«»“”„‘’¿¡…—–"
PREFIXES = (7, 6, 5, 4, 3)
#: Words remembered with their score in one task; forgetting changes no result.
_CACHE = 500_000
#: Words counted in one task before their sums go on.
_COUNTS = 100_000


@dataclass
class Model:
    """Unit scores, the clean word's score, and the calibration constants."""
    units: dict[str, float]
    clean: float = -0.2
    lam: float = 1.0
    k: float = 1.0
    bias: float = -math.inf
    slope: float = 0.0


def units(word: str) -> list[str]:
    """The word itself, marked as whole, and its prefixes, longest first."""
    bare = word.lower().strip(_EDGE)
    return [f"={bare}", *[bare[:n] for n in PREFIXES if len(bare) >= n]] if bare else []


def segments(at: list[int], score: list[float], clean: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first, last)`` of a text whose
    words at positions ``at`` score ``score`` > 0 and all others ``clean`` < 0."""
    found: list[list] = []  # [left sum, right sum, first, last]
    total, before = 0.0, 0
    for p, s in zip(at, score, strict=True):
        total += clean * (p - before)
        left, right, first = total, total + s, p
        total, before = right, p + 1
        # join with the nearest earlier segment that starts lower and ends lower
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= right:
                found.append([left, right, first, p])
                break
            left, first = found[j][0], found[j][2]
            del found[j:]
    return [(r - lft, a, b) for lft, r, a, b in found]


def evidence(found: list[tuple[float, int, int]], n: int, m: Model) -> float:
    """Summed significance of a text's segments, in nats."""
    return sum(max(0.0, m.lam * s - math.log(m.k * n)) for s, _, _ in found) if n else 0.0


def probability(x: float, m: Model) -> float:
    z = m.bias + m.slope * math.log1p(x)
    return 0.0 if z < -700 else 1 / (1 + math.exp(-z))


def _scan(text: str | None, m: Model, cache: dict) -> tuple[list[tuple[float, int, int]], int]:
    ws = WORD.findall(text or "")
    at, score = [], []
    for i, w in enumerate(ws):
        s = cache.get(w)
        if s is None:
            if len(cache) >= _CACHE:
                cache.clear()
            s = cache[w] = next((m.units[u] for u in units(w) if u in m.units), 0.0)
        if s > 0:
            at.append(i)
            score.append(s)
    return segments(at, score, m.clean), len(ws)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class and fold that hold a word; summed over the
    batches that ``_COUNTS`` of them last for."""
    seen: Counter = Counter()

    def summed() -> pd.DataFrame:
        return pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["unit", "label", "held", "n"])

    for b in batches:
        for text, label, held in zip(b["text"], b["label"], b["held"], strict=True):
            own = {units(w)[0] for w in set(WORD.findall(text or "")) if units(w)}
            seen.update((u, int(label), int(held)) for u in own)
            seen["", int(label), int(held)] += 1  # the number of documents
        if len(seen) >= _COUNTS:
            yield summed()
            seen.clear()
    if seen:
        yield summed()


def _log_odds(a: str, b: str, total_a: float, total_b: float, prior: float, lower: float):
    """Lower bound of the log-odds ratio with a Dirichlet prior (Monroe et al.
    2008): the prior is the unit's share of all documents plus a half."""
    share = (F.col(a) + F.col(b)) / (total_a + total_b)
    pa, pb = F.col(a) + prior * share + 0.5, F.col(b) + prior * share + 0.5
    rest_a, rest_b = F.greatest(total_a + prior + 1 - pa, F.lit(0.5)), F.greatest(total_b + prior + 1 - pb, F.lit(0.5))
    return F.ln(pa / rest_a) - F.ln(pb / rest_b) - lower * F.sqrt(1 / pa + 1 / pb)


def _surprise(a: str, b: str, total_a: float, total_b: float):
    """Nats against so many toxic documents among a unit's documents (Chernoff's
    bound on the binomial tail); 0 where they are no more than their share."""
    n, q = F.col(a) + F.col(b), total_a / (total_a + total_b)
    part = lambda x, p: F.when(x > 0, x * F.ln(x / (n * p))).otherwise(0.0)
    return F.when(F.col(a) > n * q, part(F.col(a), q) + part(F.col(b), 1 - q)).otherwise(0.0)


def labelled(docs: DataFrame, labels: DataFrame, max_train: int, text: str, id_col: str, label: str, copies: float = 0.8) -> DataFrame:
    """``text, label, held`` of a bounded, reproducible sample of labelled
    documents, one of each family of near-copies of a class; a third is held
    back from the unit scores for calibration."""
    own = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").alias("label"))
           .where("_id IS NOT NULL AND label IN (0, 1)").groupBy("_id").agg(F.max("label").alias("label")))
    own = own.orderBy(F.xxhash64(F.lit("train"), "_id"), "_id").limit(max_train)  # two short numbers a row
    pages = only(docs, id_col, text).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    held = F.when(F.pmod(F.xxhash64(F.lit("held"), "_id"), F.lit(3)) == 0, 1).otherwise(0)
    rows = pages.join(F.broadcast(own), "_id").select("_id", "text", F.col("label").cast("int").alias("label"), held.alias("held"))
    # near-copies are one witness: candidates by sketch, confirmed by their full shingle sets
    rows = cut(rows.withColumn("_k1", F.xxhash64("text")), "toxic-labelled")
    pairs = cut(near_pairs(rows, "text", rows, copies - 0.2), "toxic-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("_k1")).distinct()
    sets = rows.join(nodes, "_k1", "left_semi").dropDuplicates(["_k1"]).select("_k1", shingles(F.col("text")).alias("_s"))
    pairs = pairs.join(sets.withColumnsRenamed({"_k1": "a", "_s": "_x"}), "a").join(sets.withColumnsRenamed({"_k1": "b", "_s": "_y"}), "b")
    links = pairs.where(F.size(F.array_intersect("_x", "_y")) >= copies * F.size(F.array_union("_x", "_y"))).select("a", "b")
    rows = rows.join(components(links).withColumnsRenamed({"node": "_k1", "component": "_family"}), "_k1", "left")
    first = Window.partitionBy(F.coalesce("_family", "_k1"), "label").orderBy("_id", "_k1")
    rows = rows.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    return rows.select("text", "label", "held")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 50_000, prior: float = 10.0,
        lower: float = 1.64, least: float = 1.0, support: int = 5, clean: float = -0.2, text: str = "text",
        id_col: str = "doc_id", label: str = "toxic") -> Model:
    """Learn unit scores and calibration from labelled documents.  A unit
    counts if its lowered log-odds reach ``least`` and fewer than one of all
    units would lean as far to the toxic documents by chance."""
    short_batches(docs.sparkSession)
    train = cut(labelled(docs, labels, max_train, text, id_col, label), "toxic-train")
    counts = train.mapInPandas(_word_counts, "unit string, label int, held int, n long")
    flag = {(y, h): F.sum(F.when((F.col("label") == y) & (F.col("held") == h), F.col("n")).otherwise(0)) for y in (0, 1) for h in (0, 1)}
    table = cut(counts.groupBy("unit").agg(*[e.alias(f"n{y}{h}") for (y, h), e in flag.items()]), "toxic-counts")
    # prefixes stand for the words that are too rare to have a score of their own
    rare = table.where(f"unit <> '' AND n00 + n01 + n10 + n11 < {support}").withColumn("bare", F.substring("unit", 2, 1 << 20))
    heads = rare.withColumn("unit", F.explode(F.array(*[F.when(F.length("bare") >= n, F.substring("bare", 1, n)) for n in PREFIXES])))
    heads = heads.where("unit IS NOT NULL").groupBy("unit").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")])
    table = table.unionByName(heads.select(table.columns))
    table = table.select("unit", "n00", "n10", (F.col("n00") + F.col("n01")).alias("n0"), (F.col("n10") + F.col("n11")).alias("n1"))
    table = cut(table.where(f"unit = '' OR n0 + n1 >= {support}"), "toxic-units")
    size = table.where("unit = ''").first()
    if size is None or not (size.n00 and size.n10):
        return Model({}, clean)
    some = _log_odds("n10", "n00", size.n10, size.n00, prior, lower)
    full = _log_odds("n1", "n0", size.n1, size.n0, prior, lower)
    known = table.where("unit <> ''")
    tested = math.log(max(known.count(), 2))
    some = F.when(_surprise("n10", "n00", size.n10, size.n00) >= tested, some).otherwise(0.0)
    full = F.when(_surprise("n1", "n0", size.n1, size.n0) >= tested, full).otherwise(0.0)
    known = known.select("unit", some.alias("some"), full.alias("full"))
    toxic = F.greatest("some", "full") >= least
    found = known.where(toxic).collect()  # some of the words of max_train documents
    # clean units that continue a toxic prefix stand before it
    stems = [r.unit for r in found if not r.unit.startswith("=")]
    bare = F.regexp_replace("unit", "^=", "")
    heads = known.where(~toxic).select("unit", F.explode(F.array(*[F.substring(bare, 1, n) for n in PREFIXES])).alias("stem"))
    stems = docs.sparkSession.createDataFrame([(u,) for u in stems], "stem string")
    shadows = heads.join(F.broadcast(stems), "stem").select("unit").distinct().collect()  # also such words
    clean_units = {r.unit: 0.0 for r in shadows}
    m = Model(clean_units | {r.unit: r.some if r.some >= least else 0.0 for r in found}, clean)
    _calibrate(m, train.where("held = 1"))
    m.units = clean_units | {r.unit: r.full if r.full >= least else 0.0 for r in found}
    return m


def _calibrate(m: Model, held: DataFrame) -> None:
    """Set lambda, K and the logistic curve from the held-back documents."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, float] = {}
        for b in batches:
            found = [_scan(t, m, cache) for t in b["text"]]
            yield pd.DataFrame({"label": b["label"], "n": [n for _, n in found], "scores": [[s for s, _, _ in f] for f, _ in found]})

    rows = held.mapInPandas(scan, "label int, n long, scores array<double>").toPandas()  # at most a third of max_train
    clean = rows[rows.label == 0]
    words = float(clean.n.sum()) + 1
    scores = np.array([s for f in clean.scores for s in f] + [max(m.units.values(), default=0.0) or 1.0])  # one more, for what was not seen
    m.k = max((len(scores) - 0.5) / words, 1e-12)

    def excess(lam: float) -> float:
        return float(np.exp(np.minimum(lam * scores, 700)).sum()) / words + math.exp(lam * m.clean) * max(0.0, 1 - len(scores) / words) - 1

    low, high = 1e-6, 60.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    m.lam = max(low, 1e-3)
    x = np.array([evidence([(s, 0, 0) for s in f], int(n), m) for f, n in zip(rows.scores, rows.n, strict=True)])
    y = rows.label.to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        m.bias, m.slope = -4.0, 1.0
        return
    # logistic regression on the logarithm, Newton steps with a light ridge
    design, w = np.column_stack([np.ones_like(x), np.log1p(x)]), np.zeros(2)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    m.bias, m.slope = float(w[0]), max(float(w[1]), 0.0)


def score(docs: DataFrame, m: Model, threshold: float = 0.7, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, score, predicted`` of every document, with its number of
    segments and the words of its best one."""
    short_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(m)  # some of the words of max_train documents
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, cache = model.value, {}
        for b in batches:
            out = []
            for t in b["text"]:
                found, n = _scan(t, own, cache)
                p = probability(evidence(found, n, own), own)
                top = max(found, default=(0.0, -1, -1))
                out.append((p, int(p >= threshold), len(found), top[1], top[2]))
            done = pd.DataFrame(out, columns=["score", "predicted", "n_segments", "first_word", "last_word"])
            done.insert(0, "id", b["id"].to_numpy())
            yield done

    pages = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # NULL ids would turn a pandas column of numbers into floats: ids travel as text
    return (pages.withColumn("id", F.col("id").cast("string"))
            .mapInPandas(run, "id string, score double, predicted int, n_segments int, first_word int, last_word int")
            .withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col))


def reject(docs: DataFrame, m: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The documents, all columns as they are, that score below the threshold."""
    short_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(m)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = model.value, {}
        for b in batches:
            fine = [probability(evidence(*_scan(t, own, cache), own), own) < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """True for the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Fit on the labels outside the held-out third and score every document."""
    m = fit(docs, labels.where(~held_out()))
    return score(docs, m, threshold).withColumn("held_out", held_out())
