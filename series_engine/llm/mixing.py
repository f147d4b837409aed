"""Mixing sources to target weights by a multivariate-hypergeometric
splitting tree.

Texts are cut into blocks of words.  Each source has an exact quota of block
draws that fills its target; the quota vector at the root of a binary tree is
split between the two halves of the output shards, as a random permutation of
all draws would split it, until every leaf is one shard with its own quota of
each source.  A shard then draws its interval of every source's permuted
blocks (the intervals are disjoint and cover the quota) and shuffles locally.
All of it is column expressions: the draws of the tree are inverse
distribution functions over hashed uniforms, so reruns agree.

Defined results: NULL text has size 0 and is taken 0 times; NULL is a source
of its own, after all others; a NULL or repeated ``doc_id`` is carried through
and every input row, also an identical one, is a document of its own; extra
columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, let, n_words, only, running, small, words

WEIGHTS = (3, 1, 2)
SEED = 20240229

_LN_FACT = [math.lgamma(i + 1) for i in range(32)]


def _ln_fact(n: Column) -> Column:
    """ln n!, exact to double precision: a table below 32, Stirling's series above."""
    def of(n: Column) -> Column:
        x = n.cast("double") + 1
        series = ((x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi)
                  + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x))
        return F.when(n < 32, F.get(F.array(*[F.lit(v) for v in _LN_FACT]), F.least(n, F.lit(31)).cast("int"))).otherwise(series)
    return let(n, of)


def _uniform(*seed: Column) -> Column:
    """A number in (0, 1) that depends on the arguments alone."""
    return (F.shiftrightunsigned(F.xxhash64(*seed), 11).cast("double") + 0.5) / float(1 << 53)


def _hypergeometric(total: Column, good: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` draws without replacement from ``total`` are among
    ``good``, at probability ``u``.  The distribution is summed over the
    interval that holds all but 1e-30 of it.  Every part is bound once: written
    out in place it would be an expression of many thousand nodes."""
    def share(v: Column) -> Column:
        part = v["good"] / F.greatest(v["total"], F.lit(1))
        mean = v["n"] * part
        return F.struct(mean.alias("mean"), F.sqrt(F.greatest(mean * (1 - part), F.lit(0.0))).alias("spread"))

    def interval(v: Column, m: Column) -> Column:
        low = F.greatest(F.lit(0), v["n"] - (v["total"] - v["good"]), F.floor(m["mean"] - 12 * m["spread"] - 24))
        high = F.least(v["good"], v["n"], F.ceil(m["mean"] + 12 * m["spread"] + 24))
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    def ln_p(v: Column, k: Column) -> Column:
        return -(_ln_fact(k) + _ln_fact(v["good"] - k) + _ln_fact(v["n"] - k) + _ln_fact(v["total"] - v["good"] - v["n"] + k))

    def pick(v: Column, b: Column, odds: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("k"))

        def below(goal: Column) -> Column:
            return F.aggregate(odds, start, lambda s, x: F.struct(
                (s["sum"] + x).alias("sum"), (s["k"] + F.when(s["sum"] + x < goal, 1).otherwise(0)).alias("k")))["k"]
        goal = v["u"] * F.aggregate(odds, F.lit(0.0), lambda s, x: s + x)
        return F.least(b["low"] + let(goal, below), b["high"])

    def draw(v: Column, b: Column) -> Column:
        mode = F.floor((v["n"] + 1) * (v["good"] + 1) / (v["total"] + 2)).cast("long")
        top = let(F.least(F.greatest(mode, b["low"]), b["high"]), lambda k: ln_p(v, k))
        odds = let(top, lambda t: F.transform(F.sequence(b["low"], b["high"]), lambda k: F.exp(ln_p(v, k) - t)))
        return F.when(b["low"] >= b["high"], b["low"]).otherwise(let(odds, lambda o: pick(v, b, o)))

    given = F.struct(total.alias("total"), good.alias("good"), n.alias("n"), u.alias("u"))
    return let(given, lambda v: let(let(share(v), lambda m: interval(v, m)), lambda b: draw(v, b)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source_no, source, source_size, target`` from rows of ``source, size``.

    Sources in code-point order (NULL last) weigh ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess goes to the others by weight, until none is above.
    Ordered by the ratio at which they reach their cap, sources are capped as
    a prefix, which two running sums find."""
    per = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    order = per.select(F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_name"), "source", "source_size")
    ranked = running(order, ["_null", "_name"], {}, "mix-ranks").withColumn(
        "weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_row") % len(weights)).cast("int")))
    ranked = cut(ranked.select(F.col("_row").alias("source_no"), "source", "source_size", "weight",
                               (most * F.col("source_size")).alias("cap"),
                               (most * F.col("source_size") / F.col("weight")).alias("ratio")), "mix-weights")
    total = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    budget, weight = share * (total.s or 0), total.w or 0
    filled = running(ranked, ["ratio", "source_no"], {"caps": "cap", "used": "weight"}, "mix-fill")
    filled = filled.withColumn("level", (F.lit(budget) - F.col("caps")) / (F.lit(weight) - F.col("used")))
    # the first source whose cap is above its level sets the level of all after it
    level = filled.where("ratio > level").agg(F.min_by("level", F.struct("ratio", "source_no")).alias("v")).first().v
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    return ranked.select("source_no", "source", "source_size", target.cast("double").alias("target"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text, text.isNull())


def blocks(docs: DataFrame, block_words: int, text: str = "text", id_col: str = "doc_id",
           source: str = "source") -> DataFrame:
    """Every document as blocks of at most ``block_words`` words; a document
    without words has one empty block.  Identical rows are told apart by
    ``copy``."""
    t = only(docs, id_col, text, source).select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"), _text_hash(F.col(text)).alias("text_hash"))
    t = t.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("_n"))
    t = t.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
    last = F.greatest(F.ceil(F.col("size") / block_words) - 1, F.lit(0))
    return (t.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
            .withColumn("start", F.col("block") * block_words)
            .withColumn("length", F.least(F.col("size") - F.col("start"), F.lit(block_words).cast("long"))))


def shard_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``shard, source_no, first, quota`` from ``source_no, quota``: the leaves
    of the splitting tree, one interval of every source's draws per shard.

    A tree node is one row with one number per source; a level of the tree is
    a narrow projection of the level above."""
    root = (quotas.agg(F.sort_array(F.collect_list(F.struct("source_no", "quota"))).alias("_q"))
            .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"),
                    F.transform("_q", lambda x: x["source_no"]).alias("sources"),
                    F.transform("_q", lambda x: x["quota"]).alias("quota"),
                    F.transform("_q", lambda x: F.lit(0).cast("long")).alias("first")))
    root = root.withColumn("all", F.aggregate("quota", F.lit(0).cast("long"), lambda s, x: s + x))

    def upto(shard: Column) -> Column:  # draws of the shards before this one
        return F.floor(shard * (F.col("all") / F.lit(float(shards)))).cast("long")

    nodes = root
    for depth in range(max(0, math.ceil(math.log2(max(shards, 1))))):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        nodes = nodes.withColumn("mid", F.when(F.col("hi") - F.col("lo") > 1, mid).otherwise(F.col("hi")))
        own = F.aggregate("quota", F.lit(0).cast("long"), lambda s, x: s + x)
        state = F.struct(own.alias("total"),
                         F.when(F.col("mid") == F.col("hi"), own).otherwise(upto(F.col("mid")) - upto(F.col("lo"))).alias("n"),
                         F.array().cast("array<long>").alias("out"))

        def draw(s: Column, x: Column) -> Column:
            u = _uniform(F.lit(seed), F.lit(depth), F.col("lo"), F.size(s["out"]))
            return let(_hypergeometric(s["total"], x, s["n"], u), lambda k: F.struct(
                (s["total"] - x).alias("total"), (s["n"] - k).alias("n"), F.array_append(s["out"], k).alias("out")))

        nodes = nodes.withColumn("left", F.aggregate("quota", state, draw)["out"])
        halves = F.array(
            F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quota"), F.col("first")),
            F.struct(F.col("mid").alias("lo"), F.col("hi"),
                     F.zip_with("quota", "left", lambda q, a: q - a).alias("quota"),
                     F.zip_with("first", "left", lambda f, a: f + a).alias("first")))
        nodes = (nodes.select("sources", "all", F.explode(halves).alias("_n"))
                 .select("sources", "all", "_n.lo", "_n.hi", "_n.quota", "_n.first").where("hi > lo"))
        if depth % 4 == 3:
            nodes = cut(nodes, "mix-tree")
    parts = F.arrays_zip("sources", "first", "quota")
    return (nodes.select(F.col("lo").alias("shard"), F.explode(parts).alias("_x"))
            .select("shard", F.col("_x.sources").alias("source_no"), F.col("_x.first").alias("first"), F.col("_x.quota").alias("quota"))
            .where("quota > 0"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        block_words: int = 1024, shard_blocks: int = 4096, seed: int = SEED, text: str = "text",
        id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix, one row per block and epoch: ``doc_id, source, size, text_hash,
    copy, block, start, epoch, taken, shard, position`` with the source's
    ``source_size`` and ``target``.

    ``taken`` words from ``start`` on are output ``position`` of ``shard``.
    Blocks that are not drawn have ``taken`` 0 and no shard, so every document
    is there.  A source's epochs pass over its blocks in one fixed random
    order; its last draw is cut so that its words add up to its target."""
    pieces = cut(blocks(docs, block_words, text, id_col, source), "mix-blocks")
    targets = cut(source_targets(pieces.select("source", F.col("length").alias("size")), weights, share, most), "mix-targets")
    keyed = pieces.join(small(targets), pieces["source"].eqNullSafe(targets["source"])).select(
        pieces["*"], "source_no", "source_size", "target")
    order = ["source_no", "_order", "doc_id", "text_hash", "copy", "block"]
    keyed = keyed.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "text_hash", "copy", "block"))
    keyed = keyed.withColumn("_full", F.when(F.col("length") > 0, 1).otherwise(0))
    placed = cut(running(keyed, order, {"_words": "length", "_blocks": "_full"}, "mix-order").drop("_row"), "mix-placed")
    # words and blocks before a source's own
    base = placed.groupBy("source_no").agg(F.min("_words").alias("_w0"), F.min("_blocks").alias("_b0"),
                                           F.sum("_full").alias("_n"), F.first("source_size").alias("_s"),
                                           F.first("target").alias("_t"))
    base = base.withColumn("_goal", F.round("_t").cast("long")).withColumn(
        "_whole", F.when(F.col("_s") > 0, F.floor(F.col("_goal") / F.col("_s"))).otherwise(0).cast("long")).withColumn(
        "_rest", F.col("_goal") - F.col("_whole") * F.col("_s"))
    base = small(cut(base.drop("_s", "_t", "_goal"), "mix-base"))
    draws = (placed.join(base, "source_no")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_whole"))))
             .withColumn("_at", F.col("_words") - F.col("_w0"))
             .withColumn("taken", F.when(F.col("epoch") < F.col("_whole"), F.col("length")).otherwise(
                 F.greatest(F.lit(0), F.least(F.col("length"), F.col("_rest") - F.col("_at")))).cast("long"))
             .withColumn("_draw", F.when(F.col("taken") > 0, F.col("epoch") * F.col("_n") + F.col("_blocks") - F.col("_b0"))))
    quotas = cut(draws.where("taken > 0").groupBy("source_no").agg(F.count("*").alias("quota")), "mix-quotas")
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    if total:
        shards = math.ceil(total / shard_blocks)
        leaves = cut(shard_quotas(quotas, shards, seed), "mix-shards")
    else:
        leaves = quotas.select(F.lit(0).cast("long").alias("shard"), "source_no", F.lit(0).cast("long").alias("first"), "quota")
    # intervals meet draws in strips of one length, so no source is one key
    strip = shard_blocks
    spans = leaves.withColumn("_strip", F.explode(F.sequence(
        F.floor(F.col("first") / strip), F.floor((F.col("first") + F.col("quota") - 1) / strip))))
    a, b = draws.withColumn("_strip", F.floor(F.col("_draw") / strip)).alias("a"), small(spans).alias("b")
    dealt = a.join(b, (F.col("a.source_no") == F.col("b.source_no")) & (F.col("a._strip") == F.col("b._strip"))
                   & (F.col("_draw") >= F.col("first")) & (F.col("_draw") < F.col("first") + F.col("quota")), "left")
    dealt = dealt.select("doc_id", "source", "size", "text_hash", "copy", "block", "start", "length", "epoch", "taken",
                         "source_size", "target", "shard")
    # a shard has a fixed number of blocks; those not drawn are spread by their hash
    spread = F.xxhash64(F.lit(seed), F.lit("local"), "doc_id", "text_hash", "copy", "block", "epoch")
    local = Window.partitionBy("shard", F.when(F.col("shard").isNull(), F.pmod(spread, F.lit(1 << 20)))).orderBy(
        spread, "doc_id", "text_hash", "copy", "block", "epoch")
    return dealt.withColumn("position", F.when(F.col("shard").isNotNull(), F.row_number().over(local) - 1))


def per_document(mixed: DataFrame) -> DataFrame:
    """One row per document: what the mix takes of it, and where."""
    return mixed.groupBy("doc_id", "source", "size", "text_hash", "copy").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("taken").alias("taken"), F.count("shard").alias("n_draws"), F.min("shard").alias("first_shard"),
        F.min_by("position", F.struct("shard", "position")).alias("first_position")).drop("copy")


def mixed_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix as documents: a row for every document and epoch with the words
    that the mix takes of it, other columns as they are.  A document that is
    taken whole keeps its text unchanged."""
    mixed = cut(mix(docs, text=text, id_col=id_col, source=source, **options).where("taken > 0"), "mix-drawn")
    parts = mixed.groupBy("doc_id", "source", "text_hash", "copy", "epoch").agg(
        F.max("size").alias("_size"), F.sum("taken").alias("_taken"),
        F.sort_array(F.collect_list(F.struct("start", "taken"))).alias("_parts"))
    key = [F.col(f"`{id_col}`").alias("_id"), F.col(f"`{source}`").alias("_src"), _text_hash(F.col(f"`{text}`")).alias("_hash")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *key)
    rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_id", "_src", "_hash").orderBy("_hash")) - 1)
    both = rows.join(parts, rows["_id"].eqNullSafe(parts["doc_id"]) & rows["_src"].eqNullSafe(parts["source"])
                     & (rows["_hash"] == parts["text_hash"]) & (rows["_copy"] == parts["copy"]))
    own = F.col("_row").getField(text)
    some = F.array_join(F.flatten(F.transform("_parts", lambda p: F.slice(words(own), (p["start"] + 1).cast("int"), p["taken"].cast("int")))), " ")
    both = both.withColumn("_new", F.when(F.col("_taken") == F.col("_size"), own).otherwise(some))
    return both.select(*[F.col("_new").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns])
