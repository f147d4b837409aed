"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger row holds the
measurements and one failure bit per rule.  A *policy* is a versioned mask of
rules: applying one, comparing two, or asking what would be kept without a
rule reads the bits and never the text again.  Everything is a column
expression: no Python runs on the executors and nothing is shuffled but the
counts per distinct bit pattern.

Defined results: NULL text counts as empty; a NULL or repeated ``doc_id`` is
carried through, one ledger row per input row; an empty table gives an empty
ledger; extra columns are ignored.  Words are compared by 64-bit hashes inside
one text when repeated windows are searched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import BLANK_CLASS, count_chars, has_word, let, only, text_or_empty, words

SYMBOLS = "#*$%&|<>"  # as a character class too


def repeated_words(ws: Column, window: int = 3) -> Column:
    """Words covered by a window of ``window`` words that occurs twice or more
    in the array (every occurrence counts, a word counts once).

    Windows are compared as hashes; texts without a repeat stop after the
    distinct count, the others sort (hash, position) pairs: O(n log n) at any
    length."""
    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: let(
            F.sort_array(F.transform(
                F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])),
                lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda a, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - a, F.lit(window)))),
                F.lit(0), lambda s, x: s + x)))

    def of(hashed: Column) -> Column:
        windows = F.transform(F.slice(hashed, 1, F.size(hashed) - (window - 1)),
                              lambda h, i: F.xxhash64(h, *[F.get(hashed, i + k) for k in range(1, window)]))
        return let(windows, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) <= window, F.lit(0)).otherwise(let(hashed, of)).cast("long")


def measure(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of measurements per document."""
    t = only(docs, id_col, text).select(F.col(id_col), text_or_empty(text).alias("_t"))
    lines = F.filter(F.split(F.col("_t"), "\n", -1), has_word)
    t = t.select(id_col, "_t", words(F.col("_t")).alias("_w"), lines.alias("_lines"))
    return t.select(
        id_col,
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - count_chars(F.col("_t"), BLANK_CLASS)).alias("word_chars"),
        count_chars(F.col("_t"), SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        count_chars(F.col("_t"), "A-Z").alias("n_upper"))


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements."""
    name: str
    fails: str


#: Bit i of the ledger belongs to rule i.  Rules are appended, never
#: reordered: stored bits stay readable.
RULES: tuple[Rule, ...] = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)

#: Versioned policies: a document is rejected when any of the named rules fails.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "shouting"),
    "v2": ("few_words", "repeated_windows", "symbols", "shouting", "duplicate_lines", "word_length"),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of the named rules."""
    index = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << index[n] for n in set(names))


def ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measurements and ``failure_bits`` (bit i set: rule i fails) per document."""
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text, id_col).withColumn("failure_bits", bits)


def passes(policy: str, bits: str = "failure_bits", rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy], rules)).cast("long")) == 0


def ablation(led: DataFrame, policy: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: documents it fails, documents it alone
    rejects, and documents kept without it.

    Rows are first summed per distinct bit pattern (at most 2**rules of
    them), so the ablations read a table whose size the rules bound."""
    whole = mask(POLICIES[policy], rules)
    spark = led.sparkSession
    patterns = led.groupBy("failure_bits").agg(F.count("*").alias("n"))
    own = spark.createDataFrame([(r.name, 1 << i, whole & ~(1 << i)) for i, r in enumerate(rules) if whole >> i & 1],
                                "rule string, bit long, rest long")
    hit = F.col("failure_bits").bitwiseAND(F.col("bit")) != 0
    others = F.col("failure_bits").bitwiseAND(F.col("rest")) == 0
    return (patterns.join(F.broadcast(own))  # a handful of rules against the patterns
            .groupBy("rule")
            .agg(F.sum("n").alias("documents"),
                 F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(hit & others, F.col("n")).otherwise(0)).alias("rejected_alone"),
                 F.sum(F.when(others, F.col("n")).otherwise(0)).alias("kept_without")))
