"""Document fingerprints by winnowing (Schleimer, Wilkerson, Aiken 2003).

A text is read as its words; a run of more than ``LONG_RUN`` code points without
a blank (a script without spaces, encoded data) counts as its single characters.
Every word has a code of 28 bits of its CRC-32, and every ``k`` consecutive words
the Karp-Rabin value of their codes, the polynomial in ``BASE`` modulo
``PRIME`` that a hash rolled over the text has at that place (Spark's arrays keep
no running state, so the values of 2, 4, ... words are joined from halves).  Of every window of ``window``
consecutive k-grams the smallest value is chosen, of equal ones the rightmost,
and kept with its position.  So any passage of ``window + k - 1`` words that two
texts share puts a common value into both fingerprints.  A text of fewer words
than ``k`` is one gram, one of fewer grams than ``window`` is one window.

A value and its position are one number, smaller for a smaller value and then for
a larger position: the least number of a window is the rightmost smallest value.

``with_next`` puts the next document in descending key order beside every
document.  Keys are dealt into blocks of the total order (key, text hashes, a
number that parts identical rows) whose borders, one per block, are found from
keys alone; the texts move once, to their block, and the first row of every block
moves to the block before as well.  No block is a key: rows of one key, or
identical rows, may lie in several.  Keys are read once for the borders and once
with the texts: where identical rows fill more than a block, ``docs`` must give
them in the same partitions both times, as a table does (a stored one is needed
after a shuffle); a lost border raises an error.

Defined results: NULL text is empty; an empty text has an empty fingerprint,
which is wholly like another empty one (1.0) and unlike all others (0.0); a text
whose words are all blank has words none and is empty in this sense; NULL keys
come last; rows with one key follow each other by the hash of their text, and
identical rows in any order; the document after the last is the first, so a
single document is its own next; extra columns are carried through whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import BLANK_CLASS, let, parallelism, text_or_empty, words

#: Modulus and base of the Karp-Rabin values, bits of a word's code.
PRIME, BASE, CODE_MASK = (1 << 31) - 1, 1_000_003, (1 << 28) - 1
#: Code points from which a run without a blank counts by characters.
LONG_RUN = 32
#: Words in a gram, grams in a window (powers of two).
K, WINDOW = 4, 8

_LOW = (1 << 31) - 1  # the part of a number that holds the position, reversed


def pieces(raw: Column) -> Column:
    """Units of an array of words: words, or the characters of an overlong one."""
    cut = F.flatten(F.transform(raw, lambda x: F.when(F.length(x) > LONG_RUN, F.split(x, "", -1)).otherwise(F.array(x))))
    return F.when(F.exists(raw, lambda x: F.length(x) > LONG_RUN), cut).otherwise(raw)


def _doubled(values: Column, upto: int, join) -> Column:
    """``join`` of ``upto`` (a power of two) consecutive entries, from every entry
    on, by doubling; what reaches beyond the end is cut off."""
    def twice(step: int):
        return lambda v: F.transform(v, lambda x, i: join(x, F.get(v, i + step), step))

    have = 1
    while have < upto:
        values, have = let(values, twice(have)), 2 * have
    return let(values, lambda v: F.slice(v, 1, F.greatest(F.size(v) - (upto - 1), F.lit(0))))


def winnow(units: Column, k: int = K, window: int = WINDOW, start: Column | int = 0) -> Column:
    """Chosen numbers (value and reversed position) of an array of units, by
    position; the first unit has position ``start``."""
    if any(x < 2 or x & (x - 1) for x in (k, window)):
        raise ValueError("k and window are powers of two")
    start = F.lit(start) if isinstance(start, int) else start

    def packed(values: Column) -> Column:
        top = F.lit(_LOW) - start.cast("long")
        return let(top, lambda t: F.transform(values, lambda h, i: h * F.lit(1 << 31) + (t - i)))

    def grams(codes: Column) -> Column:
        whole = F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: (h * F.lit(BASE) + c) % F.lit(PRIME))
        full = _doubled(codes, k, lambda h, g, step: (h * F.lit(pow(BASE, step, PRIME)) + g) % F.lit(PRIME))
        return (F.when(F.size(codes) == 0, F.array().cast("array<bigint>"))
                .when(F.size(codes) < k, F.array(whole)).otherwise(full))

    def chosen(values: Column) -> Column:
        return (F.when(F.size(values) == 0, values)
                .when(F.size(values) < window, F.array(F.array_min(values)))
                .otherwise(F.array_distinct(_doubled(values, window, lambda a, b, _: F.least(a, b)))))

    codes = F.transform(units, lambda x: F.crc32(x.cast("binary")).bitwiseAND(F.lit(CODE_MASK)))
    return let(packed(let(codes, grams)), chosen)


def position(number: Column) -> Column:
    return F.lit(_LOW) - number.bitwiseAND(F.lit(_LOW))


def value(number: Column) -> Column:
    return F.shiftright(number, 31)


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Array of (position, hash) of a text."""
    numbers = winnow(pieces(words(text)), k, window)
    return F.transform(numbers, lambda v: F.struct(position(v).alias("position"), value(v).alias("hash")))


def as_text(numbers: Column) -> Column:
    """``position:hash`` of every chosen gram."""
    return F.array_join(F.transform(numbers, lambda v: F.concat(position(v).cast("string"), F.lit(":"), value(v).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the values of two sets of numbers that both hold."""
    x, y = F.transform(a, value), F.transform(b, value)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def edited(text: Column, following: Column) -> Column:
    """The text whose last half is the start of the following text instead."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def winnow_edited(text: Column, numbers: Column, following: Column, k: int = K, window: int = WINDOW) -> Column:
    """``winnow`` of ``edited(text, following)``, given the text's own numbers.

    Grams that were chosen in windows inside the kept half stay chosen; only the
    words from the last such window on are hashed.  The last kept word may go on
    in the new half, so it counts to the new words."""
    half = F.floor(F.length(text) / 2).cast("int")
    kept = F.substr(text, F.lit(1), F.length(text) - half)

    def with_kept(raw: Column) -> Column:
        gap = F.when(kept.rlike(f"[{BLANK_CLASS}]\\z"), F.lit(" ")).otherwise(F.lit(""))
        rest = F.concat(F.coalesce(F.try_element_at(raw, F.lit(-1)), F.lit("")), gap, F.substr(following, F.lit(1), half))
        sure = pieces(F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0))))

        def with_sure(units: Column) -> Column:
            last = F.size(units) - F.lit(window + k - 1)  # start of the last window of sure words
            begin = F.greatest(last - F.lit(window - 2), F.lit(0))
            tail = F.concat(F.slice(units, begin + 1, F.size(units)), pieces(words(rest)))
            own = F.when(last < 0, F.array().cast("array<bigint>")).otherwise(F.filter(numbers, lambda v: position(v) <= last))
            return F.array_distinct(F.concat(own, winnow(tail, k, window, begin)))
        return let(sure, with_sure)
    return let(words(kept), with_kept)


_KEY = ("n", "d", "k1", "k2", "s")  # NULL key, descending key, text hashes, a number for identical rows
_ANY = -(1 << 63)


def _order_key(key: str, text: Column) -> Column:
    k = F.col(f"`{key}`").cast("long")
    return F.struct(k.isNull().cast("int").cast("long").alias("n"), F.coalesce(F.bitwise_not(k), F.lit(0).cast("long")).alias("d"),
                    F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
                    F.xxhash64(F.monotonically_increasing_id()).alias("s"))


def _borders(keys: DataFrame, blocks: int) -> tuple[dict[str, Column], int]:
    """The first key of every block of the order, an array for each part of the
    key and their length: one short entry for each of ``blocks`` blocks.  Identical
    rows part only where one block cannot hold them: other borders leave their
    number out.  The arrays are constants of the plan, so a row pays for the few
    entries it looks up, not for their number."""
    dealt = keys.select("_o.*").repartitionByRange(blocks, *_KEY).withColumn("_p", F.spark_partition_id())
    first = [r.b.asDict() for r in dealt.groupBy("_p").agg(F.min(F.struct(*_KEY)).alias("b")).orderBy("b").collect()]
    for b, before in zip(first[:0:-1], first[-2::-1]):
        if any(b[c] != before[c] for c in _KEY[:-1]):
            b["s"] = _ANY
    if not first:
        return {c: F.array().cast("array<bigint>") for c in _KEY}, 0
    first[0]["s"] = _ANY
    return {c: F.split(F.lit(",".join(str(b[c]) for b in first)), ",").cast("array<bigint>") for c in _KEY}, len(first)


def with_next(docs: DataFrame, row: Column, key: str = "doc_id", text: str = "text", payload: Column | None = None,
              blocks: int | None = None) -> DataFrame:
    """``row, own, following``: for every row of ``docs`` its column ``row`` (carried
    as it is), its ``payload`` and the payload of the next document in descending
    order of ``key``."""
    blocks = blocks or 4 * parallelism(docs)
    t = text_or_empty(F.col(f"`{text}`"))
    borders, n = _borders(docs.select(_order_key(key, t).alias("_o")), blocks)
    rows = docs.select(_order_key(key, t).alias("_o"), row.alias("row"), (payload if payload is not None else t).alias("own"))

    def border(at: Column) -> Column:
        return F.struct(*[F.get(borders[c], at).alias(c) for c in _KEY])

    def halve(s: Column, _) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        step = let(mid, lambda m: F.when(border(m) <= F.col("_o"), F.struct(m.alias("lo"), s["hi"].alias("hi")))
                   .otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi"))))
        return F.when(s["hi"] - s["lo"] <= 1, s).otherwise(step)

    def starts(b: Column) -> Column:
        same = F.lit(True)
        for c in _KEY[:-1]:
            same = same & (b[c] == F.col(f"_o.{c}"))
        return same & ((b["s"] == F.lit(_ANY)) | (b["s"] == F.col("_o.s")))

    # the last border not above the row, by halving
    block = F.aggregate(F.array_repeat(F.lit(0), n.bit_length()), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), halve,
                        lambda s: F.struct(s["lo"].alias("block"), starts(border(s["lo"])).alias("first"), F.lit(n).alias("n")))
    rows = rows.withColumn("_b", block)
    copy = F.struct(F.pmod(F.col("_b.block") - 1, F.col("_b.n")).alias("block"), F.lit(1).alias("copy"))
    own = F.struct(F.col("_b.block").alias("block"), F.lit(0).alias("copy"))
    rows = rows.withColumn("_to", F.explode(F.when(F.col("_b.first"), F.array(own, copy)).otherwise(F.array(own))))
    rows = rows.select("_to.block", "_to.copy", "_o", F.when(F.col("_to.copy") == 0, F.col("row")).alias("row"), "own")
    following = F.lead("own").over(Window.partitionBy("block").orderBy("copy", "_o"))
    found = rows.withColumn("following", following).where("copy = 0")
    lost = F.raise_error(F.lit("the documents changed between two reads"))
    return found.select("row", "own", F.coalesce("following", lost.cast(rows.schema["own"].dataType)).alias("following"))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """For every document: all its columns as the struct ``row``, ``n_chars``,
    ``edited_text``, the chosen numbers of the text (``numbers``) and of the edited
    text (``edited_numbers``), and ``near_edited`` and ``near_next``."""
    t = text_or_empty(F.col(f"`{text}`"))
    payload = F.struct(t.alias("t"), winnow(pieces(words(t)), k, window).alias("f"))
    pairs = with_next(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]), key, text, payload)
    own, nxt = F.col("own.t"), F.col("following.t")
    out = pairs.select("row", F.length(own).cast("long").alias("n_chars"), edited(own, nxt).alias("edited_text"),
                       F.col("own.f").alias("numbers"), winnow_edited(own, F.col("own.f"), nxt, k, window).alias("edited_numbers"),
                       likeness(F.col("own.f"), F.col("following.f")).alias("near_next"))
    return out.withColumn("near_edited", likeness(F.col("numbers"), F.col("edited_numbers")))
