"""Line dedup with a log-template tree.

Lines are parsed at a fixed depth: by token count, then by their leading
tokens, with tokens that hold a digit or ``@`` read as a variable field.  In a
leaf of the tree a token position is constant where enough of the leaf's
documents (``min_docs`` and a ``share`` of them) agree on the token and variable
elsewhere; the resulting template recurs when enough documents hold a line of it
and at least half of its tokens, and of its words beyond the leading ones that
the leaf fixes, are constant.  A line form at least half of whose tokens are no
fields recurs whatever else lies in its leaf when ``min_docs`` documents hold it
as it is, or ``min_long`` if it has ``long_words`` tokens or more.  Lines of
recurring templates are dropped.

Documents are counted as families of texts: copies and near-copies of one text
are one witness, so what only they share is no boilerplate and stays in all of
them (whole copies are the business of a document dedup).  Two texts are linked
if they share half of their three-word shingles (taken inside lines) *without
their longest common line*: a line does not make copies of the texts that hold
it.  Every text of a candidate line enters the buckets of its ``_KEYS`` smallest
shingle hashes, is compared with the smallest text of each on the full sets, and
the components of the confirmed links are the families.

Lines are parsed once and their hashes written; counting works on (line form,
text) pairs and on the distinct forms of recurring leaves, so a line that every
document holds is summed before it is shuffled.  Everything is DataFrame code.

Defined results: NULL text stays NULL with 0 lines; a line without words is
never dropped; repeated rows and NULL or repeated ``doc_id`` are carried
through; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import BLANK_CLASS, BLANKS, cut, has_word, let, small, words
from series_engine.llm.components import components

FIELD = "<*>"
#: A whole token with a digit or @: the possessive run keeps this linear.
_FIELD_TOKEN = f"(?<![^{BLANK_CLASS}])[^{BLANK_CLASS}0-9@]*+[0-9@][^{BLANK_CLASS}]*+"

#: The rest of a line from its first word on: one match in every line with a word.
_WORDED_LINE = f"[^{BLANK_CLASS}][^\\n]*+"

#: Blanks other than the space and the line break.
_ODD = BLANKS.replace(" ", "").replace("\n", "")

#: Smallest shingle hashes that a text keeps, and how many of them are bucket keys.
_SKETCH, _KEYS = 64, 16

#: Pairs of one pivot that a task compares; low bits of a line's code that hold its shingles.
_PIVOT_ROWS, _LEN_BITS = 500, 20


def odd_blanks(text: Column) -> Column:
    """Whether a text has blanks other than spaces and line breaks."""
    return text.rlike(f"[{_ODD}]")


def spaced(text: Column) -> Column:
    """The text, its blanks other than line breaks as spaces."""
    return F.when(odd_blanks(text), F.translate(text, _ODD, " " * len(_ODD))).otherwise(text)


def parts(line: Column) -> Column:
    """Words of a line whose blanks are spaces: no pattern is compiled for it."""
    return F.array_remove(F.split(line, " "), "")


def tokens(line: Column) -> Column:
    """Tokens of a line of a ``spaced`` text, variable fields generalised."""
    return parts(F.when(line.rlike("[0-9@]"), F.regexp_replace(line, _FIELD_TOKEN, F.lit(FIELD))).otherwise(line))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def parsed(docs: DataFrame, text: str, depth: int) -> DataFrame:
    """One row per line with a word: text key, line number, leaf, form, number of tokens, tokens."""
    t = docs.select(F.col(f"`{text}`").alias("_t")).where(F.col("_t").isNotNull())
    # a text is hashed before its lines are dealt out, not again for every line
    lines = t.select(*text_key(F.col("_t")), spaced(F.col("_t")).alias("_t")).select(
        "_k1", "_k2", F.posexplode(F.split("_t", "\n", -1)).alias("_at", "_line"))
    toks = lines.where(F.trim("_line") != "").select("_k1", "_k2", "_at", tokens(F.col("_line")).alias("_toks"))
    return toks.select("_k1", "_k2", "_at", F.xxhash64(F.size("_toks"), F.slice("_toks", 1, depth)).alias("_leaf"),
                       F.xxhash64("_toks").alias("_form"), F.size("_toks").alias("_len"), F.array_join("_toks", " ").alias("_s"))


def shingles(text: Column) -> Column:
    """Distinct hashes of a text's three-word shingles, lower-cased."""
    return F.array_distinct(let(words(F.lower(text)), lambda w: F.transform(
        w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))))


def near_pairs(docs: DataFrame, text: str, keys: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: texts of ``keys`` and a smaller one that each is close to.

    The ``_SKETCH`` smallest hashes of the union of two sets are a sample of it;
    the share of them that lies in both estimates the similarity (exactly for
    unions of fewer shingles)."""
    t = docs.select(F.col(f"`{text}`").alias("_t")).where(has_word(F.col("_t")))
    sketches = t.select(F.xxhash64("_t").alias("_k1"), F.slice(F.sort_array(shingles(F.col("_t"))), 1, _SKETCH).alias("_sketch"))
    sketches = sketches.join(small(keys.select("_k1").distinct()), "_k1", "left_semi")
    sketches = cut(sketches.groupBy("_k1").agg(F.first("_sketch").alias("_sketch")), "line-sketches")
    keyed = sketches.select("_k1", F.explode(F.slice("_sketch", 1, _KEYS)).alias("_h"))
    pivots = keyed.groupBy("_h").agg(F.min("_k1").alias("_b"), F.max("_k1").alias("_m")).where("_b <> _m").select("_h", "_b")
    pairs = keyed.join(pivots, "_h").where("_k1 <> _b").select(F.col("_k1").alias("_a"), "_b").distinct()
    pairs = pairs.join(sketches.withColumnsRenamed({"_k1": "_a", "_sketch": "_x"}), "_a")
    pairs = pairs.join(sketches.withColumnsRenamed({"_k1": "_b", "_sketch": "_y"}), "_b")
    least = pairs.withColumn("_u", F.slice(F.sort_array(F.array_union("_x", "_y")), 1, _SKETCH))
    both = F.size(F.array_intersect(F.array_intersect("_u", "_x"), "_y"))
    return least.where(both >= similarity * F.size("_u")).select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def line_shingles(line: Column, odd: Column) -> Column:
    """Distinct hashes of a line's three-word shingles (the last two are short);
    ``odd``: the line may have ``odd_blanks``."""
    own = F.when(odd, words(line)).otherwise(parts(line))
    return F.array_distinct(let(own, lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))))


def line_code(line: Column, shingles: Column) -> Column:
    """A line in one number: 44 bits of its hash above its number of shingles."""
    most = (1 << _LEN_BITS) - 1
    return F.xxhash64(line).bitwiseAND(F.lit(~most)).bitwiseOR(F.least(F.size(shingles), F.lit(most)).cast("long"))


def beside(pairs: DataFrame, sets: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """The pairs ``_a, _b`` with columns of ``sets`` for either side: ``{column:
    (name for _a, name for _b)}``.  A pivot's row is copied for every
    ``_PIVOT_ROWS`` of its pairs, which are dealt among the copies."""
    loads = pairs.groupBy("_b").agg(F.floor((F.count("*") - 1) / _PIVOT_ROWS).alias("_last"))
    loads = small(cut(loads, "line-pivots"))
    pairs = pairs.join(loads, "_b").withColumn("_salt", F.pmod(F.xxhash64("_a"), F.col("_last") + 1)).drop("_last")
    own = sets.join(pairs.select(F.col("_a").alias("_k1")).distinct(), "_k1", "left_semi").dropDuplicates(["_k1"])
    own = own.select(F.col("_k1").alias("_a"), *[F.col(c).alias(x) for c, (x, _) in columns.items()])
    pivots = sets.join(loads.withColumnRenamed("_b", "_k1"), "_k1").dropDuplicates(["_k1"])
    pivots = pivots.select(F.col("_k1").alias("_b"), F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("_salt"),
                           *[F.col(c).alias(y) for c, (_, y) in columns.items()])
    return pairs.join(own, "_a").join(pivots, ["_b", "_salt"])


def links(docs: DataFrame, text: str, keys: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: texts of ``keys`` and the smaller ones of their buckets that they
    are near-copies of, their longest common line left out.

    Buckets are of 64-bit hashes; sets hold their upper halves, in order.  Pairs
    whose ``_SKETCH`` smallest shingles are far from alike are not compared whole:
    those that are linked share more than ``similarity`` with the line left in."""
    t = docs.select(F.col(f"`{text}`").alias("_t")).where(has_word(F.col("_t"))).withColumn("_k1", F.xxhash64("_t"))
    t = t.join(small(keys.select("_k1").distinct()), "_k1", "left_semi")
    # a line without words has no shingles and, of length 0, is no longest line
    per = F.transform(F.split("_t", "\n", -1), lambda x: let(
        line_shingles(x, F.col("_odd")), lambda s: F.struct(s.alias("s"), line_code(x, s).alias("c"))))
    sets = t.select("_k1", "_t", odd_blanks(F.col("_t")).alias("_odd")).select("_k1", per.alias("_per")).select(
        "_k1", F.sort_array(F.array_distinct(F.flatten("_per.s"))).alias("_s"), F.array_distinct("_per.c").alias("_lines"))
    sets = sets.select("_k1", F.slice("_s", 1, _KEYS).alias("_keys"), "_lines",
                       F.transform("_s", lambda h: F.shiftright(h, 32).cast("int")).alias("_set"))
    sets = cut(sets, "line-sets")
    keyed = sets.select("_k1", F.explode("_keys").alias("_h")).distinct()
    pivots = keyed.groupBy("_h").agg(F.min("_k1").alias("_b"), F.max("_k1").alias("_m")).where("_b <> _m").select("_h", "_b")
    pairs = cut(keyed.join(pivots, "_h").where("_k1 <> _b").select(F.col("_k1").alias("_a"), "_b").distinct(), "line-pairs")
    brief = beside(pairs, sets.select("_k1", F.slice("_set", 1, _SKETCH).alias("_s")), {"_s": ("_x", "_y")})
    least = brief.withColumn("_u", F.slice(F.sort_array(F.array_union("_x", "_y")), 1, _SKETCH))
    alike = F.size(F.array_intersect(F.array_intersect("_u", "_x"), "_y"))
    pairs = cut(least.where(alike >= 0.5 * similarity * F.size("_u")).select("_a", "_b"), "line-likely")
    whole = beside(pairs, sets.select("_k1", "_set", "_lines"), {"_set": ("_x", "_y"), "_lines": ("_xl", "_yl")})
    both, longest = F.size(F.array_intersect("_x", "_y")), F.array_max(F.transform(
        F.array_intersect("_xl", "_yl"), lambda c: c.bitwiseAND(F.lit((1 << _LEN_BITS) - 1))))
    seen = whole.select("_a", "_b", both.alias("_i"), (F.size("_x") + F.size("_y")).alias("_n"), F.coalesce(longest, F.lit(0)).alias("_l"))
    near = seen.where((F.col("_i") > F.col("_l")) & (F.col("_i") - F.col("_l") >= similarity * (F.col("_n") - F.col("_i") - F.col("_l"))))
    return near.select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def families(docs: DataFrame, text: str, keys: DataFrame, similarity: float = 0.5) -> DataFrame:
    """``_k1, _family``: the texts of ``keys`` that have near-copies among them."""
    return components(links(docs, text, keys, similarity)).withColumnsRenamed({"node": "_k1", "component": "_family"})


def held_by(rows: DataFrame, unit: str, least: int, name: str) -> DataFrame:
    """``unit, _all``: what so many different texts hold."""
    held = rows.select(unit, "_k1", "_k2").distinct().groupBy(unit).agg(F.count("*").alias("_all"))
    return small(cut(held.where(F.col("_all") >= least), name))


def recurring_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, depth: int = 3, share: float = 0.25,
                    min_long: int = 3, long_words: int = 20) -> DataFrame:
    """``_k1, _k2, _at``: lines of recurring templates, by text and line number."""
    rows = cut(parsed(docs, text, depth), "line-rows")
    leaves = held_by(rows, "_leaf", min_docs, "line-leaves")
    near = cut(rows.join(leaves.select("_leaf"), "_leaf", "left_semi"), "line-candidates")
    # distinct forms of recurring leaves, with the number of texts that hold each
    held = near.select("_form", "_k1", "_k2").distinct().groupBy("_form").agg(F.count("*").alias("_docs"))
    shape = near.select("_form", "_leaf", "_s").distinct()
    forms = cut(shape.join(held, "_form"), "line-forms").withColumn("_toks", F.split("_s", " "))
    cells = forms.select("_form", "_leaf", "_docs", F.posexplode("_toks").alias("_pos", "_tok"))
    constant = cells.groupBy("_leaf", "_pos", "_tok").agg(F.sum("_docs").alias("_n")).where(F.col("_n") >= min_docs)
    constant = constant.join(leaves, "_leaf").where(F.col("_n") >= share * F.col("_all"))
    marked = cells.join(constant.select("_leaf", "_pos", "_tok", F.lit(1).alias("_same")), ["_leaf", "_pos", "_tok"], "left")
    kept = F.when((F.col("_same") == 1) & (F.col("_tok") != FIELD), F.col("_tok")).otherwise(F.lit(FIELD))
    template = marked.groupBy("_form", "_leaf", "_docs").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_pos", kept.alias("t")))), lambda x: x["t"]), " ").alias("_template"),
        F.sum(F.when(kept != FIELD, 1).otherwise(0)).alias("_same"), F.count("*").alias("_size"),
        F.sum(F.when((F.col("_pos") >= depth) & (kept != FIELD), 1).otherwise(0)).alias("_agreed"),
        F.sum(F.when((F.col("_pos") >= depth) & (F.col("_tok") != FIELD), 1).otherwise(0)).alias("_free"),
        F.sum(F.when(F.col("_tok") != FIELD, 1).otherwise(0)).alias("_fixed"))
    template = cut(template, "line-templates")
    verbatim = template.where((F.col("_docs") >= min_docs) & (F.col("_size") < long_words) & (2 * F.col("_fixed") >= F.col("_size")))
    template = template.where((2 * F.col("_same") >= F.col("_size")) & (2 * F.col("_agreed") >= F.col("_free")))
    often = template.groupBy("_leaf", "_template").agg(F.sum("_docs").alias("_n")).where(F.col("_n") >= min_docs)
    template = template.join(often, ["_leaf", "_template"], "left_semi")
    # long forms need fewer holders, whatever their leaf
    long = rows.where(F.col("_len") >= long_words)
    long = long.join(held_by(long, "_form", min_long, "line-long").select("_form"), "_form", "left_semi")
    fixed = F.size(F.array_remove(F.split("_s", " "), FIELD))
    long = cut(long.where(2 * fixed >= F.col("_len")), "line-long-rows")
    # of these, the units that enough families of texts hold
    form, least = F.xxhash64("_form").alias("_unit"), F.lit(min_docs).alias("_least")
    units = template.select("_form", F.xxhash64("_leaf", "_template").alias("_unit"), least).unionAll(verbatim.select("_form", form, least))
    units = cut(units.unionAll(long.select("_form", form, F.lit(min_long).alias("_least")).distinct()), "line-units")
    lines = near.select("_form", "_k1").unionAll(long.select("_form", "_k1"))
    holders = cut(lines.join(small(units), "_form").select("_unit", "_least", "_k1").distinct(), "line-holders")
    own = holders.join(small(cut(families(docs, text, holders), "line-families")), "_k1", "left")
    own = own.select("_unit", "_least", F.coalesce("_family", "_k1").alias("_family")).distinct()
    often = own.groupBy("_unit", "_least").agg(F.count("*").alias("_n")).where("_n >= _least")
    dropped = units.join(often, ["_unit", "_least"], "left_semi").select("_form").distinct()
    return rows.join(small(cut(dropped, "line-dropped")), "_form", "left_semi").select("_k1", "_k2", "_at")


def cleaned(docs: DataFrame, text: str = "text", min_docs: int = 10, depth: int = 3) -> DataFrame:
    """``row, kept, n_lines, n_dropped``: every document's other columns as a struct
    (``c0, c1, ...`` in their order, so their names clash with nothing), its text
    without the lines of recurring templates, its lines with a word, and how many
    of them went."""
    drops = (recurring_lines(docs, text, min_docs, depth).distinct()
             .groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list("_at")).alias("_drop")))
    drops = small(cut(drops, "line-drops"))
    col = F.col(f"`{text}`")
    lines = F.split(F.col("_t"), "\n", -1)
    row = F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text])
    out = docs.select(row.alias("row"), col.alias("_t"), *text_key(col)).join(drops, ["_k1", "_k2"], "left")
    rest = F.when(F.col("_drop").isNull(), F.col("_t")).otherwise(F.array_join(
        F.filter(lines, lambda x, i: ~F.array_contains(F.col("_drop"), i)), "\n"))
    return out.select("row", rest.alias("kept"),
                      F.coalesce(F.regexp_count("_t", F.lit(_WORDED_LINE)), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"))


def column(docs: DataFrame, name: str, text: str = "text") -> Column:
    """A column of ``docs`` in the rows of ``cleaned``, with its name."""
    return (F.col("kept") if name == text else F.col(f"row.c{docs.columns.index(name)}")).alias(name)


def line_dedup(docs: DataFrame, text: str = "text", min_docs: int = 10, depth: int = 3) -> DataFrame:
    """The documents without the lines of recurring templates; adds
    ``n_lines`` (lines with a word) and ``n_dropped``, in place of input columns of
    these names."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cleaned(docs, text, min_docs, depth).select(*[column(docs, c, text) for c in own], "n_lines", "n_dropped")
