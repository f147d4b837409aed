"""Column helpers shared by the text operators.

A *word* is a maximal run of characters other than space and U+0009-U+000D;
these are the same characters for Java, Python and SQL, unlike ``\\s``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from series_engine.session import scratch_path, write_table

def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


#: The separators of words: space and U+0009-U+000D.
BLANKS = " \t\n\x0b\x0c\r"

#: The same characters as a regular expression class (Java and Python).
BLANK_CLASS = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a text without words or NULL."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANK_CLASS}]+"))


def n_words(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text)).cast("long")


def has_word(line: Column) -> Column:
    return line.rlike(f"[^{BLANK_CLASS}]")


def count_chars(text: Column, char_class: str) -> Column:
    """Number of characters of a regular expression class."""
    return (F.size(F.split(text, f"[{char_class}]", -1)) - 1).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the
    body's own lambdas read it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone: extra columns, whatever their names, go."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def parallelism(df: DataFrame) -> int:
    """Tasks of a shuffle, as the session says."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared checkpoint folder and read back."""
    return write_table(df, f"llm-{name}")


def running(df: DataFrame, order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """Adds ``_row`` (global row number from 0) and, for each ``new: column`` of
    ``sums``, the sum of ``column`` over all earlier rows of the total order.

    Rows are dealt into ranges of the order, so a value that a third of all
    rows share is spread like any other; only one line of totals per range
    meets in one task.  ``order`` must be total but for identical rows."""
    dealt = cut(df.repartitionByRange(parallelism(df), *order).withColumn("_range", F.spark_partition_id()), name)
    totals = dealt.groupBy("_range").agg(F.count("*").alias("_rows"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_o_rows"),
                            *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one line per range: as many as the session has shuffle partitions
    return (dealt.join(F.broadcast(offsets), "_range")
            .withColumn("_row", F.col("_o_rows") + F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0)))
            .withColumns({n: F.col(f"_o_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
            .drop("_range", "_o_rows", *[f"_o_{n}" for n in sums]))


#: Rows up to which a side with one short row per named thing is broadcast.
SMALL_ROWS = 100_000


def small(side: DataFrame) -> DataFrame:
    """The side, marked for broadcast if it has at most ``SMALL_ROWS`` rows (it
    is counted); a larger one stays for a shuffled join."""
    return F.broadcast(side) if side.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else side


def text_keys(text: Column) -> tuple[Column, Column]:
    """96 bits that stand for a text."""
    return F.xxhash64(text).alias("_k1"), F.hash(text).alias("_k2")


def cut_by_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """As ``cut``, and dealt into buckets of the keys: later joins on them read
    the rows where they lie, only the other side is shuffled."""
    spark = df.sparkSession
    path, table = scratch_path(spark, f"llm-{name}"), f"{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(parallelism(df), *keys).saveAsTable(table))
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay where they are: only the name goes from the catalog
    return rows


def distinct_texts(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``_k1, _k2, _n, _t``: every different text once (NULL as empty) with its
    number of rows, bucketed by its key.  Copies meet before the shuffle."""
    t = docs.select(text_or_empty(F.col(f"`{text}`")).alias("_t"))
    t = t.select(*text_keys(F.col("_t")), "_t").groupBy("_k1", "_k2").agg(F.first("_t").alias("_t"), F.count("*").alias("_n"))
    return cut_by_key(t, ["_k1", "_k2"], name)
