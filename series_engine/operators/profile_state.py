"""Profiles that grow with the data: a mergeable state per batch of rows.

``column_state`` reads rows once and gives a few short rows: for every column its
rows, NULLs, NaNs, extremes, a KLL sketch of its values (numeric columns) and an
HLL sketch of its distinct values, and for label columns the exact rows per value.
States of two batches merge into the state of both, so the profile of a table that
is appended to reads the new rows and the stored states, never the old rows.

Counts, extremes and rows per value are exact.  A quantile's rank is off by at most
about 1.7 percent of the rows (KLL with k = 200, 99 percent of the time), distinct
counts by 1.6 percent of their value as a standard error (HLL with 2^12 registers).

Defined results: NULL and NaN are counted apart and take part in neither extremes
nor sketches; dates and timestamps have extremes as text in their sort order; an
empty batch is a state of zeros; columns that cannot be compared have counts alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, NumericType, StructType

from ..sinks.commits import CommitLog, append_once

STATE = ("kind string, column string, value string, n_rows long, n_null long, n_nan long, low double, high double, "
         "low_text string, high_text string, quantiles binary, distincts binary")


def _cells(df: DataFrame, name: str) -> Column:
    dtype, c = df.schema[name].dataType, F.col(f"`{name}`")
    nan = F.isnan(c) if isinstance(dtype, (DoubleType, FloatType)) else F.lit(False)
    known = F.when(~nan, c)
    number = isinstance(dtype, NumericType)
    plain = not isinstance(dtype, (ArrayType, MapType, StructType, BinaryType))
    text = known.cast("string") if plain else F.lit(None).cast("string")
    value = known.cast("double") if number else F.lit(None).cast("double")
    return F.struct(
        F.lit("column").alias("kind"), F.lit(name).alias("column"), F.lit(None).cast("string").alias("value"),
        F.count(F.lit(1)).alias("n_rows"), F.sum(c.isNull().cast("long")).alias("n_null"), F.sum(F.coalesce(nan, F.lit(False)).cast("long")).alias("n_nan"),
        F.min(value).alias("low"), F.max(value).alias("high"),
        (F.min(known) if plain and not number else F.min(F.lit(None))).cast("string").alias("low_text"),
        (F.max(known) if plain and not number else F.max(F.lit(None))).cast("string").alias("high_text"),
        (F.kll_sketch_agg_double(value) if number else F.min(F.lit(None)).cast("binary")).alias("quantiles"),
        (F.hll_sketch_agg(text) if plain else F.min(F.lit(None)).cast("binary")).alias("distincts"))


def column_state(df: DataFrame, columns=None, labels=()) -> DataFrame:
    """State of ``columns`` (default all) and of the rows per value of ``labels``."""
    columns = list(columns or df.columns)
    # one aggregation over the rows; its single row has one struct per column
    once = df.agg(F.array(*[_cells(df, c) for c in columns]).alias("cells"))
    out = once.select(F.explode("cells").alias("c")).select("c.*")
    out = out.select(*[F.coalesce(c, F.lit(0)).alias(c) if c.startswith("n_") else c for c in out.columns])
    none = {"n_null": "long", "n_nan": "long", "low": "double", "high": "double", "low_text": "string", "high_text": "string",
            "quantiles": "binary", "distincts": "binary"}
    for label in labels:
        per = df.groupBy(F.col(f"`{label}`").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
        out = out.unionByName(per.select(F.lit("label").alias("kind"), F.lit(label).alias("column"), "value", "n_rows",
                                         *[F.lit(None).cast(t).alias(n) for n, t in none.items()]))
    return out


def merge(states: DataFrame) -> DataFrame:
    """One state of many."""
    return states.groupBy("kind", "column", "value").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_nan")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.when(F.count("distincts") > 0, F.hll_union_agg("distincts")).alias("distincts"))


def report(state: DataFrame, probabilities=(0.25, 0.5, 0.75)) -> DataFrame:
    """Columns of a state as numbers: counts, extremes, estimated quantiles (array,
    NULL where a column has no number) and distinct values."""
    at = F.array(*[F.lit(float(p)) for p in probabilities])
    return state.where("kind = 'column'").select(
        "column", "n_rows", "n_null", "n_nan", "low", "high", "low_text", "high_text",
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", at)).alias("quantiles"),
        F.when(F.col("distincts").isNotNull(), F.hll_sketch_estimate("distincts")).alias("n_distinct"))


def label_counts(state: DataFrame) -> DataFrame:
    """``column, value, n_rows`` of the label columns, most frequent first."""
    return state.where("kind = 'label'").select("column", "value", "n_rows").orderBy("column", F.desc("n_rows"), "value")


class ProfileLog:
    """The profile of a growing table: a state per appended batch, each once."""

    def __init__(self, spark: SparkSession, base: str, columns=None, labels=()):
        self.spark, self.base, self.columns, self.labels = spark, base, columns, tuple(labels)

    def add(self, rows: DataFrame, id_) -> bool:
        """Add the state of new rows under ``id_``; False if it is there already."""
        return append_once(column_state(rows, self.columns, self.labels), self.base, id_, kind="states")

    def state(self) -> DataFrame:
        return merge(CommitLog(self.spark, self.base).read("states", STATE))

    def compact(self) -> None:
        """Put the states so far in one folder."""
        CommitLog(self.spark, self.base).compact("states", schema=STATE)
