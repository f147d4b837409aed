"""A training corpus from documents: toxic documents go, recurring lines go,
one of each group of near-duplicates stays, sources are mixed to their target
weights, and the mix is packed into sequences.

Each stage takes ``(spark, docs, sf_dir)`` and gives the next stage's
documents; ``run`` writes every stage's result as Parquet under the shared
checkpoint folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_engine.llm import common, line_dedup, minhash, mixing, packing, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels.where(~toxicity.held_out())))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its lines of recurring templates (NULL text stays
    NULL; extra columns, whatever their names, stay; an empty table stays empty)."""
    chars = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(line_dedup.column(docs, "n_chars")).cast("long")
    return line_dedup.cleaned(docs).select(*[chars.alias(c) if c == "n_chars" else line_dedup.column(docs, c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return minhash.deduplicate(docs, size=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, once for every time it takes it."""
    out = mixing.mixed_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 2048 tokens."""
    return packing.pack(docs).drop("uid")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models, random draws and tokenizers have no SQL form; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
