"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_engine.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for every node of a link the smallest node it can
    reach.

    Large-star and small-star steps (Kiveris et al. 2014) alternate until the
    links no longer change: each link moves to the smallest neighbour, first
    for larger, then for smaller neighbours.  Minima are summed before the
    shuffle, so a node with very many links is no hot key of an aggregation;
    only the join back meets it, which adaptive execution splits."""
    high, low = F.greatest(a, b), F.least(a, b)
    links = cut(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("s")).first()
        if not mark.n or mark == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                links.select("v", "v").distinct()).distinct()
        before = mark
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct("u", F.col("m").alias("v")))).alias("l"))
        links = cut(small.select("l.u", "l.v").where("u <> v").distinct(), "links")
