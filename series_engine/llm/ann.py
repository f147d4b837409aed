"""Approximate nearest neighbours by multi-index hashing.

*Codes.*  Vectors are centred, turned to their principal axes and then by a
learned rotation that brings them close to the corners of a cube (iterative
quantization); signs are the bits.  The rotation is fitted on at most
``sample`` vectors.

*Index.*  A code is split into substrings and every vector is indexed under
each.  By the pigeonhole principle (in the sharp form of Norouzi, Punjani and
Fleet) a code within Hamming radius ``R`` of a query has a substring within
``R // m`` of the query's, so probing the substrings' buckets retrieves every
code within the radius; each is taken up in the first substring that allows
it, and ranked by the distance of the original vectors in double precision.

*Radius.*  It is the smallest that holds ``recall`` of the true neighbours of
sample queries among the sample.  A query that finds fewer than it needs is
searched again without a radius, that is, exactly.

Buckets are cells of bounded size: a bucket with many vectors is split by
hash, and queries go to every part of the buckets they probe.  Equal vectors
are indexed once, with the few smallest ids that an answer can need, so a
vector that a third of all rows hold is one entry.

Defined results: vectors that are NULL, zero, of another length than most, or
hold NULL or non-finite numbers take no part, neither do NULL ids; of several
rows with one id the smallest vector counts; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, only, parallelism, small

_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


@dataclass
class Codes:
    """The learned rotation and the layout of the substrings."""
    mean: np.ndarray
    turn: np.ndarray  # dimension x bits
    widths: list[int]
    radius: int

    @property
    def bits(self) -> int:
        return sum(self.widths)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Substring values, one column each."""
        signs = ((vectors - self.mean) @ self.turn) > 0
        parts = np.split(signs, np.cumsum(self.widths)[:-1], axis=1)
        return np.stack([p @ (1 << np.arange(p.shape[1])) for p in parts], axis=1).astype(np.uint16)

    def radii(self, radius: int) -> list[int]:
        """Largest substring distances that together cover a radius."""
        m = len(self.widths)
        return [radius // m if i <= radius % m else radius // m - 1 for i in range(m)]


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all rows of ``b``, per substring."""
    return _POPCOUNT[a[:, None, :] ^ b[None, :, :]]


def fit(sample: np.ndarray, k: int, recall: float = 0.98, max_bits: int = 64, rounds: int = 40, tests: int = 300, seed: int = 7) -> Codes:
    """Learn the codes on a sample of vectors."""
    rng = np.random.default_rng(seed)
    bits = min(max_bits, sample.shape[1])
    m = max(1, -(-bits // 16))
    widths = [bits // m + (i < bits % m) for i in range(m)]
    mean = sample.mean(axis=0)
    x = sample - mean
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, np.argsort(values)[::-1][:bits]]
    v = x @ axes
    r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(v.T @ np.where(v @ r > 0, 1.0, -1.0))
        r = u @ w
    codes = Codes(mean, axes @ r, widths, bits)
    own = rng.permutation(len(sample))[:tests]
    all_codes = codes.encode(sample)
    seen = np.zeros(bits + 1, dtype=np.int64)
    for i in own:
        d = ((sample - sample[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        np.add.at(seen, hamming(all_codes[i:i + 1], all_codes[near])[0].sum(axis=1, dtype=np.int64), 1)
    if seen.sum():
        codes.radius = int(np.searchsorted(np.cumsum(seen), recall * seen.sum()))
    return codes


def valid(vectors: DataFrame, vector: str, id_col: str) -> DataFrame:
    """``_id, _v``: one usable vector per id."""
    v = only(vectors, id_col, vector).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_v"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = v.where(F.col("_id").isNotNull() & F.col("_v").isNotNull()).where(F.forall("_v", good) & F.exists("_v", lambda x: x != 0))
    return v.groupBy("_id").agg(F.min("_v").alias("_v"))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """``_c, _v, _ids``: every different vector with its ``keep`` smallest ids.
    Copies are thinned in parts before they meet."""
    part = Window.partitionBy("_v", "_part").orderBy("_id")
    whole = Window.partitionBy("_v").orderBy("_id")
    few = (rows.withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(64))).withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= keep)
           .withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= keep))
    return few.groupBy("_v").agg(F.sort_array(F.collect_list("_id")).alias("_ids")).select(F.col("_ids")[0].alias("_c"), "_v", "_ids")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, queries, k: int = 10, sample: int = 20_000, recall: float = 0.98, cell: int = 20_000,
           query_cell: int = 2_000, prefix_bits: int = 4, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``query_id, rank, id, score``: for every row that the condition
    ``queries`` (on the id column) names, its ``k`` nearest other rows."""
    kind = dict(vectors.dtypes)[id_col]
    spark = vectors.sparkSession
    rows = cut(valid(vectors, vector, id_col), "ann-rows")
    sizes = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    out = f"query_id {kind}, rank int, {id_col} {kind}, score double"
    if sizes is None:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("_v") == sizes.n)
    index = cut(entries(rows, k + 1), "ann-entries")
    chosen = index.orderBy(F.xxhash64("_v"), "_c").limit(sample).select("_v")
    codes = fit(np.array([r[0] for r in chosen.collect()], dtype=np.float64), k, recall)
    share = spark.sparkContext.broadcast(codes)
    m = len(codes.widths)
    shift = [max(w - prefix_bits, 0) for w in codes.widths]

    def places(batches):
        """Every vector under each of its substrings."""
        for b in batches:
            parts = share.value.encode(_matrix(b.column("_v")))
            for s in range(m):
                yield pa.RecordBatch.from_arrays(
                    [b.column("_c"), b.column("_v"), b.column("_ids"), pa.array(np.full(len(parts), s, np.int32)),
                     pa.array((parts[:, s] >> shift[s]).astype(np.int32))], names=["_c", "_v", "_ids", "_s", "_b"])

    def probes(radius: int):
        radii = codes.radii(radius)

        def run(batches):
            """Every query in the buckets that can hold a substring near its own."""
            for b in batches:
                parts = share.value.encode(_matrix(b.column("_v")))
                for s in range(m):
                    if radii[s] < 0:
                        continue
                    heads = np.arange(1 << min(prefix_bits, codes.widths[s]), dtype=np.uint16)
                    q, h = np.nonzero(_POPCOUNT[(parts[:, s] >> shift[s])[:, None] ^ heads[None, :]] <= radii[s])
                    take = pa.array(q)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("_c").take(take), b.column("_v").take(take), pa.array(np.full(len(q), s, np.int32)),
                         pa.array(heads[h].astype(np.int32))], names=["_c", "_v", "_s", "_b"])
        return run

    def compare(radius: int):
        radii = codes.radii(radius)

        def run(key, base: pa.Table, asked: pa.Table) -> pa.Table:
            own, s = share.value, key[0].as_py()
            found = {"_q": [], "_c": [], "_score": []}
            if base.num_rows and asked.num_rows:
                v, q = _matrix(base.column("_v")), _matrix(asked.column("_v"))
                ids = base.column("_c").to_pylist()
                order = np.argsort(np.array(ids, dtype=object), kind="stable")
                vc, qc = own.encode(v), own.encode(q)
                for i, name in enumerate(asked.column("_c").to_pylist()):
                    d = hamming(qc[i:i + 1], vc)[0].astype(np.int64)
                    ok = (d[:, s] <= radii[s]) & (d.sum(axis=1) <= radius)
                    for t in range(s):  # taken up under an earlier substring
                        ok &= d[:, t] > radii[t]
                    at = order[ok[order]]
                    dist = np.sqrt(((v[at] - q[i]) ** 2).sum(axis=1))
                    for j in np.argsort(dist, kind="stable")[:k + 1]:
                        for n, x in zip(found, (name, ids[at[j]], float(dist[j])), strict=True):
                            found[n].append(x)
            types = base.schema.field("_c").type
            return pa.table({"_q": pa.array(found["_q"], types), "_c": pa.array(found["_c"], types), "_score": pa.array(found["_score"], pa.float64())})
        return run

    id_kind = dict(index.dtypes)["_c"]
    placed = cut(index.mapInArrow(places, f"_c {id_kind}, _v array<double>, _ids array<{id_kind}>, _s int, _b int"), "ann-index")
    load = small(cut(placed.groupBy("_s", "_b").agg(F.ceil(F.count("*") / cell).cast("int").alias("_parts")), "ann-loads"))
    asking = rows.where(F.expr(queries.replace(id_col, "_id"))).join(index.select("_c", "_v"), "_v").select("_id", "_c")
    asking = cut(asking, "ann-queries")
    open_queries = asking.select("_c").distinct().join(index, "_c").select("_c", "_v")

    def answers(asked: DataFrame, radius: int) -> DataFrame:
        q = asked.mapInArrow(probes(radius), f"_c {id_kind}, _v array<double>, _s int, _b int").join(load, ["_s", "_b"])
        per = q.groupBy("_s", "_b").agg(F.ceil(F.count("*") / query_cell).cast("int").alias("_asks"))
        per = small(cut(per, "ann-asks"))
        grid = ["_s", "_b", "_i", "_j"]
        q = q.join(per, ["_s", "_b"]).select("_c", "_v", "_s", "_b", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_i"),
                                            F.pmod(F.xxhash64("_c"), F.col("_asks")).cast("int").alias("_j"))
        base = placed.join(load, ["_s", "_b"]).join(per, ["_s", "_b"]).select(
            "_c", "_v", "_s", "_b", F.pmod(F.xxhash64("_c"), F.col("_parts")).cast("int").alias("_i"),
            F.explode(F.sequence(F.lit(0), F.col("_asks") - 1)).alias("_j"))
        found = base.groupBy(*grid).cogroup(q.groupBy(*grid)).applyInArrow(compare(radius), f"_q {id_kind}, _c {id_kind}, _score double")
        best = Window.partitionBy("_q").orderBy("_score", "_c")
        return cut(found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r"), "ann-found")

    first = answers(open_queries, codes.radius)
    held = index.select("_c", F.size("_ids").alias("_n"))
    enough = first.join(held, "_c").groupBy("_q").agg(F.sum("_n").alias("_n")).where(F.col("_n") >= k + 1).select(F.col("_q").alias("_c"))
    short = cut(open_queries.join(enough, "_c", "left_anti"), "ann-short")
    found = first
    if codes.radius < codes.bits and short.limit(1).count():
        found = first.join(short.select(F.col("_c").alias("_q")), "_q", "left_anti").unionByName(answers(short, codes.bits))
    best = Window.partitionBy("_q").orderBy("_score", "_id")
    near = (found.join(index.select("_c", F.explode("_ids").alias("_id")), "_c")
            .withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1))
    near = near.select(F.col("_q").alias("_c"), F.col("_id").alias(id_col), F.col("_score").alias("score"))
    # a vector that many queries share is answered once; its queries are spread by their ids
    asked = asking.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(parallelism(asking))).cast("int"))
    near = near.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parallelism(asking) - 1))))
    own = Window.partitionBy("_id").orderBy("score", id_col)
    return (asked.join(near, ["_c", "_salt"]).where(F.col("_id") != F.col(id_col)).withColumn("rank", F.row_number().over(own))
            .where(F.col("rank") <= k).select(F.col("_id").alias("query_id"), "rank", id_col, "score"))
