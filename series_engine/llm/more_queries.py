"""Queries 11 to 13 and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_engine.llm import lexical, spelling, winnowing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprint_columns(out: DataFrame) -> DataFrame:
    return out.select("row.doc_id", "n_chars", F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
                      winnowing.as_text(F.col("numbers")).alias("fingerprint"),
                      winnowing.as_text(F.col("edited_numbers")).alias("edited_fingerprint"), "near_edited", "near_next")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprint_columns(winnowing.fingerprint_edits(_table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the word it is a spelling variant of."""
    return spelling.variants(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: CRC-32 of the strings ``s`` of a table ``named``, as SQL: a table of 256 values
#: made by the rule of the code, then one step a byte.
CRC_SQL = """
crc_0 AS (SELECT i, i::BIGINT AS c FROM range(256) r(i)),
{rounds},
crc_tab AS (SELECT list(c ORDER BY i) AS tab FROM crc_8),
crc_bytes AS (
  SELECT s, list_transform(range(1, octet_length(encode(s)) + 1), lambda i:
           (instr('0123456789ABCDEF', hex(encode(s))[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', hex(encode(s))[2 * i]) - 1) AS b
  FROM {named}
), crc AS (
  SELECT s, xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]),
           lambda x, y: xor(tab[xor(x & 255, y) + 1], x >> 8)), 4294967295::BIGINT) AS h
  FROM crc_bytes, crc_tab
)"""


def crc_sql(named: str) -> str:
    rounds = ",\n".join(f"crc_{r} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END AS c FROM crc_{r - 1})"
                        for r in range(1, 9))
    return CRC_SQL.format(rounds=rounds, named=named)


_P, _B, _MASK, _LONG, _K, _W = (winnowing.PRIME, winnowing.BASE, winnowing.CODE_MASK, winnowing.LONG_RUN, winnowing.K, winnowing.WINDOW)

OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER o AS at,
         coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS nxt,
         coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id
  FROM documents WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, length(t) AS n, substr(t, 1, (length(t) - length(t) // 2)::INT) || substr(nxt, 1, (length(t) // 2)::INT) AS edited FROM d
), texts AS (
  SELECT doc_id, 0 AS which, t AS x FROM e UNION ALL SELECT doc_id, 1, edited FROM e
), toks AS (
  SELECT doc_id, which, flatten(list_transform(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda w: w <> ''),
         lambda w: CASE WHEN length(w) > {_LONG} THEN string_split(w, '') ELSE [w] END)) AS w FROM texts
), named AS (
  SELECT DISTINCT unnest(w) AS s FROM toks
), {crc_sql("named")}, u AS (
  SELECT doc_id, which, pos, s, n FROM (SELECT doc_id, which, len(w) AS n, unnest(range(len(w))) AS pos, unnest(w) AS s FROM toks)
), c AS (
  SELECT doc_id, which, pos, n, (h & {_MASK})::HUGEINT AS c FROM u JOIN crc USING (s)
), g AS (
  SELECT doc_id, which, pos, n, {" + ".join(f"lead(c, {j}) OVER o * {pow(_B, _K - 1 - j, _P)}" for j in range(_K))} AS v
  FROM c WINDOW o AS (PARTITION BY doc_id, which ORDER BY pos)
), short AS (
  SELECT doc_id, which, list_reduce(list_prepend(0::HUGEINT, list(c ORDER BY pos)), lambda a, b: (a * {_B} + b) % {_P}) AS v
  FROM c WHERE n < {_K} GROUP BY doc_id, which
), grams AS (
  SELECT doc_id, which, pos, n - {_K - 1} AS n, (v % {_P})::BIGINT AS v FROM g WHERE n >= {_K} AND pos <= n - {_K}
  UNION ALL SELECT doc_id, which, 0, 1, v::BIGINT FROM short
), least AS (
  SELECT doc_id, which, pos, n, min({{'v': v, 'back': -pos}}) OVER (PARTITION BY doc_id, which ORDER BY pos
         ROWS BETWEEN CURRENT ROW AND {_W - 1} FOLLOWING) AS m FROM grams
), chosen AS (
  SELECT DISTINCT doc_id, which, -m.back AS pos, m.v AS v FROM least WHERE pos <= greatest(n - {_W}, 0)
), prints AS (
  SELECT doc_id, which, string_agg(pos || ':' || v, ' ' ORDER BY pos) AS f, list(DISTINCT v) AS vs FROM chosen GROUP BY doc_id, which
), x AS (
  SELECT e.doc_id, e.n, e.edited, coalesce(a.f, '') AS fa, coalesce(b.f, '') AS fb, coalesce(a.vs, []) AS va,
         coalesce(b.vs, []) AS vb, coalesce(c.vs, []) AS vc
  FROM e LEFT JOIN prints a ON e.doc_id = a.doc_id AND a.which = 0 LEFT JOIN prints b ON e.doc_id = b.doc_id AND b.which = 1
    LEFT JOIN prints c ON e.next_id = c.doc_id AND c.which = 0
), y AS (
  SELECT *, len(list_intersect(va, vb)) AS ib, len(list_intersect(va, vc)) AS ic FROM x
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
       CASE WHEN len(va) + len(vb) = 0 THEN 1.0::DOUBLE ELSE ib::DOUBLE / (len(va) + len(vb) - ib) END AS near_edited,
       CASE WHEN len(va) + len(vc) = 0 THEN 1.0::DOUBLE ELSE ic::DOUBLE / (len(va) + len(vc) - ic) END AS near_next
FROM y
"""

_UPPER, _UNDER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UNDER}'), " + r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH d AS (
  SELECT doc_id, {_TERMS} AS ts FROM documents
), size AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_all FROM d WHERE len(ts) > 0
), q AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark
), p AS (
  SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(ts)::BIGINT AS n, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL
), w AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w, n_docs, n_all
  FROM p, size GROUP BY t, n_docs, n_all
), s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all))))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN p USING (t) GROUP BY item_id, doc_id
), r AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
"""

OP12_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{_UPPER}', '{_UNDER}') AS run
  FROM documents
), counts AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS k FROM runs GROUP BY ALL
), named AS (
  SELECT DISTINCT s FROM counts WHERE length(run) >= 6
), {crc_sql("named")}, made AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k
  FROM counts JOIN crc USING (s)
), words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), without AS MATERIALIZED (
  SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word FROM without a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word FROM without a JOIN words b ON a.less = b.word
), best AS (
  SELECT near.word, count(*)::BIGINT AS n_near, min({{'k': -w.n, 'o': other}}) AS b FROM near JOIN words w ON w.word = other GROUP BY near.word
), forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.k >= 5 * n THEN b.o END AS form,
         CASE WHEN -b.k >= 5 * n THEN (-b.k)::BIGINT END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT walk.word, root FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

QUERIES = {"op11_fingerprints": op11_fingerprints, "op12_spelling_variants": op12_spelling_variants,
           "op13_lexical_search": op13_lexical_search}
ORACLE = {"op11_fingerprints": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_lexical_search": OP13_SQL}
