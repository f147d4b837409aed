"""Skew-safe ordered series.

A plain ``Window.partitionBy(entity)`` sends every row of an entity to one
task.  When one entity holds a third of the data that task never finishes.
This module splits each entity's series into pieces that Spark can spread
over the cluster and still gives exact results:

1. ``index`` — rows are dealt into *chunks*, windows run per (entity, chunk),
   and a small per-chunk table (one row per chunk, built with partial
   aggregation) carries offsets across chunk borders: global row position,
   rank, and — when a label is given — the run ("event") id and the position
   where the current run started.  By default chunks are ranges of the global
   order (entity, order columns) with about equal row counts, whatever the
   values are or how they are spread: any orderable type, NULL first and NaN
   last, one stray value or a burst moves no border.  A border may part peers
   (equal order values), also rows that are equal in every column, so a moment
   that holds a third of all rows is no hot task: the per-chunk table tells
   which peer groups go on in the next chunks, with what indicator sums and
   from which position, and RANGE sums, ranks and run starts stay exact.
2. ``blocked`` — with global positions known, rows are cut into fixed-size
   blocks of ``block_rows`` rows.  The last ``halo`` rows of each block are
   also copied into the next block, so any frame reaching at most ``halo``
   rows back is complete inside one block.  Windows then run per
   (entity, block[, run]) and halo copies are dropped.

Both steps shuffle on keys whose groups are bounded (chunk or block), never
on the entity alone.  Sorts are made total with a content hash of the row
(``row_tiebreak``), so recomputed tasks agree on positions; order lists
should still end in a meaningful unique tie-break, since among peers the
hash, not the data, decides which row comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DoubleType, FloatType,
                               MapType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from ..functions.columns import chunk_of
from ..session import write_table
from .joins import join_small

# Chunk widths of ``chunk_width="day"``: one day of a timestamp/date order
# column, or one day of an epoch-millisecond integer order column.  The
# default (``None``) is ``"auto"``: ranges of about equal row count.
DEFAULT_CHUNK_SECONDS = 86_400
DEFAULT_CHUNK_NUMERIC = 86_400_000
# Default block size for halo windows (rows per block and entity).
DEFAULT_BLOCK_ROWS = 1 << 20

POS = "_se_pos"        # 0-based row position in the entity's series
PEER = "_se_peer"      # position of the first row with equal order values
ESTART = "_se_estart"  # position where the row's run starts
BLOCK = "_se_blk"
HALO = "_se_halo"
_CHUNK = "_se_chunk"


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    if isinstance(xs, str):
        return [xs]
    return list(xs)


# Entities above this many rows are cut; also about twice the rows of a chunk.
AUTO_CHUNK_ROWS = 1_000_000
# About twice the rows that a task cuts into chunks, where chunks are smaller.
RANGE_ROWS = 1_000_000


def ranged(df: DataFrame, by, order, target_rows: int | None = None) -> DataFrame | None:
    """``df`` with ``_se_chunk``: ranges of the order (``by``, ``order``) of at
    most about ``target_rows`` rows each, or ``None`` when no entity has more
    rows than that (every entity is one chunk then).

    Ranges are cut by row count (sampled by Spark), so their size does not
    depend on the values: ``order`` is to end in the tie-break of the rows, and
    rows equal in all of it are parted by where they were read.  A task sorts
    its range and cuts it into chunks, so there are as many tasks as the rows
    need, however small the chunks.  The rows are
    written once under the shared checkpoint folder: the windows and the
    per-chunk table read the same chunks, also after a lost executor."""
    target = int(target_rows or AUTO_CHUNK_ROWS)
    by = _cols(by)
    per = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    size = per.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).collect()[0]  # one row
    if (size["most"] or 0) <= target:
        return None
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * size["rows"] // max(target, RANGE_ROWS)))
    dealt = df.withColumn("_se_place", F.monotonically_increasing_id())
    keys = [*by, *_cols(order), "_se_place"]
    dealt = dealt.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_se_place")
    # the range's number above the row's number in it
    at = F.monotonically_increasing_id()
    base = F.shiftleft(F.shiftright(at, 33), 33)
    return write_table(dealt.withColumn(_CHUNK, base + F.floor((at - base) / F.lit(target)).cast("long")), "series-chunks")


def _plain_keys(df: DataFrame, by) -> tuple[DataFrame, list[str]]:
    """``df`` with the entity as columns without NULL (a value and whether it
    is NULL), so that windows, the chunk table and an ordinary equality join
    agree on one partitioning and a NULL entity is a series of its own."""
    names = []
    for i, b in enumerate(by):
        dtype = df.schema[b].dataType
        if isinstance(dtype, NumericType):
            default = F.lit(0).cast(dtype)
        elif isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
            default = F.lit("1970-01-01").cast(dtype)
        elif isinstance(dtype, BooleanType):
            default = F.lit(False)
        elif isinstance(dtype, (StringType, BinaryType)):
            default = F.lit("").cast(dtype)
        else:
            raise TypeError(f"cannot use {b} ({dtype.simpleString()}) as the entity of a chunked series")
        df = df.withColumns({f"_se_k{i}": F.coalesce(F.col(b), default), f"_se_z{i}": F.col(b).isNull()})
        names += [f"_se_k{i}", f"_se_z{i}"]
    return df, names


def row_tiebreak(df: DataFrame) -> Column:
    """Content hash of a row (all hashable columns).  Appended to the order
    list it makes the sort total: any recomputation of a task (a retry after
    a lost executor, or the second branch that builds the chunk table) sees
    the same order, so positions and run ids stay consistent.  Rows equal in
    every column are interchangeable, so their remaining tie is harmless."""
    cols = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)
            and f.dataType.typeName() != "udt"]
    return F.xxhash64(*cols) if cols else F.lit(0)


def chunk_expr(df: DataFrame, column: str, width) -> Column:
    """Chunk of ``column`` by a fixed width: a number (seconds for timestamps
    and dates, the column's unit otherwise) or ``"day"``.  NULL has the first
    chunk and NaN the last, as they sort."""
    dtype = df.schema[column].dataType
    if width == "day":
        width = DEFAULT_CHUNK_NUMERIC if isinstance(dtype, NumericType) else DEFAULT_CHUNK_SECONDS
    chunk = chunk_of(column, dtype, width)
    if isinstance(dtype, (FloatType, DoubleType)):
        chunk = F.when(F.isnan(column), F.lit((1 << 63) - 1)).otherwise(chunk)
    return F.coalesce(chunk, F.lit(-(1 << 63)))


def index(df: DataFrame, by, order, *, label: str | None = None,
          run_order=None, event_col: str = "event", chunk_width=None,
          keep_internal: bool = True, unique_order: bool = False) -> DataFrame:
    """Add global series positions (and run ids when ``label`` is given).

    Adds ``_se_pos`` (0-based row number per ``by`` in ``order``), ``_se_peer``
    (0-based rank: position of the first peer).  With ``label``: ``event_col``
    = running count of label changes (change = label differs from the previous
    row's label; NULL on either side is no change), summed over a RANGE frame
    on ``run_order`` (a prefix of ``order``; defaults to ``order``), so peers
    share an id; and ``_se_estart`` = position of the run's first row.
    ``unique_order=True`` asserts that ``order`` is unique per entity and
    skips the row-hash tie-break (``row_tiebreak``).  ``chunk_width``: None or
    ``"auto"`` (ranges by row count), ``"rows:<n>"`` (the same with a target of
    n rows), a fixed width, ``"day"``, or 0 for one window per entity.
    """
    by = _cols(by)
    order = _cols(order)
    run_order = _cols(run_order) or order
    if order[:len(run_order)] != run_order:
        raise ValueError("run_order must be a prefix of order")

    cols = list(df.columns)
    if chunk_width is None or chunk_width == "auto" or str(chunk_width).startswith("rows:"):
        target = int(str(chunk_width)[5:]) if str(chunk_width).startswith("rows:") else None
        # the order of the rows is total: a border may lie between any two of them
        tied = df if unique_order else df.withColumn("_se_tb", row_tiebreak(df))
        base = ranged(tied, by, order if unique_order else [*order, "_se_tb"], target)
        if base is None:
            return _index_whole(df, by, order, label, run_order, event_col, keep_internal, unique_order)
    elif chunk_width == 0:
        return _index_whole(df, by, order, label, run_order, event_col, keep_internal, unique_order)
    else:
        base = df.withColumn(_CHUNK, chunk_expr(df, order[0], chunk_width))
        base = base if unique_order else base.withColumn("_se_tb", row_tiebreak(df))
    x, by = _plain_keys(base, by)
    w = Window.partitionBy(*by, _CHUNK).orderBy(*order, *([] if unique_order else ["_se_tb"]))
    wk = Window.partitionBy(*by, _CHUNK).orderBy(*order)  # peers share a rank
    first = {"_se_rn": F.row_number().over(w), "_se_rk": F.rank().over(wk)}
    if label is not None:
        first["_se_ind"] = F.coalesce((F.col(label) != F.lag(label).over(w)).cast("long"), F.lit(0).cast("long"))
        wr = Window.partitionBy(*by, _CHUNK).orderBy(*run_order)
        if run_order != order:
            first["_se_rr"] = F.rank().over(wr)  # first row of the run order's peers
        x = (x.withColumns(first)
              .withColumn("_se_lr", F.sum("_se_ind").over(wr.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("_se_mk", F.when(F.col("_se_lr") != F.lag("_se_lr").over(w), F.col("_se_rn")))
              .withColumn("_se_lm", F.max("_se_mk").over(
                  w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
        if run_order == order:
            x = x.withColumn("_se_rr", F.col("_se_rk"))
    else:
        x = x.withColumns(first)
    y = x.join(_chunk_table(x, by, order, run_order, label), [*by, _CHUNK])
    out = [F.col(c) for c in cols]
    if keep_internal:
        out += [(F.col("_se_off") + F.col("_se_rn") - 1).alias(POS),
                F.when(F.col("_se_rk") == 1, F.col("_se_peer0")).otherwise(F.col("_se_off") + F.col("_se_rk") - 1).alias(PEER)]
    if label is not None:
        # rows of the chunk's last peer group also count the indicators of its peers in later chunks
        tail = F.when(F.col("_se_rr") == F.col("_se_lg"), F.col("_se_tail")).otherwise(F.lit(0).cast("long"))
        out.append((F.col("_se_E") + F.col("_se_lr") + tail).cast("long").alias(event_col))
        if keep_internal:
            out.append(F.when((tail > 0) & (F.col("_se_lg") > 1), F.col("_se_off") + F.col("_se_lg") - 1).otherwise(
                F.coalesce(F.col("_se_off") + F.col("_se_lm") - 1, F.when(F.col("_se_fnew"), F.col("_se_off")),
                           F.col("_se_carry"))).alias(ESTART))
    return y.select(*out)


def _chunk_table(x: DataFrame, by, order, run_order, label) -> DataFrame:
    """What the chunks before and after a chunk add to its rows, one row per chunk.

    ``_se_off`` rows before it; ``_se_peer0`` position of the first peer of its
    first row; with a label also ``_se_E`` indicators before its first row (the
    border's own included), ``_se_lg`` where its last peer group starts,
    ``_se_tail`` indicators of that group's peers in later chunks, ``_se_fnew``
    whether its first row starts a run, ``_se_carry`` where the run before starts."""
    wc = Window.partitionBy(*by).orderBy(_CHUNK)  # over the chunks of one entity
    prev = wc.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    aggs = {"_se_n": F.count(F.lit(1)), "_se_fo": F.min_by(F.struct(*order), "_se_rn"),
            "_se_lo": F.max_by(F.struct(*order), "_se_rn"), "_se_lork": F.max("_se_rk")}
    if label is not None:
        aggs |= {"_se_first": F.min_by(label, "_se_rn"), "_se_last": F.max_by(label, "_se_rn"),
                 "_se_nind": F.max("_se_lr"), "_se_lr0": F.min_by("_se_lr", "_se_rn"), "_se_lmmax": F.max("_se_mk"),
                 "_se_lg": F.max("_se_rr"), "_se_fr": F.min_by(F.struct(*run_order), "_se_rn"),
                 "_se_lrv": F.max_by(F.struct(*run_order), "_se_rn")}
    t = x.groupBy(*by, _CHUNK).agg(*[v.alias(k) for k, v in aggs.items()])
    t = t.withColumns({"_se_off": F.coalesce(F.sum("_se_n").over(prev), zero).cast("long"),
                       "_se_goes_on": F.col("_se_fo").eqNullSafe(F.lag("_se_lo").over(wc))})
    # start of the last peer group, where it lies in the chunk
    t = t.withColumn("_se_gs", F.when(F.col("_se_lork") > 1, F.col("_se_off") + F.col("_se_lork") - 1)
                     .when(~F.col("_se_goes_on"), F.col("_se_off")))
    t = t.withColumn("_se_peer0", F.when(F.col("_se_goes_on"), F.last("_se_gs", ignorenulls=True).over(prev))
                     .otherwise(F.col("_se_off")))
    if label is None:
        return t.select(*by, _CHUNK, "_se_off", "_se_peer0")
    border = F.coalesce((F.col("_se_first") != F.lag("_se_last").over(wc)).cast("long"), zero)
    t = t.withColumns({"_se_b": border, "_se_link": F.col("_se_fr").eqNullSafe(F.lag("_se_lrv").over(wc))})
    t = t.withColumn("_se_E", F.coalesce(F.sum(F.col("_se_nind") + F.col("_se_b")).over(prev), zero) + F.col("_se_b"))
    # stretches of chunks that one peer group fills: a chunk goes on with the stretch of
    # the chunk before if that is wholly of the group
    broken = ~(F.col("_se_link") & (F.lag("_se_lg").over(wc) == 1))
    t = t.withColumn("_se_seg", F.sum(F.coalesce(broken, F.lit(True)).cast("long")).over(
        wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ahead = Window.partitionBy(*by, "_se_seg").orderBy(_CHUNK).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn("_se_ahead", F.sum(F.col("_se_b") + F.col("_se_lr0")).over(ahead))
    t = t.withColumn("_se_tail", F.coalesce(F.when(F.lead("_se_link").over(wc), F.lead("_se_ahead").over(wc)), zero))
    # event ids of the first and last row tell where a run goes on
    only = F.when(F.col("_se_lg") == 1, F.col("_se_tail")).otherwise(zero)
    t = t.withColumns({"_se_E0": F.col("_se_E") + F.col("_se_lr0") + only,
                       "_se_E1": F.col("_se_E") + F.col("_se_nind") + F.col("_se_tail")})
    t = t.withColumn("_se_fnew", F.coalesce(F.col("_se_E0") != F.lag("_se_E1").over(wc), F.lit(True)))
    t = t.withColumn("_se_cls", F.when((F.col("_se_tail") > 0) & (F.col("_se_lg") > 1), F.col("_se_off") + F.col("_se_lg") - 1)
                     .otherwise(F.coalesce(F.col("_se_off") + F.col("_se_lmmax") - 1, F.when(F.col("_se_fnew"), F.col("_se_off")))))
    return t.select(*by, _CHUNK, "_se_off", "_se_peer0", "_se_E", "_se_lg", "_se_tail", "_se_fnew",
                    F.last("_se_cls", ignorenulls=True).over(prev).alias("_se_carry"))


def placed(df: DataFrame, by, order, out: str) -> DataFrame:
    """Adds ``out``: the row's place (0-based, without gaps) in the order (``by``,
    ``order``) of all rows, rows equal in it in any order.  Rows are sorted once, in
    ranges by row count, and written with their number in the range; what the
    ranges before it hold is one number a range.  No entity is a group here, so a
    hot one costs nothing more, and the rows go through one shuffle and one table."""
    keys = [*_cols(by), *_cols(order), "_se_place"]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * df.count() // RANGE_ROWS))
    dealt = df.withColumn("_se_place", F.monotonically_increasing_id())  # parts rows that are equal in the order
    dealt = dealt.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_se_place")
    x = write_table(dealt.withColumn(out, F.monotonically_increasing_id()), "series-places")
    part = F.shiftright(out, 33)
    before = Window.orderBy("_se_part").rowsBetween(Window.unboundedPreceding, -1)
    per = x.groupBy(part.alias("_se_part")).agg(F.count(F.lit(1)).alias("_se_n"))
    per = per.select("_se_part", F.coalesce(F.sum("_se_n").over(before), F.lit(0)).alias("_se_off"))  # one row per task
    y = join_small(x, per, lambda big, side: F.shiftright(big[out], 33) == side["_se_part"])
    return y.withColumn(out, F.col("_se_off") + F.col(out) - F.shiftleft("_se_part", 33)).select(*x.columns)


def counted(df: DataFrame, by, order, flag: str, out: str, target_rows: int | None = None) -> DataFrame:
    """Adds ``out``: how many earlier rows of the entity have ``flag`` set, in
    ``order`` (rows equal in it follow each other by content).  Entities above
    the chunk target are cut like in ``index``."""
    by, order = _cols(by), _cols(order)
    tied = df.withColumn("_se_tb", row_tiebreak(df))
    one = F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0)).cast("long")
    base = ranged(tied, by, [*order, "_se_tb"], target_rows)
    if base is None:
        w = Window.partitionBy(*by).orderBy(*order, "_se_tb").rowsBetween(Window.unboundedPreceding, -1)
        return tied.withColumn(out, F.coalesce(F.sum(one).over(w), F.lit(0))).drop("_se_tb")
    x, keys = _plain_keys(base, by)
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order, "_se_tb").rowsBetween(Window.unboundedPreceding, -1)
    prev = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    table = x.groupBy(*keys, _CHUNK).agg(F.sum(one).alias("_se_n"))
    table = table.select(*keys, _CHUNK, F.coalesce(F.sum("_se_n").over(prev), F.lit(0)).alias("_se_off"))
    x = x.withColumn("_se_in", F.coalesce(F.sum(one).over(w), F.lit(0))).join(table, [*keys, _CHUNK])
    return x.select(*df.columns, (F.col("_se_off") + F.col("_se_in")).alias(out))


def _index_whole(df: DataFrame, by, order, label, run_order, event_col, keep_internal,
                 unique_order: bool = False) -> DataFrame:
    """``index`` when every entity is one chunk (no entity above the chunk
    target, or ``chunk_width=0``): one window pass per entity, no chunk
    table and no join.  Output stays hash-partitioned by the entity, so the
    blocked windows that follow need no further shuffle."""
    cols = [F.col(c) for c in df.columns]
    if unique_order:
        w = Window.partitionBy(*by).orderBy(*order)
    else:
        df = df.withColumn("_se_tb", row_tiebreak(df))
        w = Window.partitionBy(*by).orderBy(*order, "_se_tb")
    wk = Window.partitionBy(*by).orderBy(*order)  # peers share a rank
    if label is None:
        out = cols
        if keep_internal:
            out += [(F.row_number().over(w) - 1).cast("long").alias(POS),
                    (F.rank().over(wk) - 1).cast("long").alias(PEER)]
        return df.select(*out)
    wr = Window.partitionBy(*by).orderBy(*run_order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.withColumns({
        "_se_rn": F.row_number().over(w), "_se_rk": F.rank().over(wk),
        "_se_ind": F.coalesce((F.col(label) != F.lag(label).over(w)).cast("long"), F.lit(0).cast("long"))})
    x = x.withColumn(event_col, F.sum("_se_ind").over(wr).cast("long"))
    if not keep_internal:
        return x.select(*cols, event_col)
    x = x.withColumn("_se_mk", F.when(F.col(event_col) != F.lag(event_col).over(w), F.col("_se_rn")))
    start = F.coalesce(F.max("_se_mk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1,
                       F.lit(0).cast("long"))
    return x.select(*cols, (F.col("_se_rn") - 1).cast("long").alias(POS),
                    (F.col("_se_rk") - 1).cast("long").alias(PEER), event_col,
                    start.cast("long").alias(ESTART))


def blocked(df: DataFrame, halo: int, block_rows: int = DEFAULT_BLOCK_ROWS,
            pos: str = POS) -> DataFrame:
    """Assign ``_se_blk`` = position // B and copy the last ``halo`` rows of
    each block into the next one (``_se_halo`` = True on copies)."""
    halo = max(int(halo), 0)
    size = max(int(block_rows), halo, 1)
    p = F.col(pos)
    blk = F.floor(p / F.lit(size)).cast("long")
    own = F.struct(blk.alias("b"), F.lit(False).alias("h"))
    if halo == 0:
        return df.withColumns({BLOCK: blk, HALO: F.lit(False)})
    nxt = F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))
    copies = F.when((p % F.lit(size)) >= F.lit(size - halo), F.array(own, nxt)).otherwise(F.array(own))
    x = df.select("*", F.explode(copies).alias("_se_bh"))
    return x.select(*[F.col(c) for c in df.columns], F.col("_se_bh.b").alias(BLOCK),
                    F.col("_se_bh.h").alias(HALO))


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(POS, PEER, ESTART, BLOCK, HALO)
