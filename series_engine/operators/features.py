"""Moving averages, lag arrays, strided row selection and the fused
run → smooth → lag → stride chain.  All windows run on bounded groups
(chunks or blocks of one entity), see ``sequence``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sequence
from .sequence import BLOCK, ESTART, HALO, PEER, POS


def _block_window(by, inner=()):
    return Window.partitionBy(*sequence._cols(by), BLOCK, *inner).orderBy(POS)


def smooth(df: DataFrame, cols, period: int, by=None, order=None, *,
           chunk_width=None, block_rows: int = sequence.DEFAULT_BLOCK_ROWS,
           unique_order: bool = False) -> DataFrame:
    """Replace each column by its average over the current row and the
    ``period`` rows before it (so ``period + 1`` rows; fewer at the start of
    the series).  Result type is double."""
    cols = sequence._cols(cols)
    x = sequence.index(df, by, order, chunk_width=chunk_width, unique_order=unique_order)
    x = sequence.blocked(x, halo=period, block_rows=block_rows)
    w = _block_window(by).rowsBetween(-int(period), Window.currentRow)
    x = x.withColumns({c: F.avg(F.col(c)).over(w) for c in cols})
    return sequence.drop_internal(x.filter(~F.col(HALO)))


def lags(df: DataFrame, cols, n: int, by=None, order=None, *, suffix: str = "_lags",
         complete_only: bool = True, chunk_width=None,
         block_rows: int = sequence.DEFAULT_BLOCK_ROWS, unique_order: bool = False) -> DataFrame:
    """Add ``<col><suffix>``: array of the ``n`` previous values, latest first
    (element i-1 is ``lag(col, i)``).  With ``complete_only`` rows with fewer
    than ``n`` predecessors are dropped — the same rows a lag-column form
    loses to a null filter, provided the inputs hold no NULL."""
    cols = sequence._cols(cols)
    x = sequence.index(df, by, order, chunk_width=chunk_width, unique_order=unique_order)
    x = sequence.blocked(x, halo=n, block_rows=block_rows)
    w = _block_window(by).rowsBetween(-int(n), -1)
    x = x.withColumns({f"{c}{suffix}": F.reverse(F.collect_list(F.col(c)).over(w)) for c in cols})
    x = x.filter(~F.col(HALO))
    if complete_only:
        for c in cols:
            x = x.filter(F.size(f"{c}{suffix}") == int(n))
    return sequence.drop_internal(x)


def stride(df: DataFrame, step: int, by=None, order=None, *, rank_col: str = "rank",
           chunk_width=None, unique_order: bool = False) -> DataFrame:
    """Keep one row every ``step`` rows: ``rank`` per entity in ``order`` with
    ``rank % step == 0``.  Peers share a rank (gaps follow); the first kept
    row is rank ``step``; ``rank_col`` stays in the output."""
    x = sequence.index(df, by, order, chunk_width=chunk_width, unique_order=unique_order)
    x = x.withColumn(rank_col, (F.col(PEER) + 1).cast("int"))
    return sequence.drop_internal(x.filter(F.col(rank_col) % int(step) == 0))


def lag_columns(df: DataFrame, array_col: str, name: str, n: int) -> DataFrame:
    """Spread a lag array into ``name_1 … name_n`` columns."""
    return df.withColumns({f"{name}_{i}": F.col(array_col)[i - 1] for i in range(1, n + 1)})


# From this stride on lag arrays are built at the kept rows only.
SPARSE_STEP = 4
# Rows per block (besides the halo) when arrays are cut from a block's values.
SPARSE_BLOCK_ROWS = 8192


def event_features(df: DataFrame, cols, by, order, label: str, *, period: int, n: int,
                   step: int, event_col: str = "event", run_order=None,
                   suffix: str = "_lags", rank_col: str | None = "rank",
                   chunk_width=None, block_rows: int = sequence.DEFAULT_BLOCK_ROWS,
                   unique_order: bool = False, complete_axes: bool = False) -> DataFrame:
    """Runs of ``label`` → per-run moving average (``period``) of ``cols``
    → ``n`` lags of the averages → drop rows lacking a full lag window
    → keep every ``step``-th remaining row of each run.

    One chunked pass numbers rows and runs, one blocked pass (halo
    ``period + n`` rows) computes averages and lags.  The stride rank is the
    rank inside the run among rows that kept a full window.  Without NULL in
    the axes that rank is known from the positions, so the first kept row of
    a run is its ``n + step``-th row, and for wide strides the arrays are cut
    from a block's values at the kept rows alone.  Axes with NULL lose rows in
    between; the remaining rows are then numbered anew.  ``complete_axes=True``
    asserts that there is none and saves the look.  Averaged ``cols`` replace
    the inputs (double).
    """
    cols, by, order = sequence._cols(cols), sequence._cols(by), sequence._cols(order)
    n, step = int(n), int(step)
    gaps = F.lit(False)
    for c in cols:
        gaps = gaps | F.col(c).isNull()
    complete_axes = complete_axes or df.filter(gaps).limit(1).count() == 0
    x = sequence.index(df, by, order, label=label, run_order=run_order,
                       event_col=event_col, chunk_width=chunk_width, unique_order=unique_order)
    sparse = complete_axes and step >= SPARSE_STEP
    if sparse:
        block_rows = min(block_rows, max(SPARSE_BLOCK_ROWS, 16 * (int(period) + n)))
    x = sequence.blocked(x, halo=int(period) + n, block_rows=block_rows)
    base = _block_window(by, inner=[event_col])
    x = x.withColumns({c: F.avg(F.col(c)).over(base.rowsBetween(-int(period), Window.currentRow))
                       for c in cols})
    internal = {POS, PEER, ESTART, BLOCK, HALO}
    out = [c for c in x.columns if c not in internal]
    # rank inside the run among rows that kept a full window
    rank = lambda row: (F.greatest(row(PEER) - row(ESTART) - F.lit(n), F.lit(0)) + 1).cast("int")
    if sparse:
        return _sparse_lags(x, cols, by, event_col, n, step, suffix, out, rank, rank_col)
    x = x.withColumns({f"{c}{suffix}": F.reverse(F.collect_list(F.col(c)).over(base.rowsBetween(-n, -1)))
                       for c in cols})
    keep = ~F.col(HALO)
    for c in cols:
        keep = keep & (F.size(f"{c}{suffix}") == n) & F.col(c).isNotNull()
    out += [f"{c}{suffix}" for c in cols]
    if complete_axes:
        kept = x.filter(keep & (rank(F.col) % step == 0))
        return kept.select(*out, *([rank(F.col).alias(rank_col)] if rank_col else []))
    left = sequence.index(x.filter(keep).select(*out), list(dict.fromkeys([*by, event_col])), order,
                          unique_order=unique_order)
    place = (F.col(PEER) + 1).cast("int")
    return left.filter(place % step == 0).select(*out, *([place.alias(rank_col)] if rank_col else []))


def _sparse_lags(x: DataFrame, cols, by, event_col: str, n: int, step: int, suffix: str, out, rank,
                 rank_col: str | None) -> DataFrame:
    """The kept rows of each block with their lag arrays: a block's rows are
    gathered in order once (on the partitioning the averages already have)
    and each kept row takes a slice of the block's values."""
    keys = list(dict.fromkeys([*by, BLOCK, event_col]))
    rest = [c for c in x.columns if c not in keys and c != POS]
    # only the position orders the rows: it is unique in a block
    packed = F.struct(F.col(POS), F.struct(*rest).alias("row"))
    groups = x.groupBy(*keys).agg(F.collect_list(packed).alias("_se_rows"))
    ordered = F.array_sort("_se_rows", lambda a, b: (a[POS] - b[POS]).cast("int"))

    def cut(rows):
        numbered = F.transform(rows, lambda r, i: F.struct(r["row"].alias("row"), i.alias("i")))
        kept = F.filter(numbered, lambda r: ~r["row"][HALO] & (r["i"] >= n) & (rank(lambda c: r["row"][c]) % step == 0))

        def sliced(values):
            return F.transform(kept, lambda r: F.struct(r["row"].alias("row"), *[
                F.reverse(F.slice(values[c], r["i"] - n + 1, n)).alias(f"{c}{suffix}") for c in cols]))
        def value(c):
            return F.transform(rows, lambda r: r["row"][c]).alias(c)
        values = F.struct(*[value(c) for c in cols])
        return F.element_at(F.transform(F.array(values), sliced), 1)

    found = groups.select(*keys, F.explode(F.element_at(F.transform(F.array(ordered), cut), 1)).alias("_se_x"))
    row = lambda c: F.col(c) if c in keys else F.col("_se_x.row").getField(c)
    return found.select(*[row(c).alias(c) for c in out], *[F.col("_se_x").getField(f"{c}{suffix}").alias(f"{c}{suffix}") for c in cols],
                        *([rank(row).alias(rank_col)] if rank_col else []))


def assemble(df: DataFrame, array_cols, out: str = "features") -> DataFrame:
    """Concatenate lag arrays (in the given column order) into an ML vector."""
    from pyspark.ml.functions import array_to_vector
    arrays = [F.col(c).cast("array<double>") for c in sequence._cols(array_cols)]
    return df.withColumn(out, array_to_vector(F.concat(*arrays)))
