"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, UserDefinedType

# A side is broadcast only when it is proven to hold at most this many rows
# and, in Arrow's form, this many bytes.
DEFAULT_BROADCAST_ROWS = 50_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _arrow_can_carry(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return all(_arrow_can_carry(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _arrow_can_carry(dtype.elementType)
    if isinstance(dtype, MapType):
        return _arrow_can_carry(dtype.keyType) and _arrow_can_carry(dtype.valueType)
    return not isinstance(dtype, UserDefinedType)


def materialize_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame | None:
    """Compute ``df`` once with a LIMIT of ``max_rows + 1``.  If it fits, return
    the rows as a local relation (no recomputation later, safe to broadcast);
    else ``None`` — the caller keeps the distributed plan.  Columns that Arrow
    cannot carry (ML vectors) go as rows, bounded by rows alone."""
    limited = df.limit(int(max_rows) + 1)
    if not _arrow_can_carry(df.schema):
        head = limited.collect()
        return None if len(head) > max_rows else df.sparkSession.createDataFrame(head, df.schema)
    # Arrow keeps timestamps as UTC instants (no local-time round trip)
    table = limited.toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    ``small`` is computed once; when it has at most ``max_rows`` rows it is
    broadcast as a local relation, otherwise a shuffle join is left to the
    planner (AQE splits skewed partitions there).  ``on`` is a list of column
    names or ``f(big, small)`` giving a Column or a list of them.
    """
    local = materialize_small(small, max_rows)
    side = F.broadcast(local) if local is not None else small
    cond = on if isinstance(on, (str, list, tuple, Column)) else on(big, side)
    return big.join(side, cond, how)
