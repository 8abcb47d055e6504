"""Fact-to-dimension joins with a checked broadcast.

A dimension is broadcast only when the tables it is derived from are small in bytes, as their file
listing says (the leaves of its plan).  That takes no job and remembers nothing, so a table that
has grown is seen at the next plan.  A dimension built here multiplies its tables by a constant at
most (a station by its point catalogue).  Above the bound the join is a shuffle join, and AQE
(skew split, coalescing) takes over.  Fixed literal tables (the 26 patterns) are broadcast
directly by their callers: their size is a constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the source tables of a dimension that is shipped to every executor.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads; those of literal rows are counted as well."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return source_bytes(df) <= max_bytes


def maybe_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when ``dim`` is proven small."""
    return F.broadcast(dim) if is_small(dim, max_bytes) else dim


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``fact.join(dim, on, how)`` broadcasting ``dim`` only behind a size check."""
    return fact.join(maybe_broadcast(dim, max_bytes), on, how)
