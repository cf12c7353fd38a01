"""Joins against small derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.session import materialize

# Bytes (as written to Parquet) and rows that a side may have and still be broadcast.
BROADCAST_MAX_BYTES = 16 << 20
BROADCAST_MAX_ROWS = 500_000


def table_bytes(table: DataFrame) -> int:
    """Size of the files under a table that was read from files."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_checked_broadcast(big: DataFrame, small: DataFrame, on: Column | list, how: str = "left",
                           max_bytes: int = BROADCAST_MAX_BYTES, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` to ``small``, broadcasting ``small`` only after its size is
    proven.

    ``small`` is written to the shared scratch folder (computed once); its
    files' bytes and their row count decide between a broadcast and an ordinary
    shuffle join.  The static planner cannot know that an aggregate over a huge
    table is tiny, so without this it would shuffle ``big`` on the join key,
    which for a handful of keys means a handful of giant tasks.
    """
    small = materialize(small, "join_side")
    fits = table_bytes(small) <= max_bytes and small.count() <= max_rows
    return big.join(F.broadcast(small) if fits else small, on, how)
