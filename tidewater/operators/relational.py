"""Small relational helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many rows a side gets no hint; AQE decides from measured bytes.
BROADCAST_MAX_ROWS = 10_000


def bounded_broadcast(df: DataFrame, proven_rows: int) -> DataFrame:
    """Hint a broadcast for a side of narrow rows whose number is bounded by the plan
    (``proven_rows``: a ``limit``, a fixed list, a group count over a closed domain)."""
    return F.broadcast(df) if proven_rows <= BROADCAST_MAX_ROWS else df
