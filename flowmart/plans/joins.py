"""Size-checked broadcast for dimension lookups.

A dimension is broadcast only when its *counted* row count is within a bound; beyond it
the plain DataFrame is returned and Catalyst/AQE plan a shuffle join instead. Counts are
taken once on materialised (written) dimensions, so the check is cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions with at most this many rows are broadcast (a 65,536-port dimension is
# ~4 MB; the bound keeps a broadcast under a few tens of MB per executor).
BROADCAST_MAX_ROWS = 500_000


def sized(df: DataFrame, rows: int, limit: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``rows <= limit`` else ``df`` (shuffle join)."""
    return F.broadcast(df) if rows <= limit else df
