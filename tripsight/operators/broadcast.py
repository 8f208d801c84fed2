"""Broadcast only behind a size bound.

A side is hinted for broadcast only when its row count has a bound that does
not grow with the data (a dimension of fixed size, or a map keyed by a domain
the cleaning rules cap). Everything else is left to AQE, which re-plans a join
as broadcast at run time only after measuring the shuffled side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows we accept to ship to every executor (a few MB at most)
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, row_bound: int) -> DataFrame:
    """Hint a broadcast of a side with a proven ``row_bound`` that doesn't depend on the data."""
    if row_bound > MAX_BROADCAST_ROWS:
        raise ValueError(f"{row_bound} rows are too many to hint a broadcast for")
    return F.broadcast(df)
