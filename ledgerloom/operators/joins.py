"""Join with a side that is expected to be small, without betting on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows of a few dozen bytes each: a few megabytes per executor.
BROADCAST_ROWS = 100_000


def broadcast_if_small(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark `side` for broadcast only after counting it.

    The count stops at max_rows + 1. A larger side is returned unmarked; the
    join is then a shuffle join, where AQE splits a hot key of the other side.
    """
    if side.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(side)
    return side
