"""Join helpers that broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (counts at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left", max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join a lookup table: broadcast it when its row count is proven small,
    otherwise a shuffle join (which AQE may still turn into a broadcast)."""
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
