"""Size checks that must pass before anything is broadcast by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows of the narrow (five-column) device dimension that fit every executor with room to spare.
BROADCAST_ROWS = 500_000


def at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has at most ``rows`` rows. Tasks send their counts, no rows."""
    return df.count() <= rows
