"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether a relation has no more than that many rows; looks at one row past the limit at most."""
    return df.limit(rows + 1).count() <= rows
