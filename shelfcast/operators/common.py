"""Small shared helpers for joins and one-row aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a dimension-like side is not broadcast (a shuffle join is
# used instead). Kept well under what an executor holds comfortably.
BROADCAST_MAX_ROWS = 2_000_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows of a small dimension table;
    beyond the bound the caller's join falls back to a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def one_row(df: DataFrame) -> DataFrame:
    """Mark a global (no grouping) aggregate for broadcast: it has one row."""
    return F.broadcast(df)


def date_spine(bounds: DataFrame, lo: str, hi: str, name: str = "date") -> DataFrame:
    """Daily dates from ``lo`` to ``hi`` (inclusive) of a one-row frame (G1).

    The spine has one row per day of the span, a bound independent of the data
    volume, so it is safe to broadcast."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias(name))
