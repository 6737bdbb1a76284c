"""Size checks behind plan choices: what may be broadcast, and what fits one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension row here is a key and a few numbers, so this many rows stay well below 100 MB.
BROADCAST_ROWS = 500_000


def group_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of all groups: a pre-aggregated count over the key columns, of which one row
    comes back."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return largest or 0, total or 0


def join_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    n_rows: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a dimension: broadcast if the caller knows it to have at most `limit` rows. Runs no job.

    Otherwise the planner decides: adaptive execution broadcasts a side that turns out small, and splits a partition in
    which a hot key gathers.
    """
    small = n_rows is not None and n_rows <= limit
    return rows.join(F.broadcast(dimension) if small else dimension, on, how)
