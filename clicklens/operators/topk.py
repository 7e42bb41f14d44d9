"""Leading rows, of a whole result or of each group.

Both forms with groups filter on a bound of the row number or rank, so Spark
cuts every task's rows down to the bound before it brings a group together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(rows: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first rows in ``order``."""
    return rows.orderBy(*order).limit(k)


def top_within(
    rows: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
    position: str = "position",
) -> DataFrame:
    """At most ``k`` rows of each group, numbered from 1; ``order`` must break ties."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)


def rank_within(
    rows: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
    rank: str = "rank",
) -> DataFrame:
    """Rows of rank 1 to ``k`` in each group; equals share a rank, so it may be more rows."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return rows.withColumn(rank, F.rank().over(window)).where(F.col(rank) <= k)
