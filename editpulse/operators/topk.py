"""Top-k, global and per group, always with a total order.

Global: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject, a
k-bounded heap per task and a k x tasks merge.  Per group: ``row_number``
with a ``<= k`` filter, which Spark plans with a partial WindowGroupLimit
before the shuffle, so a hot group ships at most k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    if k < 1:
        raise ValueError("k must be >= 1")
    return df.orderBy(*order).limit(int(k))


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked ``1..k`` within each group, rank in ``rank_col``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= int(k))
