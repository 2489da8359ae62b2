"""Top-N rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group under a total ``order``.

    ``row_number() <= n`` is planned by Spark as a window group limit: each
    map task keeps at most ``n`` rows per group before the shuffle, so a group
    holding a large share of all rows sends only ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
