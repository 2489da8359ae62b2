"""Complete groups: every level of a fixed dimension for each observed key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete_levels(stats: DataFrame, observed: DataFrame, keys: list[str], level_col: str,
                    levels: list[str]) -> DataFrame:
    """Rows for every (observed key combination, level), stats NULL where absent.

    The level list is a fixed literal, so the key x level grid is generated
    by exploding a literal array per observed key (no join of two tables);
    the stats are then matched null-safely on the keys and the level.
    """
    grid = observed.select(*keys).distinct().withColumn(level_col, F.explode(F.array(*[F.lit(x) for x in levels])))
    s = stats.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.col(level_col).alias("__s_level"),
                     *[c for c in stats.columns if c not in keys and c != level_col])
    cond = F.col("__s_level") == F.col(level_col)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__s_{k}"))
    out = grid.join(s, cond, "left")
    return out.drop(*[f"__s_{k}" for k in keys], "__s_level")


def level_stats(df: DataFrame, keys: list[str], values: dict[str, Column], level_col: str, rank_col: str) -> DataFrame:
    """Mean and exact median of one value per level and key combination, every level present: one row per
    observed key combination and level, NULL where the level has no value.

    ``values`` maps each level of a fixed list to its value in a row. All levels are aggregated in one pass and then
    exploded, so the input is read and shuffled once and nothing is joined. The median's state is a histogram
    (value -> count), merged map-side: its size is the number of different values, not of rows.
    """
    measures = [f(v).alias(f"__{name}{i}") for i, v in enumerate(values.values()) for name, f in (("mean", F.avg), ("median", F.median))]
    per = df.groupBy(*keys).agg(*measures)
    rows = F.array(*[F.struct(F.lit(level).alias(level_col), F.lit(i + 1).alias(rank_col), F.col(f"__mean{i}").alias("mean"),
                              F.col(f"__median{i}").alias("median")) for i, level in enumerate(values)])
    return per.select(*keys, F.inline(rows))
