"""Column alignment and unions of frames with different columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def keep_common_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """Only the columns of ``df`` that ``other`` also has (case-sensitive names)."""
    names = set(other.columns)
    return df.select(*[f"`{c}`" for c in df.columns if c in names])


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    """Row-bind by column name; a column missing from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def check_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """Select ``expected`` in order; fail on any column outside it."""
    extra = [c for c in df.columns if c not in expected]
    if extra:
        raise ValueError(f"unexpected columns: {extra}")
    return df.select(*expected)


def prefix_columns(df: DataFrame, prefix: str, keep: tuple = ()) -> DataFrame:
    """Prefix every column name except those in ``keep``."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def rename_substring(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace ``old`` by ``new`` inside every column name that contains it."""
    return df.withColumnsRenamed({c: c.replace(old, new) for c in df.columns if old in c})
