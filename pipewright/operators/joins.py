"""Join helpers.

Id lists are never collected to the driver: membership is a semi or anti join,
and a "NOT IN (subquery)" keeps SQL's null-aware meaning when asked to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKUP_ROWS = 200_000  # narrow rows of a lookup table: some tens of MB at most
SALTS = 32


def fits(dim: DataFrame, limit: int = LOOKUP_ROWS) -> bool:
    """Whether a lookup table has at most ``limit`` rows (counted no further)."""
    return dim.limit(limit + 1).count() <= limit


def sized(dim: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame:
    """``dim``, marked for broadcast if it is small enough."""
    return F.broadcast(dim) if fits(dim, limit) else dim


def lookup(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, spread: Column, limit: int = LOOKUP_ROWS,
           salts: int = SALTS) -> DataFrame:
    """``df`` LEFT JOIN ``dim`` (one row per ``right_key``) where a few keys may hold most rows of ``df``.

    A small ``dim`` is broadcast after counting it, so ``df`` is not exchanged.
    A larger one is joined on the key and one of ``salts`` parts that ``spread``
    (an id of the row) deals the rows to, so a hot key's rows go to many tasks.
    """
    if fits(dim, limit):
        return df.join(F.broadcast(dim), df[left_key] == dim[right_key], "left")
    parts = dim.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    dealt = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    return dealt.join(parts, (dealt[left_key] == parts[right_key]) & (F.col("__salt") == F.col("__part")), "left").drop("__salt", "__part")


def anti(df: DataFrame, ids: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids``.

    A NULL key on the left is kept (it matches nothing); an empty ``ids``
    excludes nothing. Use :func:`sql_not_in` for the null-aware SQL meaning.
    """
    right_key = right_key or left_key
    r = ids.select(F.col(right_key).alias("__anti_key"))
    return df.join(r, df[left_key] == r["__anti_key"], "left_anti")


def sql_not_in(df: DataFrame, ids: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """SQL ``key NOT IN (SELECT ...)``.

    A NULL left key is dropped when the subquery has rows; a NULL in the
    subquery drops every row. Planned as an equi anti join (hash or sort-merge,
    so it scales with both sides) plus two scalar EXISTS subqueries, instead of
    an OR condition that would need a nested-loop join.
    """
    right_key = right_key or left_key
    r = ids.select(F.col(right_key).alias("__nin_key"))
    kept = df.join(r, df[left_key] == r["__nin_key"], "left_anti")
    has_rows = r.exists()
    has_null = r.where(F.col("__nin_key").isNull()).exists()
    return kept.where((F.col(left_key).isNotNull() | ~has_rows) & ~has_null)
