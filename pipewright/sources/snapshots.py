"""The dated snapshot table.

A daily copy of the opportunity object, stored as one table partitioned by
``snapshot_date`` (instead of one table per day). Reads name a date window, so
only those partitions are listed and scanned (partition pruning); appending a
day overwrites just that day's partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshots(df: DataFrame, path: str) -> None:
    """Write (or replace) the days present in ``df``; other days are kept."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("snapshot_date").parquet(path))


def read_snapshots(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """Snapshots with ``start <= snapshot_date < end`` (pruned at listing time)."""
    return (spark.read.parquet(path)
                 .where((F.col("snapshot_date") >= F.lit(start)) & (F.col("snapshot_date") < F.lit(end))))


def read_snapshot_at(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """Point-in-time read of one day."""
    return spark.read.parquet(path).where(F.col("snapshot_date") == F.lit(day))


def snapshot_days(snapshots: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Days available between ``start`` (incl.) and ``end`` (excl.), ordered.

    Distinct partition values only: bounded by the number of days, not rows.
    """
    return (snapshots.where((F.col("snapshot_date") >= F.lit(start)) & (F.col("snapshot_date") < F.lit(end)))
                     .select("snapshot_date").distinct().orderBy("snapshot_date"))
