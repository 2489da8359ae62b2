"""Tables of one day each, found in the catalog by name and bound into one.

A CRM copy may be kept as one table per day (``snapshot_20240131``). The tables
of a window are found from the catalog's names alone, and bound by column name:
a column that a day's table lacks is NULL for that day, and columns whose number
types differ get the wider one. The day comes from the name, so no row is read
to find it.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.operators.reshape import union_all_by_name
from pipewright.sources.publish import Folder


def _day(text: str) -> dt.date | None:
    try:
        return dt.datetime.strptime(text, "%Y%m%d").date()
    except ValueError:
        return None


def find_dated(spark: SparkSession, prefix: str, start: dt.date, end: dt.date, database: str | None = None) -> list[tuple[dt.date, str]]:
    """(day, table) of the catalog tables and views named ``<prefix>YYYYMMDD`` with ``start <= day < end``, by day."""
    found = []
    for t in spark.catalog.listTables(database, f"{prefix}*"):
        if m := re.fullmatch(re.escape(prefix) + r"(\d{8})", t.name, re.IGNORECASE):
            day = _day(m[1])
            if day is not None and start <= day < end:
                found.append((day, t.name if t.isTemporary or database is None else f"{database}.{t.name}"))
    return sorted(found)


def bind_dated(spark: SparkSession, tables: list[tuple[dt.date, str]], day_column: str = "snapshot_date") -> DataFrame:
    """All rows of ``tables``, with their table's day in ``day_column``."""
    if not tables:
        raise ValueError("no table of the window")
    return union_all_by_name([spark.table(name).withColumn(day_column, F.lit(day)) for day, name in tables])


def partition_days(spark: SparkSession, path: str, start: dt.date, end: dt.date, column: str = "snapshot_date") -> list[dt.date]:
    """Days that a partitioned table holds in the window, from the names of its folders."""
    days = (n.partition("=")[2] for n in Folder(spark, path).names() if n.startswith(f"{column}="))
    return sorted(d for d in map(dt.date.fromisoformat, days) if start <= d < end)
