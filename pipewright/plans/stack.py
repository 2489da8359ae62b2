"""Snapshot calendar and the stack of current deals on their anchor snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions.money import format_money
from pipewright.functions.periods import ReportParams, col_in_zone, col_shard_suffix, in_window
from pipewright.operators.reshape import check_columns, keep_common_columns, rename_substring, union_all_by_name
from pipewright.sources import crm, snapshots
from pipewright.sources.dated import bind_dated, find_dated

ZONE = "America/New_York"
STACK_COLUMNS = ["origin", "Id", "snapshot_date", "StageName", "Type", "CloseDate", "SAO_Date", "Category", "Name",
                 "AccountId", "OwnerId", "Renewal_Type", "Bookings", "Managers_Forecast", "Test_Account",
                 "CurrencyIsoCode", "qb_usd", "qb_text"]


def snapshot_calendar(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """A5: the days that the snapshot table holds in the window, the suffix of each day's table and the local time it was taken."""
    snaps = crm.snapshot_window(spark, sf_dir, p.anchor, p.q_end)
    days = snapshots.snapshot_days(snaps, p.anchor, p.q_end)
    taken = F.col("snapshot_date").cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    return days.select("snapshot_date", col_shard_suffix(F.col("snapshot_date")).alias("table_suffix"),
                       F.date_format(col_in_zone(taken, ZONE), "yyyy-MM-dd HH:mm").alias("taken_local"))


def deal_stack(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Deals closing in the quarter as they are now and as they were at the anchor, bound by column name.

    The current rows keep the columns that the snapshot has too (B5); what a
    side lacks is NULL; the USD amount is also given as text (H20).
    """
    snap = crm.history(spark, sf_dir, [p.anchor])
    now = keep_common_columns(crm.opportunity(spark, sf_dir), snap).withColumn("origin", F.lit("current"))
    then = snap.select(F.lit("anchor").alias("origin"), "Id", "snapshot_date", "StageName", "CloseDate", "Category", "qb_usd")
    both = union_all_by_name([d.where(in_window(F.col("CloseDate"), p.q_start, p.q_end)) for d in (now, then)])
    both = both.withColumn("qb_text", format_money(F.col("qb_usd")))
    return check_columns(rename_substring(both, "ACV_", ""), STACK_COLUMNS)


DATED = "opportunity_snapshot_"
DATED_COLUMNS = ["Id", "StageName", "CloseDate", "Category", "Type", "qb_usd"]


def register_dated(spark: SparkSession, sf_dir: str, p: ReportParams) -> None:
    """The snapshot table as one view per day (test data): the window's days, the last without Category, and the day before the window."""
    days = crm.fixture_snapshot_days(p.anchor, p.q_end)
    window, before = crm.history(spark, sf_dir, days), p.anchor - dt.timedelta(days=1)
    for day in [before, *days]:
        snaps = crm.history(spark, sf_dir, [before]) if day == before else window.where(F.col("snapshot_date") == F.lit(day))
        columns = [c for c in DATED_COLUMNS if day != days[-1] or c != "Category"]
        snaps.select(*columns).createOrReplaceTempView(f"{DATED}{day:%Y%m%d}")


def dated_snapshots(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """The daily tables of the window, found by name and bound; deals closing in the quarter as each day saw them."""
    register_dated(spark, sf_dir, p)
    bound = bind_dated(spark, find_dated(spark, DATED, p.anchor, p.q_end))
    return bound.where(in_window(F.col("CloseDate"), p.q_start, p.q_end)).select("snapshot_date", *DATED_COLUMNS)
