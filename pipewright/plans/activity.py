"""Rep activity metrics, one column per metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions.money import money, usd
from pipewright.functions.periods import ReportParams, in_window
from pipewright.sources import crm


def activities_wide(spark: SparkSession, sf_dir: str, p: ReportParams, activity: DataFrame | None = None) -> DataFrame:
    """Per rep the total of each metric in the grading window, plus the rep's group.

    Every metric of the window gets a column; the pivot reads their names from
    the data (an error beyond ``spark.sql.pivotMaxValues`` of them, never a
    silent loss).
    """
    s, e = p.unit
    a = (activity if activity is not None else crm.activity(spark, sf_dir)).where(in_window(F.col("ActivityDate"), s, e))
    wide = a.groupBy("Name").pivot("Metric").agg(F.sum(money(F.col("Amount"))))
    wide = wide.select("Name", *[usd(F.col(f"`{m}`")).alias(m) for m in wide.columns if m != "Name"])
    g = crm.rep_group(spark, sf_dir)
    return wide.join(F.broadcast(g), "Name", "left")
