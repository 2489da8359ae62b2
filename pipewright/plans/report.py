"""Report jobs: compute every tab of a run, publish them together with a header table.

A source is a folder of test tables or a mapping of CRM tables (``sources.crm``);
the jobs are the same. A report is published whole (``sources.publish``): an
aborted run leaves the last report as it is.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions.periods import ReportParams, col_in_zone
from pipewright.plans import coverage, movement
from pipewright.session import ensure_checkpoint_dir
from pipewright.sources import crm
from pipewright.sources.publish import Table, publish, read_published

ZONE = "America/New_York"  # the header shows when the report was refreshed in this zone
PRESETS = ["v2", *movement.PRESETS]


def movement_report(spark: SparkSession, source: crm.Source, p: ReportParams, preset: str = "v3",
                    materialize: bool = False, inputs: dict | None = None) -> dict[str, DataFrame]:
    """Tabs of the quarter pipeline report (rule sets v3 and v4).

    With ``materialize`` the wide rows are checkpointed first, so writing both
    tabs reads the sources once. ``inputs``: deals, snapshots or changes to read instead.
    """
    if preset not in movement.PRESETS:
        raise ValueError(f"unknown rule set {preset!r}")
    m = movement.Movement(spark, source, p, movement.PRESETS[preset], **(inputs or {}))
    if materialize:
        m.checkpoint()
    return {"pivot_data": m.outcome(), "raw_data": m.seed()}


def quarter_tables(spark: SparkSession, source: crm.Source, p: ReportParams, preset: str = "v3",
                   inputs: dict | None = None) -> dict[str, DataFrame | Table]:
    """Every tab of the quarter report, in the order it is shown; what several tabs read is checkpointed.

    v3, v4: the outcome by category, geography and product, the seed, and the two
    coverage tables; v2: the coverage tables and the deal tabs behind them.
    """
    if preset not in PRESETS:
        raise ValueError(f"unknown rule set {preset!r}")
    ensure_checkpoint_dir(spark)
    wide = coverage.coverage_wide(spark, source, p, **(inputs or {})).checkpoint(eager=True)
    cov = coverage.coverage_by_region(spark, source, p, wide=wide).checkpoint(eager=True)
    region = [F.desc_nulls_last("Merged_Account_Region_bucket")]
    tabs: dict[str, DataFrame | Table] = {name: Table(df, region) for name, df in coverage.coverage_tables(cov).items()}
    if preset == "v2":
        return tabs | coverage.v2_tabs(spark, source, p, wide=wide)
    m = movement_report(spark, source, p, preset, materialize=True, inputs=inputs)
    keys = movement.PRESETS[preset].keys
    order = ["Category", "Geo", "Product", *(k for k in keys if k not in ("Category", "Geo", "Product"))]
    return {"pivot_data": Table(m["pivot_data"], [F.asc_nulls_last(k) for k in order]), "raw_data": m["raw_data"]} | tabs


def report_meta(spark: SparkSession, p: ReportParams) -> DataFrame:
    """Header cells, one row: quarter label, anchor date, refresh time (parameters), and its text in the report's zone."""
    row = spark.createDataFrame([(p.q_label, p.anchor, p.refreshed_at)], "quarter_label string, anchor date, refreshed_at string")
    local = col_in_zone(F.try_to_timestamp("refreshed_at"), ZONE)
    return row.withColumn("last_refreshed", F.concat(F.lit("Last Refreshed: "), F.date_format(local, "yyyy-MM-dd HH:mm:ss")))


def export_report(tables: dict[str, DataFrame | Table], meta: DataFrame, out_dir: str, fmt: str = "parquet") -> dict[str, int]:
    """Publish every tab and ``report_meta`` as the current report of ``out_dir``; rows per tab."""
    return publish(meta.sparkSession, out_dir, {**tables, "report_meta": meta}, fmt)


def run_quarter_report(spark: SparkSession, source: crm.Source, p: ReportParams, out_dir: str,
                       preset: str = "v3", fmt: str = "parquet", inputs: dict | None = None) -> dict[str, int]:
    """Job: compute the quarter report once and publish it."""
    return export_report(quarter_tables(spark, source, p, preset, inputs), report_meta(spark, p), out_dir, fmt)


def report_manifest(spark: SparkSession, source: crm.Source, p: ReportParams, preset: str = "v3") -> DataFrame:
    """Publish the quarter report in the shared folder and count what was written: one row per
    tab with its rows, read from the published files, and the header values."""
    out = os.path.join(ensure_checkpoint_dir(spark), f"report-{preset}")
    tabs = [t for t in run_quarter_report(spark, source, p, out, preset) if t != "report_meta"]
    counts = [read_published(spark, out, t).agg(F.lit(t).alias("tab"), F.count(F.lit(1)).alias("rows")) for t in tabs]
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    meta = read_published(spark, out, "report_meta")
    return rows.select("*", *[meta.select(c).scalar().alias(c) for c in meta.columns])


def scorecard_report(spark: SparkSession, source: crm.Source, p: ReportParams,
                     activity_params: ReportParams | None = None) -> dict[str, DataFrame]:
    """Tabs of the account-manager review: scorecards for both grading windows,
    the prior-year renewal rows, stage mix, top deals, the enriched raw data,
    rep activities, win rates and deal velocity."""
    from pipewright.plans import activity, scorecard, velocity
    # every deal tab reads the same enriched deals: computed once, checkpointed to the shared folder
    ensure_checkpoint_dir(spark)
    base = scorecard.opps_enriched(spark, source, p).checkpoint(eager=True)
    owner = scorecard.owner_scorecard(spark, source, p, base=base)
    return {
        "scorecard_Y": owner.where(F.col("period") == "Y").drop("period"),
        "scorecard_Q": owner.where(F.col("period") == "Q").drop("period"),
        "renewal_rows": scorecard.renewal_rows(spark, source, p, base=base),
        "top_deals": scorecard.top_deals(spark, source, p, base=base),
        "stage_mix": scorecard.stage_mix(spark, source, p, base=base),
        "stage_days": scorecard.stage_days(spark, source, p, base=base),
        "raw_data": base,
        "rep_activities": activity.activities_wide(spark, source, activity_params or p),
        "win_rates": scorecard.rep_win_rates(spark, source, p, base=base),
        "deal_velocity": velocity.velocity_compare(spark, source, p),
    }


def run_scorecard_report(spark: SparkSession, source: crm.Source, p: ReportParams, out_dir: str,
                         activity_params: ReportParams | None = None, fmt: str = "parquet") -> dict[str, int]:
    """Job: publish every tab of the account-manager review plus a header table."""
    return export_report(scorecard_report(spark, source, p, activity_params), report_meta(spark, p), out_dir, fmt)
