"""Sources and sinks: partitioned snapshots, overwrite sink, catalog listing, schema metadata, export."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from pipewright.plans import enrich, report
from pipewright.registry import PARAMS
from pipewright.sources import crm, snapshots, tables
from pipewright.sources.publish import current, read_published

from .conftest import SF001


def test_snapshot_table_roundtrip_and_pruning(spark):
    d = tempfile.mkdtemp(prefix="pw-snap-")
    path = os.path.join(d, "opportunity_history")
    days = crm.fixture_snapshot_days(PARAMS.anchor, PARAMS.q_end)
    h = crm.history(spark, SF001, days)
    snapshots.write_snapshots(h, path)
    one = snapshots.read_snapshot_at(spark, path, PARAMS.anchor)
    assert one.count() == 938
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    window = snapshots.read_snapshots(spark, path, days[1], days[3])
    assert {r.snapshot_date for r in window.select("snapshot_date").distinct().collect()} == set(days[1:3])
    listed = [r.snapshot_date for r in snapshots.snapshot_days(spark.read.parquet(path), days[0], PARAMS.q_end).collect()]
    assert listed == days
    # appending (replacing) one day keeps the others
    snapshots.write_snapshots(h.where(F.col("snapshot_date") == days[0]), path)
    assert spark.read.parquet(path).select("snapshot_date").distinct().count() == len(days)


def test_extract_and_load_overwrites(spark):
    d = tempfile.mkdtemp(prefix="pw-load-")
    path = os.path.join(d, "opportunity")
    enrich.extract_and_load(spark, SF001, path)
    assert enrich.extract_and_load(spark, SF001, path) == 1500
    df = read_published(spark, path, "opportunity")
    assert df.count() == 1500
    assert "ACV_Bookings_Converted" in df.columns and "Account_Name" in df.columns


def test_catalog_listing_and_fields(spark):
    names = tables.register_views(spark, SF001, ["orders", "customer"])
    assert names == ["orders", "customer"]
    listed = {r.name for r in tables.list_objects(spark).collect()}
    assert {"orders", "customer"} <= listed
    o = crm.opportunity(spark, SF001)
    cur = tables.currency_fields(o)
    assert "ACV_Bookings" in cur and "Days_Stale" not in cur
    desc = {r.name: r.metadata for r in tables.describe_fields(o).collect()}
    assert '"currency"' in desc["Amount"]


def test_report_export_writes_tabs(spark):
    d = tempfile.mkdtemp(prefix="pw-report-")
    tabs = report.movement_report(spark, SF001, PARAMS)
    written = report.export_report(tabs, report.report_meta(spark, PARAMS), d)
    assert sorted(written) == ["pivot_data", "raw_data", "report_meta"]
    meta = read_published(spark, d, "report_meta").collect()[0]
    assert meta.quarter_label == "Q3-1998" and meta.anchor == dt.date(1998, 7, 10)
    assert meta.last_refreshed == "Last Refreshed: 1998-08-15 05:00:00"  # New York, in summer
    assert read_published(spark, d, "raw_data").count() == tabs["raw_data"].count() == written["raw_data"]


def test_quarter_report_job_uses_checkpoint(spark):
    d = tempfile.mkdtemp(prefix="pw-job-")
    written = report.run_quarter_report(spark, SF001, PARAMS, d)
    assert sorted(written) == ["existing_business", "new_business", "pivot_data", "raw_data", "report_meta"]
    ck = spark.conf.get("spark.checkpoint.dir")
    assert ck and os.path.isdir(ck) and os.listdir(ck)


def test_sql_over_crm_views(spark):
    crm.register_crm_views(spark, SF001, [PARAMS.anchor])
    df = spark.sql("""
        SELECT Name, Metric, sum(Amount) AS Amount FROM activity
        WHERE ActivityDate >= DATE '2024-01-01' AND ActivityDate < DATE '2025-01-01'
        GROUP BY Name, Metric ORDER BY Name, Metric""")
    assert df.count() > 0 and df.columns == ["Name", "Metric", "Amount"]
    n = spark.sql("SELECT count(*) FROM history WHERE snapshot_date = DATE '1998-07-10'").collect()[0][0]
    assert n == 938


def test_cli_report(spark):
    from pipewright.__main__ import main
    d = tempfile.mkdtemp(prefix="pw-cli-")
    main(["report", "--input", SF001, "--out", d, "--rpt-date", "1998-08-15", "--anchor", "1998-07-10",
          "--profile", "local", "--format", "csv"])
    assert sorted(current(spark, d)[2]) == ["existing_business", "new_business", "pivot_data", "raw_data", "report_meta"]


def test_cli_scorecards_and_merge(spark):
    from pipewright.__main__ import main
    d = tempfile.mkdtemp(prefix="pw-cli2-")
    main(["scorecards", "--input", SF001, "--out", os.path.join(d, "qbr"), "--rpt-date", "1998-08-15",
          "--stale-origin", "1995-01-01", "--velocity-since", "1995-01-01", "--activity-rpt-date", "2025-02-15",
          "--profile", "local"])
    tabs = sorted(current(spark, os.path.join(d, "qbr"))[2])
    assert tabs == sorted(["scorecard_Y", "scorecard_Q", "renewal_rows", "top_deals", "stage_mix", "stage_days", "raw_data",
                           "rep_activities", "win_rates", "deal_velocity", "report_meta"])
    assert read_published(spark, os.path.join(d, "qbr"), "rep_activities").count() > 0
    from pipewright.plans import accounts
    accounts.account_table(spark, SF001).write.parquet(os.path.join(d, "target"))
    accounts.account_changes(spark, SF001).write.parquet(os.path.join(d, "changes"))
    main(["merge", "--target", os.path.join(d, "target"), "--changes", os.path.join(d, "changes"), "--key", "Id",
          "--seq", "seq", "--mode", "upsert", "--notes", "n" * 60_000, "--out", os.path.join(d, "m"),
          "--profile", "local"])
    out = os.path.join(d, "m")
    assert sorted(current(spark, out)[2]) == ["before_upload", "merged", "notes", "run", "upload_file", "upload_results"]
    assert len(read_published(spark, out, "notes").collect()[0].notes) == 49_999
    merged = read_published(spark, out, "merged")
    assert merged.count() == accounts.merged_accounts(spark, SF001).count()
    merged.write.parquet(os.path.join(d, "now"))
    main(["revert", "--table", os.path.join(d, "now"), "--merge", out, "--key", "Id", "--seq", "seq",
          "--out", os.path.join(d, "r"), "--profile", "local"])
    reverted = read_published(spark, os.path.join(d, "r"), "reverted")
    before = accounts.account_table(spark, SF001)
    assert sorted(map(tuple, reverted.collect())) == sorted(map(tuple, before.collect()))


def test_movement_checkpoint_keeps_results(spark):
    from pipewright.plans.movement import V3, Movement
    lazy = Movement(spark, SF001, PARAMS, V3)
    ck = Movement(spark, SF001, PARAMS, V3).checkpoint()
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, ck.outcome().collect()), key=key) == sorted(map(tuple, lazy.outcome().collect()), key=key)
    plan = ck.outcome()._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan          # reads the checkpoint, not the sources
