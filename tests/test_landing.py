"""Landed tables bucketed by id: same results, no shuffle before the outcome aggregation."""

import json
import os
import subprocess
import sys

import pytest

from pipewright.plans import coverage, report, scorecard, velocity
from pipewright.plans.movement import V3, Movement
from pipewright.registry import PARAMS
from pipewright.sources import crm, landing
from pipewright.sources.publish import Folder, read_published

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _landed(spark, path, days, database):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    landing.land_crm(spark, SF001, n, days, str(path))
    return landing.attach(spark, str(path), database)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bucketed_movement_has_no_shuffle_before_outcome(spark, tmp_path):
    t = _landed(spark, tmp_path, [PARAMS.anchor], "crm_test")
    kw = dict(opportunity=t["opportunity"], snapshots=t["history"], changes=t["field_history"])
    landed = Movement(spark, SF001, PARAMS, V3, **kw)
    derived = Movement(spark, SF001, PARAMS, V3)
    a = sorted(map(tuple, landed.outcome().collect()), key=repr)
    b = sorted(map(tuple, derived.outcome().collect()), key=repr)
    assert a == b
    # with every join side too large to broadcast, the id joins and the per-id
    # aggregations still read co-located buckets: no shuffle on the id
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        m = Movement(spark, SF001, PARAMS, V3, **kw)
        wide = m.wide()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [Id" in wide
        # only the change log (landed unbucketed) is exchanged, after its map-side partial max
        id_exchanges = [x for x in wide.splitlines() if "Exchange hashpartitioning(Id" in x]
        assert not id_exchanges, wide
        assert "partial_max" in wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bucketed_coverage_same_result_no_id_shuffle(spark, tmp_path):
    t = _landed(spark, tmp_path, crm.fixture_snapshot_days(PARAMS.anchor, PARAMS.q_end), "crm_cov")
    kw = dict(opportunity=t["opportunity"], snapshots=t["history"], changes=t["field_history"])
    landed = coverage.coverage_wide(spark, SF001, PARAMS, **kw)
    derived = coverage.coverage_wide(spark, SF001, PARAMS)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, landed.collect()), key=key) == sorted(map(tuple, derived.collect()), key=key)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = coverage.coverage_wide(spark, SF001, PARAMS, **kw)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(Id" in x], plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_files_are_at_most_buckets_times_days(spark, tmp_path):
    days = crm.fixture_snapshot_days(PARAMS.anchor, PARAMS.q_end)
    wide = crm.history(spark, SF001, days).repartition(13)  # many tasks, each with rows of all buckets and days
    landing.land(wide, str(tmp_path / "history"), "history", "Id", 4, "snapshot_date")
    folders = [d for d in os.listdir(tmp_path / "history") if d.startswith("snapshot_date=")]
    files = [f for d in folders for f in os.listdir(tmp_path / "history" / d) if f.endswith(".parquet")]
    assert len(folders) == len(days) and len(files) <= 4 * len(days)


def test_landing_again_replaces_the_tables_at_once(spark, tmp_path):
    first = _landed(spark, tmp_path, [PARAMS.anchor], "crm_first")["opportunity"]
    n = first.count()
    with pytest.raises(Exception, match="landing stops here"):
        old = crm.activity
        try:
            crm.activity = lambda *a: (_ for _ in ()).throw(RuntimeError("landing stops here"))
            landing.land_crm(spark, SF001, 2, [PARAMS.anchor], str(tmp_path))
        finally:
            crm.activity = old
    assert landing.attach(spark, str(tmp_path), "crm_first")["opportunity"].count() == n
    landing.land_crm(spark, SF001, 2, [PARAMS.anchor], str(tmp_path))
    assert len(Folder(spark, str(tmp_path)).names("landed")) == 1
    assert landing.attach(spark, str(tmp_path), "crm_first")["opportunity"].count() == n


def test_reports_run_on_tables_alone(spark, tmp_path):
    """With CRM tables as the source no star-schema file is read, and the results are the same."""
    t = _landed(spark, tmp_path, crm.fixture_snapshot_days(PARAMS.anchor, PARAMS.q_end), "crm_alone")
    jobs = {
        "outcome": lambda src: Movement(spark, src, PARAMS, V3).outcome(),
        "coverage": lambda src: coverage.coverage_by_region(spark, src, PARAMS),
        "owners": lambda src: scorecard.owner_scorecard(spark, src, PARAMS),
        "velocity": lambda src: velocity.velocity_compare(spark, src, PARAMS)}
    for name, job in jobs.items():
        plan = job(t)._jdf.queryExecution().executedPlan().toString()
        assert "testdata" not in plan, name
        assert _rows(job(t)) == _rows(job(SF001)), name


def test_land_and_report_as_two_processes(spark, tmp_path):
    """The tables outlive the process that landed them: another one reports from the folder alone."""
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_LOCAL_IP": "127.0.0.1"}

    def job(*args):
        out = subprocess.run([sys.executable, "-m", "pipewright", *args, "--profile", "local"], cwd=tmp_path, env=env,
                             capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stderr[-2000:]
        return json.loads(out.stdout.strip().splitlines()[-1])["written"]

    dates = ["--rpt-date", "1998-08-15", "--anchor", "1998-07-10"]
    landed, out = str(tmp_path / "landed"), str(tmp_path / "report")
    job("land", "--input", SF001, "--out", landed, "--buckets", "4", *dates)
    written = job("report", "--tables", landed, "--out", out, *dates)
    assert not os.path.exists(tmp_path / "spark-warehouse") or not os.listdir(tmp_path / "spark-warehouse")
    pivot = read_published(spark, out, "pivot_data")
    assert pivot.count() == written["pivot_data"]
    assert _rows(pivot) == _rows(Movement(spark, SF001, PARAMS, V3).outcome())


@pytest.mark.parametrize("preset", report.PRESETS)
def test_every_tab_of_every_preset_reads_back(spark, tmp_path, preset):
    rows = report.run_quarter_report(spark, SF001, PARAMS, str(tmp_path), preset)
    tabs = {"new_business", "existing_business", "report_meta"} | (
        {"starting_pipeline", "pulled_in", "new_pipe", "total_won"} if preset == "v2" else {"pivot_data", "raw_data"})
    assert set(rows) == tabs
    for tab, n in rows.items():
        assert read_published(spark, str(tmp_path), tab).count() == n
