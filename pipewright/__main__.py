"""Command line jobs (``python -m pipewright <job> ...`` or ``spark-submit pipewright/__main__.py <job> ...``).

land        land the CRM tables at a shared path, deals and snapshots bucketed by deal id
report      quarter pipeline report (v2: coverage and its deal tabs; v3, v4: movement outcome, seed, coverage)
scorecards  account-manager review: scorecards, stage mix, top deals, activities, win rates, velocity
merge       audited keyed update / upsert of any table: before image, results, merged table, notes
revert      undo a merge from its before image, where nothing changed since

Every report runs on source tables (``--input``) or on landed CRM tables alone
(``--tables``). A job publishes all its tables together under ``--out`` (see
``sources.publish``); a job that fails leaves what was published before. Session
settings come from the submitter; ``spark.checkpoint.dir`` must name a shared
folder on a cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pipewright.functions.periods import ReportParams
from pipewright.operators.merge import run_audited_merge, run_revert
from pipewright.plans import report
from pipewright.session import get_spark
from pipewright.sources import crm, landing


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pipewright")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def source(parser) -> None:
        where = parser.add_mutually_exclusive_group(required=True)
        where.add_argument("--input", help="folder with the source tables")
        where.add_argument("--tables", help="folder of landed CRM tables (see the land job): nothing else is read")
        parser.add_argument("--profile", default="cluster", choices=["local", "cluster"])

    r = sub.add_parser("report", help="publish the quarter pipeline report")
    source(r)
    r.add_argument("--out", required=True, help="folder of published runs")
    r.add_argument("--rpt-date", required=True, type=dt.date.fromisoformat)
    r.add_argument("--anchor", required=True, type=dt.date.fromisoformat)
    r.add_argument("--preset", default="v3", choices=report.PRESETS)
    r.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    r.add_argument("--refreshed-at", default="", help="UTC time shown in the header")
    ld = sub.add_parser("land", help="land the CRM tables at a shared path, deals and snapshots bucketed by deal id")
    ld.add_argument("--input", required=True)
    ld.add_argument("--out", required=True, help="shared folder of the landed tables")
    ld.add_argument("--buckets", type=int, required=True)
    ld.add_argument("--anchor", required=True, type=dt.date.fromisoformat)
    ld.add_argument("--rpt-date", required=True, type=dt.date.fromisoformat,
                    help="snapshots are landed from the anchor to the end of this date's quarter")
    ld.add_argument("--profile", default="cluster", choices=["local", "cluster"])
    sc = sub.add_parser("scorecards", help="publish the account-manager review tabs")
    source(sc)
    sc.add_argument("--out", required=True)
    sc.add_argument("--rpt-date", required=True, type=dt.date.fromisoformat)
    sc.add_argument("--compare", default="Y", choices=["Y", "Q"])
    sc.add_argument("--stale-origin", default="2022-02-05", type=dt.date.fromisoformat)
    sc.add_argument("--velocity-since", default="2022-07-01", type=dt.date.fromisoformat)
    sc.add_argument("--activity-rpt-date", type=dt.date.fromisoformat, default=None,
                    help="report date whose grading window selects the activity metrics (default: --rpt-date)")
    sc.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    m = sub.add_parser("merge", help="audited keyed update / upsert of a table")
    m.add_argument("--target", required=True, help="parquet folder of the table to change")
    m.add_argument("--changes", required=True, help="parquet folder of the change set")
    m.add_argument("--key", required=True)
    m.add_argument("--seq", required=True, help="column ordering repeated keys; the last one wins")
    m.add_argument("--mode", default="upsert", choices=["update", "upsert"])
    m.add_argument("--notes", default=None)
    m.add_argument("--out", required=True)
    m.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    m.add_argument("--profile", default="cluster", choices=["local", "cluster"])
    v = sub.add_parser("revert", help="undo a merge from its before image")
    v.add_argument("--table", required=True, help="parquet folder of the merged table as it is now")
    v.add_argument("--merge", required=True, help="output folder of the merge job")
    v.add_argument("--key", required=True)
    v.add_argument("--seq", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    v.add_argument("--profile", default="cluster", choices=["local", "cluster"])
    a = ap.parse_args(argv)
    spark = get_spark(profile=a.profile)
    tables = a.input if getattr(a, "input", None) else landing.attach(spark, a.tables) if getattr(a, "tables", None) else None
    if a.cmd == "report":
        p = ReportParams(rpt_date=a.rpt_date, anchor=a.anchor, refreshed_at=a.refreshed_at)
        written = report.run_quarter_report(spark, tables, p, a.out, preset=a.preset, fmt=a.format)
    elif a.cmd == "land":
        p = ReportParams(rpt_date=a.rpt_date, anchor=a.anchor)
        days = crm.fixture_snapshot_days(p.anchor, p.q_end)
        written = {t.name: t.path for t in landing.land_crm(spark, a.input, a.buckets, days, a.out)}
    elif a.cmd == "scorecards":
        p = ReportParams(rpt_date=a.rpt_date, anchor=a.rpt_date, compare=a.compare, stale_origin=a.stale_origin,
                         velocity_since=a.velocity_since)
        ap_ = ReportParams(rpt_date=a.activity_rpt_date, anchor=a.activity_rpt_date, compare=a.compare) \
            if a.activity_rpt_date else None
        written = report.run_scorecard_report(spark, tables, p, a.out, ap_, fmt=a.format)
    elif a.cmd == "revert":
        written = run_revert(spark, spark.read.parquet(a.table), a.merge, a.key, a.seq, a.out, a.format)
    else:
        written = run_audited_merge(spark, spark.read.parquet(a.target), spark.read.parquet(a.changes), a.key,
                                    a.seq, a.out, a.mode, a.notes, a.format)
    print(json.dumps({"written": written}, default=str))


if __name__ == "__main__":
    main()
