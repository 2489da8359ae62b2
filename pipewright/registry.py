"""Registered queries: name -> (Spark job, DuckDB oracle text).

Parameters are fixed per query so that the Spark job and its oracle see the
same dates. The report dates sit inside the test tables' time range (orders
1995-2001, events January 2024).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pipewright.functions.periods import ReportParams
from pipewright.session import pin_result_settings
from pipewright.oracle import coverage_sql, enrich_sql, movement_sql, scorecard_sql, stack_sql, velocity_sql
from pipewright.plans import accounts, activity, coverage, enrich, movement, report, scorecard, stack, velocity

PARAMS = ReportParams(rpt_date=dt.date(1998, 8, 15), anchor=dt.date(1998, 7, 10), compare="Y",
                      stale_origin=dt.date(1995, 1, 1), velocity_since=dt.date(1995, 1, 1),
                      refreshed_at="1998-08-15 09:00:00")
# activity metrics exist for January 2024 only: grade on the year 2024
ACTIVITY_PARAMS = ReportParams(rpt_date=dt.date(2025, 2, 15), anchor=dt.date(2025, 1, 10), compare="Y",
                               refreshed_at="2025-02-15 09:00:00")

Job = Callable[[SparkSession, str], DataFrame]

_REG: dict[str, tuple[Job, str | None]] = {}


def register(name: str, job: Job, oracle: str | None) -> None:
    _REG[name] = (job, oracle)


def _p(fn, params=PARAMS, **kw):
    def job(spark, sf_dir):
        pin_result_settings(spark)
        return fn(spark, sf_dir, params, **kw)
    return job


register("opps_enriched", _p(scorecard.opps_enriched), scorecard_sql.opps_enriched(PARAMS))
register("renewal_scorecard", _p(scorecard.renewal_scorecard), scorecard_sql.renewal_scorecard(PARAMS))
register("renewal_rows", _p(scorecard.renewal_rows), scorecard_sql.renewal_rows(PARAMS))
register("sao_scorecard", _p(scorecard.sao_scorecard), scorecard_sql.sao_scorecard(PARAMS))
register("owner_scorecard", _p(scorecard.owner_scorecard), scorecard_sql.owner_scorecard(PARAMS))
register("stage_mix", _p(scorecard.stage_mix), scorecard_sql.stage_mix(PARAMS))
register("stage_days", _p(scorecard.stage_days, piece=20), scorecard_sql.stage_days(PARAMS, 20))
register("top_deals", _p(scorecard.top_deals), scorecard_sql.top_deals(PARAMS))
register("rep_win_rates", _p(scorecard.rep_win_rates), scorecard_sql.rep_win_rates(PARAMS))


def _mv(attr: str, preset: str = "v3", public: bool = True):
    def job(spark, sf_dir):
        pin_result_settings(spark)
        m = movement.movement(spark, sf_dir, PARAMS, preset)
        df = getattr(m, attr)
        df = df() if callable(df) else df
        return movement.public_set(df) if public else df
    return job


for _name, _set in [("starting_pipeline", "starting"), ("pulled_in", "pulled_in"), ("new_pipe", "new_pipe"),
                    ("pushed", "pushed"), ("total_opps", "total"), ("ghost_found", "ghost")]:
    _sql_name = {"pulled_in": "pulled"}.get(_set, _set)
    register(_name, _mv(_set), movement_sql.set_query(PARAMS, "v3", _sql_name))
register("movement_seed", _mv("seed", public=False), movement_sql.seed(PARAMS, "v3"))
for _name, _set in [("v4_starting_pipeline", "starting"), ("v4_pulled_in", "pulled_in"), ("v4_new_pipe", "new_pipe"),
                    ("v4_pushed", "pushed"), ("v4_total_opps", "total"), ("v4_ghost_found", "ghost")]:
    _sql_name = {"pulled_in": "pulled"}.get(_set, _set)
    register(_name, _mv(_set, "v4"), movement_sql.set_query(PARAMS, "v4", _sql_name))
register("v4_movement_seed", _mv("seed", "v4", public=False), movement_sql.seed(PARAMS, "v4"))
register("pipeline_outcome", _mv("outcome", public=False), movement_sql.outcome(PARAMS, "v3"))
register("pipeline_outcome_v4", _mv("outcome", "v4", public=False), movement_sql.outcome(PARAMS, "v4"))
register("won_by_category", _mv("won_by_category", public=False), movement_sql.won_by_category(PARAMS, "v3"))
register("id_multiplicity", _mv("id_multiplicity", public=False), movement_sql.id_multiplicity(PARAMS, "v3"))
register("field_delta", _mv("field_delta", "v4", public=False), movement_sql.field_delta(PARAMS, "v4"))

register("forecasted_opps", _p(coverage.forecasted_opps), coverage_sql.forecasted_opps(PARAMS))
register("coverage_by_region", _p(coverage.coverage_by_region), coverage_sql.coverage_by_region(PARAMS))


def _v2(tab: str):
    def job(spark, sf_dir):
        pin_result_settings(spark)
        return coverage.v2_tabs(spark, sf_dir, PARAMS)[tab]
    return job


for _tab in ["starting_pipeline", "pulled_in", "new_pipe", "total_won"]:
    register(f"v2_{_tab}", _v2(_tab), coverage_sql.v2_tab(PARAMS, _tab))
register("v2_pulled_not_forecast", _p(coverage.pulled_not_forecast), coverage_sql.pulled_not_forecast(PARAMS))

register("time_in_stage", _p(velocity.time_in_stage), velocity_sql.time_in_stage(PARAMS))
register("team_velocity", _p(velocity.team_velocity), velocity_sql.team_velocity(PARAMS))
register("rep_velocity", _p(velocity.rep_velocity), velocity_sql.rep_velocity(PARAMS))
register("velocity_compare", _p(velocity.velocity_compare), velocity_sql.velocity_compare(PARAMS))
register("activities_wide", _p(activity.activities_wide, ACTIVITY_PARAMS), velocity_sql.activities_wide(ACTIVITY_PARAMS))

register("ingest_converted", _p(enrich.ingest_converted), enrich_sql.ingest_converted(PARAMS))
register("ingest_loaded", _p(enrich.ingest_loaded), enrich_sql.ingest_converted(PARAMS))
register("opp_classified", _p(enrich.opp_classified), enrich_sql.opp_classified(PARAMS))
register("opp_families", _p(enrich.opp_families), enrich_sql.opp_families())
register("family_totals", _p(enrich.family_totals), enrich_sql.family_totals())
register("currency_scrub", _p(enrich.currency_scrub), enrich_sql.currency_scrub(PARAMS))
register("record_links", _p(enrich.record_links), enrich_sql.record_links(PARAMS))
register("flatten_nested", _p(enrich.flatten_customers), enrich_sql.flatten_nested())
register("audited_merge", _p(accounts.audited_merge, mode="upsert"), enrich_sql.audited_merge("upsert"))
register("audited_update", _p(accounts.audited_merge, mode="update"), enrich_sql.audited_merge("update"))
register("merged_accounts", _p(accounts.merged_accounts, mode="upsert"), enrich_sql.merged_accounts("upsert"))
register("accounts_before_image", _p(accounts.accounts_before_image), enrich_sql.accounts_before_image())

register("reverted_accounts", _p(accounts.reverted_accounts), enrich_sql.reverted_accounts())
register("revert_outcomes", _p(accounts.revert_outcomes), enrich_sql.revert_outcomes())
register("reverted_after_edits", _p(accounts.reverted_after_edits), enrich_sql.reverted_after_edits())

register("snapshot_calendar", _p(stack.snapshot_calendar), stack_sql.snapshot_calendar(PARAMS))
register("dated_snapshots", _p(stack.dated_snapshots), stack_sql.dated_snapshots(PARAMS))
register("deal_stack", _p(stack.deal_stack), stack_sql.deal_stack(PARAMS))

register("report_export", _p(report.report_manifest), coverage_sql.report_manifest(PARAMS))
register("report_export_v2", _p(report.report_manifest, preset="v2"), coverage_sql.report_manifest(PARAMS, "v2"))


def queries() -> dict[str, Job]:
    return {k: v[0] for k, v in _REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _REG.items() if v[1] is not None}
