"""DuckDB texts for deal velocity and activities (UNION ALL per stage, as the report wrote it)."""

from __future__ import annotations

from pipewright.functions import dims
from pipewright.functions.periods import ReportParams
from pipewright.oracle.fixtures import _lit, views
from pipewright.oracle.scorecard_sql import D, _in, _m, _usd
from pipewright.plans.velocity import STAGE_SPANS


def _levels() -> str:
    return "(VALUES " + ", ".join(f"({_lit(s)}, {i + 1})" for i, s in enumerate(dims.VELOCITY_STAGE_ORDER)) + ") lv(Stage, stage_rank)"


def _nonneg(x: str) -> str:
    r = f"round_even({x}, 0)"
    return f"(CASE WHEN isnan({r}) THEN NULL WHEN {r} < 0 THEN CAST(0 AS DOUBLE) ELSE {r} END + CAST(0 AS DOUBLE))"


def _share(m: str, md: str) -> str:
    return (f"coalesce(CAST(CAST({m} AS BIGINT) AS VARCHAR), 'NA') || ', ' || "
            f"coalesce(CAST(CAST({md} AS BIGINT) AS VARCHAR), 'NA')")


def tis_ctes(p: ReportParams) -> str:
    cols = "Opp_Owner_Manager, Opp_Id, Opp_Name, Product, QB_USD, Opp_Owner, StageName, Category, Type"
    spans = ",\n         ".join(f"CAST(date_diff('day', {start}, {end}) AS INTEGER) AS d{i}"
                                  for i, (_, end, start) in enumerate(STAGE_SPANS))
    union = "\nUNION ALL\n".join(f"SELECT {cols}, '{label}' AS Stage, d{i} AS Days FROM opps"
                                 for i, (label, _, _) in enumerate(STAGE_SPANS))
    return views("opportunity", "users", "currency", "rep_group", with_product=True) + f""",
opps AS (
  SELECT u.Manager AS Opp_Owner_Manager, o.Id AS Opp_Id, o.Name AS Opp_Name, o.ARR_Product AS Product,
         o.ACV_Bookings / ct.ConversionRate AS QB_USD, u.Name AS Opp_Owner, o.StageName, o.Category, o.Type,
         {spans}
  FROM opportunity o LEFT JOIN users u ON o.OwnerId = u.Id LEFT JOIN currency ct ON o.CurrencyIsoCode = ct.IsoCode
  WHERE o.Test_Account = FALSE AND o.StageName = 'Closed Won'
    AND o.Category IN {_in(dims.VELOCITY_CATEGORIES)} AND o.CloseDate >= {D(p.velocity_since)}
),
tis AS ({union}),
team_stats AS (
  SELECT Opp_Owner_Manager, Stage, avg(Days) AS mean, median(Days) AS median
  FROM tis WHERE StageName = 'Closed Won' AND Days IS NOT NULL GROUP BY ALL
),
team_grid AS (
  SELECT m.Opp_Owner_Manager, lv.Stage, lv.stage_rank
  FROM (SELECT DISTINCT Opp_Owner_Manager FROM tis WHERE StageName = 'Closed Won' AND Days IS NOT NULL) m, {_levels()}
),
team AS (
  SELECT g.Opp_Owner_Manager, g.Stage, CAST(g.stage_rank AS INTEGER) AS stage_rank,
         {_nonneg("s.mean")} AS mean_days, {_nonneg("s.median")} AS median_days
  FROM team_grid g LEFT JOIN team_stats s
    ON g.Opp_Owner_Manager IS NOT DISTINCT FROM s.Opp_Owner_Manager AND g.Stage = s.Stage
),
open_pipe AS (
  SELECT u.Manager AS Opp_Owner_Manager, u.Name AS Opp_Owner, o.StageName AS Stage, o.Name AS Opp_Name, o.Days_Stale
  FROM opportunity o LEFT JOIN users u ON o.OwnerId = u.Id
  WHERE o.StageName IN {_in(dims.VELOCITY_STAGE_ORDER)} AND o.Test_Account = FALSE
    AND o.Category IN {_in(dims.VELOCITY_CATEGORIES)}
    AND u.Name IN (SELECT Name FROM rep_group)
),
rep_stats AS (
  SELECT Opp_Owner_Manager, Opp_Owner, Stage, avg(Days_Stale) AS mean, median(Days_Stale) AS median
  FROM open_pipe GROUP BY ALL
),
rep_grid AS (
  SELECT m.Opp_Owner_Manager, m.Opp_Owner, lv.Stage, lv.stage_rank
  FROM (SELECT DISTINCT Opp_Owner_Manager, Opp_Owner FROM open_pipe) m, {_levels()}
),
rep AS (
  SELECT g.Opp_Owner_Manager, g.Opp_Owner, g.Stage, CAST(g.stage_rank AS INTEGER) AS stage_rank,
         {_nonneg("s.mean")} AS mean_days, {_nonneg("s.median")} AS median_days
  FROM rep_grid g LEFT JOIN rep_stats s
    ON g.Opp_Owner_Manager IS NOT DISTINCT FROM s.Opp_Owner_Manager
   AND g.Opp_Owner IS NOT DISTINCT FROM s.Opp_Owner AND g.Stage = s.Stage
)
"""


def time_in_stage(p: ReportParams) -> str:
    return tis_ctes(p) + "SELECT * FROM tis"


def team_velocity(p: ReportParams) -> str:
    return tis_ctes(p) + f"SELECT *, {_share('mean_days', 'median_days')} AS mean_median FROM team"


def rep_velocity(p: ReportParams) -> str:
    return tis_ctes(p) + f"SELECT *, {_share('mean_days', 'median_days')} AS mean_median FROM rep"


def velocity_compare(p: ReportParams) -> str:
    return tis_ctes(p) + f""",
rs AS (SELECT *, {_share('mean_days', 'median_days')} AS s FROM rep),
ts AS (SELECT *, {_share('mean_days', 'median_days')} AS s FROM team)
SELECT r.Opp_Owner_Manager, r.Opp_Owner, r.Stage, r.stage_rank,
       CASE WHEN r.s LIKE '%NA%' THEN '.' ELSE r.s END AS mean_median,
       CASE WHEN t.s LIKE '%NA%' THEN '.' ELSE t.s END AS Team_mean_median
FROM rs r JOIN ts t ON r.Opp_Owner_Manager || r.Stage = t.Opp_Owner_Manager || t.Stage
   OR (r.Opp_Owner_Manager IS NULL AND t.Opp_Owner_Manager IS NULL AND r.Stage = t.Stage)"""


# what the test events hold; a metric outside the list would be a missing column here
METRICS = ("click", "error", "purchase", "signup", "view")


def activities_wide(p: ReportParams) -> str:
    s, e = p.unit
    cols = ", ".join(_usd(f"sum({_m('Amount')}) FILTER (WHERE Metric = {_lit(m)})") + f' AS "{m}"' for m in METRICS)
    return views("activity", "rep_group") + f"""
SELECT w.*, g."Group"
FROM (SELECT Name, {cols}
      FROM activity WHERE ActivityDate >= {D(s)} AND ActivityDate < {D(e)} GROUP BY Name) w
LEFT JOIN rep_group g ON w.Name = g.Name"""
