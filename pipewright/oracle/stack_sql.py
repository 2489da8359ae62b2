"""DuckDB texts of the snapshot calendar and the deal stack."""

from __future__ import annotations

from pipewright.functions.periods import ReportParams
from pipewright.oracle.fixtures import views
from pipewright.oracle.scorecard_sql import D
from pipewright.sources import crm


def snapshot_calendar(p: ReportParams) -> str:
    # the window lies in summer time: four hours behind UTC
    return views("history", dates=crm.fixture_snapshot_days(p.anchor, p.q_end)) + f"""
SELECT DISTINCT snapshot_date, strftime(snapshot_date, '%Y%m%d') AS table_suffix,
       strftime(CAST(snapshot_date AS TIMESTAMP) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') AS taken_local
FROM history WHERE snapshot_date >= {D(p.anchor)} AND snapshot_date < {D(p.q_end)}"""


def deal_stack(p: ReportParams) -> str:
    quarter = f"CloseDate >= {D(p.q_start)} AND CloseDate < {D(p.q_end)}"
    return views("opportunity", "history", dates=[p.anchor]) + f"""
SELECT 'current' AS origin, Id, CAST(NULL AS DATE) AS snapshot_date, StageName, Type, CloseDate, SAO_Date, Category, Name,
       AccountId, OwnerId, Renewal_Type, ACV_Bookings AS Bookings, Managers_Forecast, Test_Account, CurrencyIsoCode,
       CAST(NULL AS DOUBLE) AS qb_usd, CAST(NULL AS VARCHAR) AS qb_text
FROM opportunity WHERE {quarter}
UNION ALL BY NAME
SELECT 'anchor' AS origin, Id, snapshot_date, StageName, CloseDate, Category, qb_usd,
       '$' || format('{{:,.2f}}', qb_usd) AS qb_text
FROM history WHERE {quarter}"""


def dated_snapshots(p: ReportParams) -> str:
    days = crm.fixture_snapshot_days(p.anchor, p.q_end)
    return views("history", dates=days) + f"""
SELECT snapshot_date, Id, StageName, CloseDate, if(snapshot_date = {D(days[-1])}, NULL, Category) AS Category, Type, qb_usd
FROM history WHERE CloseDate >= {D(p.q_start)} AND CloseDate < {D(p.q_end)}"""
