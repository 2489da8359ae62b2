"""The CRM views of ``pipewright.sources.crm`` written as DuckDB CTEs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pipewright.sources import crm


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def _case(expr: str, values: Sequence) -> str:
    whens = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values) if v is not None)
    return f"CASE {expr} {whens} END"


def _cte_region_map() -> str:
    rk = "r_regionkey"
    return f"""region_map AS (
  SELECT r_regionkey,
    {_case(rk, [c for _, c, _, _ in crm.REGION_RULES])} AS IsoCode,
    {_case(rk, [r for _, _, r, _ in crm.REGION_RULES])} AS ConversionRate,
    {_case(rk, [n for _, _, _, n in crm.REGION_RULES])} AS RegionName
  FROM region)"""


CURRENCY = """currency AS (
  SELECT IsoCode, ConversionRate FROM region_map WHERE IsoCode IS NOT NULL)"""


def _cte_opp(with_product: bool) -> str:
    prod_join = ""
    prod_cols = ""
    if with_product:
        prod_join = """
  LEFT JOIN (SELECT l_orderkey, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS types, min(p_type) AS t1
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) lp ON lp.l_orderkey = o.o_orderkey"""
        prod_cols = """,
    types AS Product,
    t1 AS ARR_Product"""
    types = _case("k % 10", crm.TYPES)
    return f"""opp_base AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         CAST(o.o_orderdate AS DATE) AS CloseDate,
         CAST(o.o_orderdate AS DATE) - CAST(30 + (7 * o.o_orderkey) % 300 AS INTEGER) AS CreatedDate,
         c.c_mktsegment, g.IsoCode, g.RegionName{", lp.types, lp.t1" if with_product else ""}
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT n.n_nationkey, rm.IsoCode, rm.RegionName
             FROM nation n LEFT JOIN region_map rm ON n.n_regionkey = rm.r_regionkey) g
         ON c.c_nationkey = g.n_nationkey{prod_join}
),
opp_sao AS (
  SELECT *, CASE WHEN k % 11 = 0 THEN NULL ELSE CreatedDate + CAST((13 * k) % 90 AS INTEGER) END AS SAO_Date,
         CASE WHEN k % 13 = 0 THEN NULL ELSE o_totalprice END AS acv
  FROM opp_base
),
opportunity_k AS (
  SELECT
    '006' || lpad(CAST(k AS VARCHAR), 12, '0') AS Id,
    o_custkey AS AccountId,
    (k // 3) % {crm.N_USERS} AS OwnerId,
    'Deal-' || CAST(k AS VARCHAR) AS Name,
    CASE o_orderstatus
      WHEN 'F' THEN CASE WHEN (k // 6) % 3 = 0 THEN 'Closed Lost' ELSE 'Closed Won' END
      WHEN 'P' THEN {_case("k % 4", crm.STAGES_P)}
      WHEN 'O' THEN {_case("k % 5", crm.STAGES_O)}
    END AS StageName,
    {types} AS Type,
    (k % 50 = 0) AS Test_Account,
    {_case("(k // 10) % 8", crm.CATEGORIES)} AS Category,
    CASE WHEN k % 53 = 0 THEN NULL ELSE RegionName END AS Region,
    c_mktsegment AS Segment,
    o_orderpriority AS LeadSource,
    IsoCode AS CurrencyIsoCode,
    CloseDate,
    CreatedDate,
    SAO_Date,
    if(k % 8 = 5, CloseDate + 40, CloseDate) AS Cohort_Close_Date,
    CAST(year(CloseDate) AS VARCHAR) || '-Q' || CAST(quarter(CloseDate) AS VARCHAR) AS Fiscal,
    acv AS ACV_Bookings,
    o_totalprice AS Amount,
    o_totalprice * CAST(0.5 AS DOUBLE) AS ExpectedRevenue,
    CASE WHEN k % 10 <> 8 THEN acv END AS Software_QB,
    CASE WHEN k % 10 = 8 THEN acv END AS RW_Expansion_Amount,
    CASE WHEN k % 7 = 0 THEN NULL ELSE acv * CAST(0.9 AS DOUBLE) END AS Managers_Forecast,
    CASE WHEN k % 17 = 0 THEN NULL ELSE acv * CAST(0.95 AS DOUBLE) END AS Recurring_Booking_PY,
    CASE WHEN k % 19 = 0 THEN NULL ELSE acv * CAST(1.02 AS DOUBLE) END AS Billing_Period_1,
    CASE WHEN k % 23 = 0 THEN NULL ELSE CAST((3 * k) % 200 AS INTEGER) END AS Days_Stale,
    {_case("k % 5", crm.RENEWAL_TYPES)} AS Renewal_Type,
    CAST(k % 80 AS INTEGER) AS MEDDPICC_Score,
    {_case("k % 3", crm.EXPANSION_CATEGORIES)} AS Expansion_Category,
    {_case("k % 4", crm.NEXT_STEPS)} AS NextStep,
    {_case("(k // 4) % 5", [name for _, name in crm.ROLES])} AS Owner_Role_at_Assignment,
    CASE WHEN k % 9 = 0 THEN NULL ELSE CloseDate + CAST((11 * k) % 400 AS INTEGER) END AS Existing_Contract_End_Date,
    CASE WHEN k % 29 = 0 THEN NULL ELSE SAO_Date - 10 END AS Discovery_Set_Date,
    CASE WHEN k % 31 = 0 THEN NULL ELSE SAO_Date + CAST(k % 20 AS INTEGER) END AS Eval_Planning_Date,
    CASE WHEN k % 37 = 0 THEN NULL ELSE SAO_Date + CAST(20 + k % 15 AS INTEGER) END AS Tech_Eval_Date,
    CASE WHEN k % 41 = 0 THEN NULL ELSE SAO_Date + CAST(30 + k % 25 AS INTEGER) END AS Negotiation_Date,
    k AS _k{prod_cols}
  FROM opp_sao
),
opportunity AS (SELECT * EXCLUDE (_k) FROM opportunity_k)"""


def _cte_user() -> str:
    return f"""users AS (
  SELECT s_suppkey AS Id,
         'Rep-' || CAST(s_suppkey AS VARCHAR) AS Name,
         CASE WHEN s_suppkey = {crm.USER_WITHOUT_MANAGER} THEN NULL
              ELSE 'Manager-' || CAST(s_suppkey % 3 AS VARCHAR) END AS Manager,
         s_suppkey % 4 AS UserRoleId,
         CASE WHEN s_suppkey % 2 = 0 THEN 'NA' ELSE 'EU + ROW' END AS sales_territory
  FROM supplier)"""


def _cte_values(name: str, cols: str, rows: Sequence[tuple]) -> str:
    vals = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {vals}) t({cols}))"


def _cte_history(dates: Sequence[dt.date]) -> str:
    snaps = ", ".join(f"({i}, DATE '{d.isoformat()}')" for i, d in enumerate(dates))
    return f"""snap_dates AS (SELECT * FROM (VALUES {snaps}) t(i, d)),
history AS (
  SELECT o.Id, s.d AS snapshot_date,
         CAST(s.d AS TIMESTAMP) + INTERVAL 6 HOUR AS Snapshot_Time,
         CASE WHEN o._k % 29 = 0 THEN 'Closed Lost' ELSE 'Proposal' END AS StageName,
         o.Type,
         CASE WHEN o._k % 6 IN (0, 1) AND s.i >= 1 AND s.d >= o.CloseDate - CAST(o._k % 120 AS INTEGER)
              THEN o.CloseDate
              WHEN o._k % 6 = 0 THEN o.CloseDate + 95 WHEN o._k % 6 = 1 THEN o.CloseDate - 95
              ELSE o.CloseDate END AS CloseDate,
         o.SAO_Date,
         CASE WHEN o._k % 7 = 3 THEN {_case("((o._k // 10) + 1) % 8", crm.CATEGORIES)} ELSE o.Category END AS Category,
         CASE WHEN o._k % 10 <> 8 THEN o.acv_s / ct.ConversionRate END AS Software_USD,
         CASE WHEN o._k % 10 = 8 THEN o.acv_s / ct.ConversionRate END AS Expansion_USD,
         o.acv_s / ct.ConversionRate AS qb_usd,
         o.Name, o.AccountId, o.OwnerId, o.Renewal_Type, o.acv_s AS ACV_Bookings,
         CASE WHEN (o._k + s.i) % 7 = 0 THEN NULL ELSE o.acv_s * CAST(0.9 AS DOUBLE) END AS Managers_Forecast,
         o.Test_Account, o.CurrencyIsoCode
  FROM (SELECT *, CASE WHEN _k % 5 = 2 THEN ACV_Bookings * CAST(0.97 AS DOUBLE) ELSE ACV_Bookings END AS acv_s
        FROM opportunity_k) o
  JOIN snap_dates s ON o.CreatedDate <= s.d
  LEFT JOIN currency ct ON o.CurrencyIsoCode = ct.IsoCode)"""


FIELD_HISTORY = """field_history AS (
  SELECT Id AS OpportunityId, 'CloseDate' AS field,
         CAST(CASE WHEN _k % 6 = 0 THEN CloseDate + 95 ELSE CloseDate - 95 END AS VARCHAR) AS OldValue,
         CAST(CloseDate AS VARCHAR) AS NewValue,
         CAST(CloseDate - CAST(_k % 120 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR AS CreatedDate
  FROM opportunity_k WHERE _k % 6 IN (0, 1)
  UNION ALL
  SELECT Id, 'CloseDate',
         CAST(CloseDate + 95 AS VARCHAR),
         CAST(CloseDate AS VARCHAR),
         CAST(CloseDate + CAST(5 - _k % 30 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR
  FROM opportunity_k WHERE _k % 12 = 0)"""

ACTIVITY = """activity AS (
  SELECT 'Rep-' || CAST(user_id AS VARCHAR) AS Name, event_type AS Metric, value AS Amount,
         CAST(ts AS DATE) AS ActivityDate
  FROM events)"""

ACCOUNT = """account AS (SELECT c_custkey AS Id, c_name AS Name FROM customer)"""


def views(*names: str, with_product: bool = False, dates: Sequence[dt.date] | None = None) -> str:
    """WITH clause defining the requested views (and what they depend on).

    Names: currency, opportunity, users, user_role, account, rep_group,
    excluded_owner, history, field_history, activity.
    """
    want = set(names)
    if want & {"history", "field_history"}:
        want.add("opportunity")
    if want & {"history", "opportunity"}:
        want.add("currency")
    parts = [_cte_region_map()]
    if "currency" in want:
        parts.append(CURRENCY)
    if "opportunity" in want:
        parts.append(_cte_opp(with_product))
    if "users" in want:
        parts.append(_cte_user())
    if "user_role" in want:
        parts.append(_cte_values("user_role", "Id, Name", crm.ROLES))
    if "account" in want:
        parts.append(ACCOUNT)
    if "rep_group" in want:
        parts.append(_cte_values("rep_group", "Name, \"Group\"", crm.REP_GROUPS))
    if "excluded_owner" in want:
        parts.append(_cte_values("excluded_owner", "Name", [(n,) for n in crm.EXCLUDED_OWNERS]))
    if "history" in want:
        parts.append(_cte_history(dates or []))
    if "field_history" in want:
        parts.append(FIELD_HISTORY)
    if "activity" in want:
        parts.append(ACTIVITY)
    return "WITH " + ",\n".join(parts) + "\n"
