"""DuckDB texts for the scorecard jobs."""

from __future__ import annotations

from pipewright.functions import dims
from pipewright.functions.periods import ReportParams, quarter_key
from pipewright.oracle.fixtures import _lit, views
from pipewright.plans.scorecard import BASE_URL


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def D(d) -> str:
    return f"DATE '{d.isoformat()}'"


def link(id_expr: str, kind: str, name_expr: str) -> str:
    url = f"'{BASE_URL}/lightning/r/{kind}/' || CAST({id_expr} AS VARCHAR) || '/view'"
    return f"""'=HYPERLINK("' || {url} || '","' || coalesce(CAST({name_expr} AS VARCHAR), 'NA') || '")'"""


# report column <- deal column
USD_COLUMNS = ", ".join(f"{src} / ConversionRate AS {out}" for out, src in {
    "Amount": "Amount", "Expected_Revenue": "ExpectedRevenue", "QB": "ACV_Bookings",
    "Recurring_Booking_PY": "Recurring_Booking_PY", "Managers_Forecast": "Managers_Forecast",
    "Billing_Period_1": "Billing_Period_1"}.items())
PLAIN_COLUMNS = ", ".join(f"graded.{src} AS {out}" for out, src in {
    "OppId": "Id", "Opp_Name": "Name", "AccountId": "AccountId", "Owner_Name": "Owner_Name", "User_Role": "User_Role",
    "Stage": "StageName", "Fiscal_Period": "Fiscal", "Days_Stale": "stale", "Close_Date": "CloseDate",
    "Created_Date": "CreatedDate", "Lead_Source": "LeadSource", "Type": "Type", "Category": "Category",
    "Cohort_Close_Date": "Cohort_Close_Date", "Sales_Next_Steps": "NextStep",
    "Owner_Role_at_Assignment": "Owner_Role_at_Assignment", "Existing_Contract_End_Date": "Existing_Contract_End_Date", "SAO_Date": "SAO_Date", "MEDDPICC_Score": "MEDDPICC_Score"}.items())


def enriched_ctes(p: ReportParams) -> str:
    """WITH ... base AS (the W02 rows)."""
    return views("opportunity", "account", "users", "user_role", "currency", "excluded_owner") + f""",
owners AS (
  SELECT users.Id AS owner_id, users.Name AS Owner_Name, user_role.Name AS User_Role,
         EXISTS (FROM excluded_owner x WHERE x.Name = users.Name) AS barred
  FROM users LEFT JOIN user_role ON user_role.Id = UserRoleId
),
graded AS (
  SELECT *, coalesce(Days_Stale, CAST({D(p.rpt_date)} - {D(p.stale_origin)} AS INTEGER)) AS stale
  FROM opportunity LEFT JOIN owners ON owner_id = OwnerId
  WHERE NOT Test_Account AND NOT coalesce(barred, FALSE)
    AND Cohort_Close_Date BETWEEN {D(p.rpt_start)} AND {D(p.rpt_end)} - 1
    AND NOT list_contains({list(dims.HOUSEKEEPING_STAGES)}, StageName)
    AND NOT coalesce(list_contains({list(dims.INSTALLMENT_RENEWAL_TYPES)}, Renewal_Type), FALSE)
),
enriched AS (
  SELECT {USD_COLUMNS}, {PLAIN_COLUMNS}, account.Name AS Account_Name
  FROM graded LEFT JOIN currency ON IsoCode = CurrencyIsoCode LEFT JOIN account ON account.Id = AccountId
),
flags AS (
  SELECT *,
         CAST(year(Cohort_Close_Date) * 10 + quarter(Cohort_Close_Date) AS INTEGER) AS rpt_qtr,
         {link("AccountId", "Account", "Account_Name")} AS Account_Name_link,
         {link("OppId", "Opportunity", "Opp_Name")} AS Opp_Name_link,
         coalesce(Stage = 'Closed Won', FALSE) AS won,
         coalesce(Stage = 'Closed Lost', FALSE) AS lost
  FROM enriched
),
fc AS (
  SELECT *, NOT won AND NOT lost AS "open",
         CASE WHEN won THEN QB WHEN NOT won AND NOT lost THEN Managers_Forecast ELSE CAST(0 AS DOUBLE) END AS forecast
  FROM flags
),
base AS (SELECT *, least(forecast, Billing_Period_1, Recurring_Booking_PY) AS sdr_numerator FROM fc)
"""


def opps_enriched(p: ReportParams) -> str:
    return enriched_ctes(p) + "SELECT * FROM base"


def _periods_union(p: ReportParams, date_col: str, where: str) -> str:
    parts = []
    for k, (s, e) in p.periods().items():
        parts.append(f"SELECT '{k}' AS period, * FROM base WHERE {date_col} >= {D(s)} AND {date_col} < {D(e)} AND {where}")
    return "\nUNION ALL\n".join(parts)


def _m(x: str) -> str:
    """USD double -> whole money units of 1/10000 USD."""
    return f"CAST(round({x} * 10000) AS DECIMAL(22,0))"


def _usd(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / CAST(10000 AS DOUBLE))"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def renewal_scorecard_ctes(p: ReportParams) -> str:
    ren = f"coalesce(Category IN {_in(dims.RENEWAL_CATEGORIES)}, FALSE)"
    return enriched_ctes(p) + f""",
ren_rows AS ({_periods_union(p, "Cohort_Close_Date", ren)}),
ren_agg AS (
  SELECT period, Owner_Name,
         count(*) AS Renew_avail_Num,
         count(*) FILTER (WHERE won) AS Renew_Won,
         count(*) FILTER (WHERE lost) AS Renew_Lost,
         coalesce(sum({_m("Recurring_Booking_PY")}), 0) AS avail,
         coalesce(sum({_m("QB")}) FILTER (WHERE won), 0) AS won_qb,
         coalesce(sum({_m("Recurring_Booking_PY")}) FILTER (WHERE won), 0) AS won_rbpy,
         count(*) FILTER (WHERE "open") AS still_open,
         coalesce(sum({_m("QB")}) FILTER (WHERE "open"), 0) AS open_usd,
         coalesce(sum({_m("forecast")}), 0) AS fc,
         coalesce(sum({_m("sdr_numerator")}), 0) AS sdr
  FROM ren_rows GROUP BY period, Owner_Name
),
renewal AS (
  SELECT period, Owner_Name, Renew_avail_Num,
         {_usd("avail")} AS Renew_avail_usd,
         {_usd("won_qb")} AS Renew_Won_QB_usd,
         {_ratio("won_qb", "won_rbpy")} AS gross_pim,
         round_even({_ratio("Renew_Won", "Renew_Won + Renew_Lost")} * 100, 0) / CAST(100 AS DOUBLE) AS retention,
         {_ratio("fc", "avail")} AS forecast_net_pim,
         still_open,
         {_usd("open_usd")} AS open_usd,
         Renew_Won, Renew_Lost,
         {_usd("won_rbpy")} AS Renew_Won_RBPY_usd,
         {_usd("fc")} AS forecast_usd,
         {_ratio("sdr", "avail")} AS standard_dollar_retention,
         {_ratio("fc", "avail")} AS Projected_price_increase_capture
  FROM ren_agg
),
sao_rows AS ({_periods_union(p, "SAO_Date", f"SAO_Date IS NOT NULL AND NOT coalesce(Category IN {_in(dims.RENEWAL_CATEGORIES)}, FALSE)")}),
sao AS (
  SELECT period, Owner_Name, count(*) AS sao_num,
         {_usd(f"coalesce(sum({_m('QB')}), 0)")} AS pipe_created
  FROM sao_rows GROUP BY period, Owner_Name
)
"""


def renewal_scorecard(p: ReportParams) -> str:
    return renewal_scorecard_ctes(p) + "SELECT * FROM renewal"


def sao_scorecard(p: ReportParams) -> str:
    return renewal_scorecard_ctes(p) + "SELECT * FROM sao"


def owner_scorecard(p: ReportParams) -> str:
    return renewal_scorecard_ctes(p) + """
SELECT r.period, r.Owner_Name, r.Renew_avail_Num, r.Renew_avail_usd, r.Renew_Won_QB_usd, r.gross_pim,
       r.retention, r.forecast_net_pim, r.still_open, r.open_usd, s.sao_num, s.pipe_created,
       r.Renew_Won, r.Renew_Lost, r.Renew_Won_RBPY_usd, r.forecast_usd, r.standard_dollar_retention,
       r.Projected_price_increase_capture
FROM renewal r LEFT JOIN sao s ON r.period = s.period AND r.Owner_Name IS NOT DISTINCT FROM s.Owner_Name"""


def _this_quarter(p: ReportParams) -> str:
    return (f"rpt_qtr = {quarter_key(p.this_q_start)} AND QB > 0 "
            f"AND NOT coalesce(Category IN {_in(dims.NON_PIPELINE_CATEGORIES)}, FALSE)")


def stage_mix(p: ReportParams) -> str:
    levels = ", ".join(f"({_lit(s)}, {i + 1})" for i, s in enumerate(dims.PIPELINE_STAGE_ORDER))
    return enriched_ctes(p) + f""",
stage_dim AS (SELECT * FROM (VALUES {levels}) t(Stage_Name, stage_rank)),
rows AS (
  SELECT b.*, sd.Stage_Name, sd.stage_rank FROM base b LEFT JOIN stage_dim sd ON b.Stage = sd.Stage_Name
  WHERE {_this_quarter(p)} AND NOT coalesce(Stage IN {_in(dims.STAGE_MIX_EXCLUDED)}, FALSE)
),
agg AS (
  SELECT Owner_Name, Stage_Name, stage_rank,
         sum({_m("QB")}) AS value_dec, count(*) AS "Count",
         string_agg(CAST(Days_Stale AS VARCHAR), ', ' ORDER BY OppId) AS Days_In_Stage
  FROM rows GROUP BY Owner_Name, Stage_Name, stage_rank
)
SELECT Owner_Name, Stage_Name, stage_rank, {_usd("value_dec")} AS Value, "Count", Days_In_Stage,
       CAST(value_dec AS DOUBLE) / NULLIF(CAST(sum(value_dec) OVER (PARTITION BY Owner_Name) AS DOUBLE), 0) AS pct_of_total,
       coalesce(Stage_Name IN {_in(dims.RENEWAL_PIPELINE_STAGES)}, FALSE) AS is_renewal
FROM agg"""


def stage_days(p: ReportParams, piece: int) -> str:
    levels = ", ".join(f"({_lit(s)}, {i + 1})" for i, s in enumerate(dims.PIPELINE_STAGE_ORDER))
    return enriched_ctes(p) + f""",
numbered AS (
  SELECT Owner_Name, Stage_Name, stage_rank, Days_Stale,
         row_number() OVER (PARTITION BY Owner_Name, Stage_Name ORDER BY OppId) AS place
  FROM base LEFT JOIN (VALUES {levels}) t(Stage_Name, stage_rank) ON Stage = Stage_Name
  WHERE {_this_quarter(p)} AND NOT coalesce(Stage IN {_in(dims.STAGE_MIX_EXCLUDED)}, FALSE)
)
SELECT Owner_Name, Stage_Name, stage_rank, (place - 1) // {piece} AS piece, min(place) AS first_place, count(*) AS entries,
       max(place) AS entries_so_far, string_agg(CAST(Days_Stale AS VARCHAR), ', ' ORDER BY place) AS days
FROM numbered GROUP BY ALL"""


def top_deals(p: ReportParams, n: int = dims.TOP_DEALS_PER_OWNER) -> str:
    excl = dims.CLOSED_STAGES + dims.TOP_DEALS_EXCLUDED
    return enriched_ctes(p) + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Owner_Name ORDER BY QB DESC, OppId DESC) AS "rank"
  FROM base
  WHERE {_this_quarter(p)} AND NOT coalesce(Stage IN {_in(excl)}, FALSE)
)
SELECT Owner_Name AS Opportunity_Owner, 'Q' || CAST(quarter(Cohort_Close_Date) AS VARCHAR) AS Quarter,
       Opp_Name_link AS Opportunity_Name, Stage, Category AS Type, QB AS Amount, Close_Date,
       MEDDPICC_Score, Days_Stale AS Days_in_Stage, CAST("rank" AS INTEGER) AS "rank"
FROM ranked WHERE "rank" <= {n}"""


def rep_win_rates(p: ReportParams) -> str:
    s, e = p.unit
    return enriched_ctes(p) + f"""
SELECT User_Role, Owner_Name,
       count(*) FILTER (WHERE Stage = 'Closed Won') AS Wins,
       count(*) FILTER (WHERE Stage = 'Closed Lost') AS Losses,
       {_ratio("count(*) FILTER (WHERE Stage = 'Closed Won')", "count(*) FILTER (WHERE Stage = 'Closed Won') + count(*) FILTER (WHERE Stage = 'Closed Lost')")} AS Win_Rate,
       {_usd(f"coalesce(sum({_m('QB')}) FILTER (WHERE Stage = 'Closed Won'), 0)")} AS Won_USD
FROM base
WHERE Cohort_Close_Date >= {D(s)} AND Cohort_Close_Date < {D(e)} AND SAO_Date IS NOT NULL
GROUP BY User_Role, Owner_Name"""


def renewal_rows(p: ReportParams) -> str:
    s, e = p.periods()["Y"]
    return enriched_ctes(p) + f"""
SELECT * FROM base
WHERE Cohort_Close_Date >= {D(s)} AND Cohort_Close_Date < {D(e)}
  AND coalesce(Category IN {_in(dims.RENEWAL_CATEGORIES)}, FALSE)"""
