"""Owner scorecards, stage mix, top deals and win rates.

All jobs start from :func:`opps_enriched` (one row per deal in the scorecard
window, money in USD). Periods are parameters; both grading windows (prior
year and prior quarter) are produced in one pass by tagging each row with the
windows it falls in (at most two) and grouping by that tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.functions.money import money, to_usd, usd
from pipewright.functions.nulls import (cond_count, cond_sum, in_set, not_in_or_null, not_in_set, round_half_even,
                                        safe_ratio)
from pipewright.functions.periods import ReportParams, col_quarter_key, in_window, quarter_key
from pipewright.functions.text import link_formula, record_link
from pipewright.operators import joins
from pipewright.operators.topn import top_n
from pipewright.session import store
from pipewright.sources import crm

BASE_URL = "https://crm.example.com"

# scorecard columns, in report order
SCORECARD_COLUMNS = ["Owner_Name", "Renew_avail_Num", "Renew_avail_usd", "Renew_Won_QB_usd", "gross_pim",
                     "retention", "forecast_net_pim", "still_open", "open_usd", "sao_num", "pipe_created",
                     "Renew_Won", "Renew_Lost", "Renew_Won_RBPY_usd", "forecast_usd",
                     "standard_dollar_retention", "Projected_price_increase_capture"]


def opps_enriched(spark: SparkSession, sf_dir: str, p: ReportParams, base_url: str = BASE_URL,
                  with_account: bool = True) -> DataFrame:
    """Deals with account, owner, role and USD money, scorecard filters applied.

    The account table is as large as the customer base; jobs that do not
    output account names pass ``with_account=False`` so that join (and its
    shuffle) is not in their plan.
    """
    o = crm.opportunity(spark, sf_dir)
    a = crm.account(spark, sf_dir).select(F.col("Id").alias("a_Id"), F.col("Name").alias("Account_Name"))
    u = crm.user(spark, sf_dir).select(F.col("Id").alias("u_Id"), F.col("Name").alias("Owner_Name"),
                                       F.col("UserRoleId"))
    ur = crm.user_role(spark, sf_dir).select(F.col("Id").alias("ur_Id"), F.col("Name").alias("User_Role"))
    ct = crm.currency(spark, sf_dir)

    o = o.where(in_window(F.col("Cohort_Close_Date"), p.rpt_start, p.rpt_end)
                & (F.col("Test_Account") == F.lit(False))
                & not_in_or_null(F.col("Renewal_Type"), dims.INSTALLMENT_RENEWAL_TYPES)
                & ~F.col("StageName").isin(dims.HOUSEKEEPING_STAGES))
    if with_account:
        o = o.join(a, o.AccountId == a.a_Id, "left")
    else:
        o = o.withColumn("Account_Name", F.lit(None).cast("string"))
    df = (joins.lookup(o, u, "OwnerId", "u_Id", F.col("Id"))
           .join(F.broadcast(ur), F.col("UserRoleId") == F.col("ur_Id"), "left")
           .join(F.broadcast(ct), o.CurrencyIsoCode == ct.IsoCode, "left"))
    # owners excluded by name; a deal without an owner name stays
    df = joins.anti(df, F.broadcast(crm.excluded_owner(spark, sf_dir)), "Owner_Name", "Name")

    rate = F.col("ConversionRate")
    stale_fill = F.datediff(F.lit(p.rpt_date), F.lit(p.stale_origin))
    df = df.select(
        F.col("Id").alias("OppId"), "AccountId", "Account_Name", "Owner_Name", "User_Role",
        F.col("Name").alias("Opp_Name"), F.col("StageName").alias("Stage"), F.col("Fiscal").alias("Fiscal_Period"),
        to_usd(F.col("Amount"), rate).alias("Amount"),
        to_usd(F.col("ExpectedRevenue"), rate).alias("Expected_Revenue"),
        F.coalesce(F.col("Days_Stale"), stale_fill).alias("Days_Stale"),
        F.col("CloseDate").alias("Close_Date"), F.col("CreatedDate").alias("Created_Date"),
        F.col("NextStep").alias("Sales_Next_Steps"), F.col("LeadSource").alias("Lead_Source"), "Type", "Cohort_Close_Date",
        "Owner_Role_at_Assignment", "Existing_Contract_End_Date",
        to_usd(F.col("ACV_Bookings"), rate).alias("QB"),
        "Category",
        to_usd(F.col("Recurring_Booking_PY"), rate).alias("Recurring_Booking_PY"),
        to_usd(F.col("Managers_Forecast"), rate).alias("Managers_Forecast"),
        "SAO_Date", "MEDDPICC_Score",
        to_usd(F.col("Billing_Period_1"), rate).alias("Billing_Period_1"))
    won = F.col("Stage") == dims.STAGE_CLOSED_WON
    lost = F.col("Stage") == dims.STAGE_CLOSED_LOST
    cols = {
        "rpt_qtr": col_quarter_key(F.col("Cohort_Close_Date")),
        "Account_Name_link": link_formula(record_link(F.col("AccountId"), "Account", base_url), F.col("Account_Name")),
        "Opp_Name_link": link_formula(record_link(F.col("OppId"), "Opportunity", base_url), F.col("Opp_Name")),
        "won": F.coalesce(won, F.lit(False)),
        "lost": F.coalesce(lost, F.lit(False)),
    }
    if not with_account:
        del cols["Account_Name_link"]
    df = df.withColumns(cols)
    if not with_account:
        df = df.drop("Account_Name")
    df = df.withColumn("open", ~F.col("won") & ~F.col("lost"))
    df = df.withColumn("forecast", F.when(F.col("won"), F.col("QB"))
                                    .when(F.col("open"), F.col("Managers_Forecast"))
                                    .otherwise(F.lit(0.0)))
    # smallest of three amounts, skipping missing ones; all missing -> NULL
    return df.withColumn("sdr_numerator", F.least("forecast", "Billing_Period_1", "Recurring_Booking_PY"))


def _tag_periods(df: DataFrame, date_col: str, p: ReportParams) -> DataFrame:
    """One row per (deal, grading window it falls in); a deal can be in both."""
    tags = F.array(*[F.when(in_window(F.col(date_col), s, e), F.lit(k)) for k, (s, e) in p.periods().items()])
    return df.withColumn("period", F.explode(F.filter(tags, lambda x: x.isNotNull())))


def renewal_scorecard(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """Renewal measures per owner and grading window."""
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    df = _tag_periods(base.where(in_set(F.col("Category"), dims.RENEWAL_CATEGORIES)), "Cohort_Close_Date", p)
    won, lost, opn = F.col("won"), F.col("lost"), F.col("open")
    rbpy, qb = money(F.col("Recurring_Booking_PY")), money(F.col("QB"))
    agg = df.groupBy("period", "Owner_Name").agg(
        F.count(F.lit(1)).alias("Renew_avail_Num"),
        cond_count(won).alias("Renew_Won"),
        cond_count(lost).alias("Renew_Lost"),
        cond_sum(F.lit(True), rbpy).alias("avail"),
        cond_sum(won, qb).alias("won_qb"),
        cond_sum(won, rbpy).alias("won_rbpy"),
        cond_count(opn).alias("still_open"),
        cond_sum(opn, qb).alias("open_usd"),
        cond_sum(F.lit(True), money(F.col("forecast"))).alias("fc"),
        cond_sum(F.lit(True), money(F.col("sdr_numerator"))).alias("sdr"),
    )
    return agg.select(
        "period", "Owner_Name", "Renew_avail_Num",
        usd(F.col("avail")).alias("Renew_avail_usd"),
        usd(F.col("won_qb")).alias("Renew_Won_QB_usd"),
        safe_ratio(F.col("won_qb"), F.col("won_rbpy")).alias("gross_pim"),
        round_half_even(safe_ratio(F.col("Renew_Won"), F.col("Renew_Won") + F.col("Renew_Lost")), 2).alias("retention"),
        safe_ratio(F.col("fc"), F.col("avail")).alias("forecast_net_pim"),
        "still_open",
        usd(F.col("open_usd")).alias("open_usd"),
        "Renew_Won", "Renew_Lost",
        usd(F.col("won_rbpy")).alias("Renew_Won_RBPY_usd"),
        usd(F.col("fc")).alias("forecast_usd"),
        safe_ratio(F.col("sdr"), F.col("avail")).alias("standard_dollar_retention"),
        safe_ratio(F.col("fc"), F.col("avail")).alias("Projected_price_increase_capture"))


def renewal_rows(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """The deals behind the prior-year renewal scorecard (its raw-data tab)."""
    s, e = p.periods()["Y"]
    base = base if base is not None else opps_enriched(spark, sf_dir, p)
    return base.where(in_window(F.col("Cohort_Close_Date"), s, e) & in_set(F.col("Category"), dims.RENEWAL_CATEGORIES))


def sao_scorecard(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """Accepted deals and pipe created per owner, renewals left out."""
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    df = base.where(F.col("SAO_Date").isNotNull() & not_in_set(F.col("Category"), dims.RENEWAL_CATEGORIES))
    df = _tag_periods(df, "SAO_Date", p)
    return df.groupBy("period", "Owner_Name").agg(
        F.count(F.lit(1)).alias("sao_num"),
        usd(cond_sum(F.lit(True), money(F.col("QB")))).alias("pipe_created"))


def owner_scorecard(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """Renewal scorecard with the SAO measures beside it, fixed column order."""
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    ren = renewal_scorecard(spark, sf_dir, p, base)
    sao = sao_scorecard(spark, sf_dir, p, base).withColumnsRenamed({"period": "s_period", "Owner_Name": "s_owner"})
    df = ren.join(sao, (ren.period == sao.s_period) & ren.Owner_Name.eqNullSafe(sao.s_owner), "left")
    df = df.drop("s_period", "s_owner")
    unexpected = set(df.columns) - set(SCORECARD_COLUMNS) - {"period"}
    if unexpected:
        raise ValueError(f"unexpected scorecard columns: {sorted(unexpected)}")
    return df.select("period", *SCORECARD_COLUMNS)


def _this_quarter_pipeline(base: DataFrame, p: ReportParams) -> DataFrame:
    return base.where((F.col("rpt_qtr") == F.lit(quarter_key(p.this_q_start)))
                      & (F.col("QB") > 0)
                      & not_in_set(F.col("Category"), dims.NON_PIPELINE_CATEGORIES))


STAGE_KEYS = ["Owner_Name", "Stage_Name", "stage_rank"]
PIECE = 1000  # entries of a days list in one row


def _stage_rows(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None) -> DataFrame:
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    base = _this_quarter_pipeline(base, p).where(not_in_set(F.col("Stage"), dims.STAGE_MIX_EXCLUDED))
    sd = dims.stage_dim(spark).withColumnRenamed("stage", "Stage_Name")
    return base.join(F.broadcast(sd), base.Stage == sd.Stage_Name, "left")


def stage_days(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """The days lists of ``stage_mix`` as rows of at most ``piece`` entries, so no value grows with its group.

    A row has its number in the list, the place of its first entry, its entries
    and the entries so far; the lists joined in that order are the string.

    The deals are dealt to ranges of (group, deal id) and written out. A deal's
    place is the size of its group's earlier ranges plus its place in its own, so
    no task sorts a whole group.
    """
    rows = _stage_rows(spark, sf_dir, p, base).select(*STAGE_KEYS, "OppId", "Days_Stale")
    rows = store(rows.repartitionByRange(*STAGE_KEYS, "OppId").withColumn("range", F.spark_partition_id()))
    sizes = rows.groupBy(*STAGE_KEYS, "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*STAGE_KEYS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(k).alias(f"__{k}") for k in [*STAGE_KEYS, "range"]],
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(*STAGE_KEYS, "range").orderBy("OppId"))
    same = F.lit(True)
    for k in [*STAGE_KEYS, "range"]:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    placed = rows.withColumn("own", own).join(sizes, same).withColumn("place", F.col("before") + F.col("own") - 1)
    out = placed.withColumn("piece", F.expr(f"place div {piece}")).groupBy(*STAGE_KEYS, "piece").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"),
        F.expr("listagg(cast(Days_Stale as string), ', ') WITHIN GROUP (ORDER BY place)").alias("days"))
    return out.select(*STAGE_KEYS, "piece", (F.col("first") + 1).alias("first_place"), F.col("n").alias("entries"),
                      (F.col("first") + F.col("n")).alias("entries_so_far"), "days")


def stage_mix(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """Open pipeline of this quarter per owner and stage.

    Days-in-stage is the list of each deal's days stale, ordered by deal id.
    It is built in two levels so that no task sorts a whole (owner, stage)
    group: the rows are range-partitioned by owner, stage and id, each
    partition's part of a group is one ordered piece, and the pieces are
    joined in partition order. Values and counts add up across pieces.
    """
    df, keys = _stage_rows(spark, sf_dir, p, base), STAGE_KEYS
    pieces = (df.repartitionByRange(*keys, "OppId").withColumn("id_range", F.spark_partition_id())
                .groupBy(*keys, "id_range").agg(
                    F.sum(money(F.col("QB"))).alias("v"),
                    F.count(F.lit(1)).alias("n"),
                    F.expr("listagg(cast(Days_Stale as string), ', ') WITHIN GROUP (ORDER BY OppId)").alias("days")))
    agg = pieces.groupBy(*keys).agg(
        F.sum("v").alias("value_dec"),
        F.sum("n").alias("Count"),
        F.expr("listagg(days, ', ') WITHIN GROUP (ORDER BY id_range)").alias("Days_In_Stage"))
    owner_total = F.sum("value_dec").over(Window.partitionBy("Owner_Name"))
    return (agg.select(
                "Owner_Name", "Stage_Name", "stage_rank",
                usd(F.col("value_dec")).alias("Value"),
                "Count", "Days_In_Stage",
                safe_ratio(F.col("value_dec"), owner_total).alias("pct_of_total"),
                in_set(F.col("Stage_Name"), dims.RENEWAL_PIPELINE_STAGES).alias("is_renewal"))
            .orderBy(F.asc_nulls_last("Owner_Name"), F.desc_nulls_last("stage_rank")))


def top_deals(spark: SparkSession, sf_dir: str, p: ReportParams, n: int = dims.TOP_DEALS_PER_OWNER,
              base: DataFrame | None = None) -> DataFrame:
    """The ``n`` largest open deals of this quarter per owner.

    Ties on amount go to the larger deal id (the reports keep the last rows of
    an ascending sort; the id makes that order total).
    """
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    base = _this_quarter_pipeline(base, p).where(
        not_in_set(F.col("Stage"), dims.CLOSED_STAGES + dims.TOP_DEALS_EXCLUDED))
    ranked = top_n(base, ["Owner_Name"], [F.desc("QB"), F.desc("OppId")], n, "rank")
    return (ranked.select(
                F.col("Owner_Name").alias("Opportunity_Owner"),
                F.concat(F.lit("Q"), F.quarter("Cohort_Close_Date").cast("string")).alias("Quarter"),
                F.col("Opp_Name_link").alias("Opportunity_Name"),
                "Stage",
                F.col("Category").alias("Type"),
                F.col("QB").alias("Amount"),
                F.col("Close_Date"),
                F.col("MEDDPICC_Score"),
                F.col("Days_Stale").alias("Days_in_Stage"),
                "rank")
            .orderBy(F.asc_nulls_last("Opportunity_Owner"), "rank"))


def rep_win_rates(spark: SparkSession, sf_dir: str, p: ReportParams, base: DataFrame | None = None) -> DataFrame:
    """Wins, losses, win rate and won USD per role and owner in the grading window."""
    s, e = p.unit
    base = base if base is not None else opps_enriched(spark, sf_dir, p, with_account=False)
    base = base.where(in_window(F.col("Cohort_Close_Date"), s, e)
                                                 & F.col("SAO_Date").isNotNull())
    agg = base.groupBy("User_Role", "Owner_Name").agg(
        cond_count(F.col("Stage") == dims.STAGE_CLOSED_WON).alias("Wins"),
        cond_count(F.col("Stage") == dims.STAGE_CLOSED_LOST).alias("Losses"),
        cond_sum(F.col("Stage") == dims.STAGE_CLOSED_WON, money(F.col("QB"))).alias("won"))
    return agg.select("User_Role", "Owner_Name", "Wins", "Losses",
                      safe_ratio(F.col("Wins"), F.col("Wins") + F.col("Losses")).alias("Win_Rate"),
                      usd(F.col("won")).alias("Won_USD"))
