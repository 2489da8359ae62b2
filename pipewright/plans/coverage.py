"""Rule set v2: forecasted deals and the coverage table by type and region.

Differences from the v3/v4 movement (``plans.movement``): the starting set is
read from the anchor snapshot with owner and renewal-type exclusions, amounts
are today's bookings, new pipe takes precedence over pulled in, a pulled-in
deal must have been forecast in the quarter in some snapshot between the
anchor and quarter end, and deals found in the quarter's totals but in no set
are folded into the pipe.

Plan: one wide row per deal = anchor snapshot LEFT JOIN current deals, and the
deals closing in the quarter without one LEFT JOIN the latest close-date move
and the forecast flag (all keyed by Id), then one conditional aggregate over (Type, region bucket). A measure whose
source set has no row for a key stays NULL, as in a merge of separate tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.functions.money import money, usd
from pipewright.functions.nulls import not_in_or_null
from pipewright.functions.periods import ReportParams, col_quarter_key
from pipewright.operators import joins
from pipewright.sources import crm

TYPES = (dims.TYPE_NEW, dims.TYPE_EXISTING)
FORECAST_STAGE_EXCL = ("Discovery", "Demonstration", "Untouched", "Temporary", "Data Quality", "Closed Lost")
START_STAGE_EXCL = ("Closed Lost", "Temporary", "Data Quality")
TODAY_STAGE_EXCL = ("Discovery", "Untouched", "Temporary", "Data Quality")


def _snapshots(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Every day of the derived snapshot table from the anchor to the quarter end."""
    return crm.snapshot_window(spark, sf_dir, p.anchor, p.q_end)


def forecasted_opps(spark: SparkSession, sf_dir: str, p: ReportParams,
                    snapshots: DataFrame | None = None) -> DataFrame:
    """Per (deal, close quarter) the largest USD bookings and forecast seen
    in any snapshot between the anchor and the quarter end."""
    snaps = snapshots if snapshots is not None else _snapshots(spark, sf_dir, p)
    snaps = snaps.where((F.col("snapshot_date") >= F.lit(p.anchor)) & (F.col("snapshot_date") < F.lit(p.q_end)))
    ct = crm.currency(spark, sf_dir)
    df = (snaps.where(~F.col("StageName").isin(list(FORECAST_STAGE_EXCL))
                      & (F.col("Test_Account") == F.lit(False))
                      & F.col("Type").isin(list(TYPES))
                      & (F.col("CloseDate") >= F.lit(p.q_start)))
               .join(F.broadcast(ct), F.col("CurrencyIsoCode") == F.col("IsoCode"), "left"))
    if p.exclude_ids:
        df = df.where(~F.col("Id").isin(list(p.exclude_ids)))
    rate = F.col("ConversionRate")
    return (df.select("Id", col_quarter_key(F.col("CloseDate")).alias("quarter"),
                      (F.col("ACV_Bookings") / rate).alias("qb_usd"),
                      (F.col("Managers_Forecast") / rate).alias("forecast_usd"))
              .groupBy("Id", "quarter")
              .agg(F.max("qb_usd").alias("qb_usd"), F.max("forecast_usd").alias("forecast_usd")))


def _excluded_owner_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = crm.user(spark, sf_dir)
    ex = crm.excluded_owner(spark, sf_dir)
    return u.join(F.broadcast(ex), u.Name == ex.Name, "left_semi").select("Id")


def coverage_wide(spark: SparkSession, sf_dir: str, p: ReportParams, opportunity: DataFrame | None = None,
                  snapshots: DataFrame | None = None, changes: DataFrame | None = None) -> DataFrame:
    """One row per deal with today's values, the anchor snapshot values and set flags.

    The full outer join of anchor snapshot and deals, less the deals that can
    be in no set: the snapshot rows with today's values, and the deals without
    a snapshot row that close (or whose cohort closes) in the quarter, with
    their move and forecast flag. The joins on the deal id come first, so
    inputs bucketed by id join without a shuffle; owner and currency lookups
    follow; users and excluded owners are broadcast after counting them.
    """
    ct = crm.currency(spark, sf_dir)
    ex_ids = joins.sized(_excluded_owner_ids(spark, sf_dir))
    # a landed snapshot table serves both the anchor read and the forecast window (partition pruning);
    # the derived fixture builds just the anchor day here
    snaps = snapshots if snapshots is not None else crm.history(spark, sf_dir, [p.anchor])

    # anchor snapshot, v2 filters
    h = snaps.where(F.col("snapshot_date") == F.lit(p.anchor))
    h = h.where(F.col("Type").isin(list(TYPES)) & ~F.col("StageName").isin(list(START_STAGE_EXCL))
                & (F.col("Test_Account") == F.lit(False))
                & not_in_or_null(F.col("Renewal_Type"), dims.INSTALLMENT_RENEWAL_TYPES)
                & (F.col("SAO_Date") < F.lit(p.anchor))
                & (F.col("CloseDate") >= F.lit(p.q_start)) & (F.col("CloseDate") < F.lit(p.q_end)))
    # OwnerId NOT IN (excluded owner ids): SQL meaning, a NULL owner is dropped when there are exclusions
    h = joins.sql_not_in(h, ex_ids, "OwnerId", "Id")
    if p.exclude_ids:
        h = h.where(~F.col("Id").isin(list(p.exclude_ids)))
    h = (h.join(F.broadcast(ct), F.col("CurrencyIsoCode") == F.col("IsoCode"), "left")
          .select(F.col("Id").alias("s_Id"), F.col("Type").alias("s_Type"), F.col("ConversionRate").alias("s_rate"),
                  F.col("Name").alias("s_Name"), F.col("SAO_Date").alias("s_SAO_Date"),
                  F.col("AccountId").alias("s_AccountId"), F.col("StageName").alias("previous_StageName"),
                  F.col("CloseDate").alias("previous_CloseDate"))
          # a deal may have several rows on the anchor day: each is a starting row, today's values count once
          .withColumn("s_rn", F.row_number().over(Window.partitionBy("s_Id").orderBy(
              "previous_CloseDate", "previous_StageName", "s_SAO_Date", "s_Name", "s_Type", "s_rate", "s_AccountId"))))

    # current deals (all of them: the snapshot rows read today's region and bookings)
    o = (opportunity if opportunity is not None else crm.opportunity(spark, sf_dir)).select(
        "Id", "Name", "Type", "StageName", "CloseDate", "SAO_Date", "Cohort_Close_Date", "OwnerId",
        "CurrencyIsoCode", "Test_Account", "Region", "ACV_Bookings")
    ch = changes if changes is not None else crm.field_history(spark, sf_dir)
    moves = (ch.where((F.col("field") == "CloseDate")
                      & (F.col("OldValue").try_cast("date") >= F.lit(p.q_end))
                      & (F.col("NewValue").try_cast("date") < F.lit(p.q_end))
                      & (F.col("NewValue").try_cast("date") >= F.lit(p.q_start)))
               .select(F.col("OpportunityId").alias("m_Id")).distinct())
    fq = (forecasted_opps(spark, sf_dir, p, snapshots=snapshots).where(F.col("quarter") == F.lit(p.q_key))
          .select(F.col("Id").alias("f_Id")).distinct())

    # every other set needs a close date (or cohort) in the quarter today and no anchor row; a date filter on the
    # scan leaves these deals only. Moves and the forecast flag matter for them alone.
    no_move = [F.lit(None).cast("string").alias(c) for c in ("m_Id", "f_Id")]
    in_snapshot = h.join(o, h.s_Id == o.Id, "left").select("*", *no_move)
    qs, qe = F.lit(p.q_start), F.lit(p.q_end)
    due = o.where(((F.col("CloseDate") >= qs) & (F.col("CloseDate") <= qe))
                  | ((F.col("Cohort_Close_Date") >= qs) & (F.col("Cohort_Close_Date") < qe)))
    due = due.join(h.select("s_Id"), due.Id == F.col("s_Id"), "left_anti")
    due = due.join(moves, due.Id == moves.m_Id, "left").join(fq, due.Id == fq.f_Id, "left")
    w = in_snapshot.unionByName(due, allowMissingColumns=True)

    # lookups by owner and currency
    u = crm.user(spark, sf_dir).select(F.col("Id").alias("u_Id"), "sales_territory")
    cur_ct = ct.select(F.col("IsoCode").alias("c_IsoCode"), F.col("ConversionRate").alias("c_rate"))
    w = (joins.lookup(w.join(F.broadcast(cur_ct), w.CurrencyIsoCode == cur_ct.c_IsoCode, "left"), u, "OwnerId", "u_Id",
                      F.coalesce("Id", "s_Id"))
          .join(ex_ids.select(F.col("Id").alias("ex_Id"), F.lit(True).alias("excluded_owner")),
                w.OwnerId == F.col("ex_Id"), "left"))
    # same SQL NOT IN on the owner, kept as a flag because every current row is needed below
    owner_ok = F.col("excluded_owner").isNull() & (F.col("OwnerId").isNotNull() | ~ex_ids.exists())
    today_base = ((F.col("Test_Account") == F.lit(False)) & ~F.col("StageName").isin(list(TODAY_STAGE_EXCL))
                  & owner_ok)
    if p.exclude_ids:
        today_base = today_base & ~F.col("Id").isin(list(p.exclude_ids))
    w = w.withColumns({"Current_QB_USD": F.col("ACV_Bookings") / F.col("c_rate"),
                       "bucket": F.when(F.col("Id").isNotNull(), dims.region_bucket(F.col("Region"))),
                       "today_base": F.coalesce(today_base, F.lit(False))})

    def ok(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    in_snap = F.col("s_Id").isNotNull()
    today = ok(F.col("today_base") & ((F.col("CloseDate") < qe) | in_snap))
    typ = F.col("Type").isin(list(TYPES))
    w = w.withColumns({"in_snap": in_snap, "today": today})
    w = w.withColumn("in_new", ok(F.col("today") & (F.col("SAO_Date") >= qs) & (F.col("SAO_Date") < qe) & typ
                                  & ~F.col("in_snap") & (F.col("CloseDate") >= qs) & (F.col("CloseDate") < qe)))
    w = w.withColumn("pulled_any", ok(F.col("today") & F.col("m_Id").isNotNull() & ~F.col("in_snap") & typ
                                      & (F.col("SAO_Date") < qe) & (F.col("CloseDate") <= qe)
                                      & (F.col("CloseDate") >= qs) & ~F.col("in_new")))
    w = w.withColumn("in_pulled", F.col("pulled_any") & F.col("f_Id").isNotNull())
    w = w.withColumn("in_total", ok(F.col("today") & typ & (F.coalesce("s_rn", F.lit(1)) == 1)
                                    & ((F.col("StageName") == dims.STAGE_CLOSED_WON) | F.col("SAO_Date").isNotNull())
                                    & ~F.col("StageName").isin(dims.HOUSEKEEPING_STAGES)
                                    & (F.col("Cohort_Close_Date") >= qs) & (F.col("Cohort_Close_Date") < qe)))
    w = w.withColumn("in_found", F.col("in_total") & ~F.col("pulled_any") & ~F.col("in_new") & ~F.col("in_snap"))
    # today's values exist for a snapshot deal only when it passes today's filters
    cur = lambda c: F.when(F.col("today"), F.col(c))
    return w.select(
        F.coalesce("s_Id", "Id").alias("Id"),
        "in_snap", "in_new", "in_pulled", "in_total", "in_found", "pulled_any",
        F.col("s_Type").alias("snap_Type"),
        F.col("bucket").alias("snap_bucket_raw"),
        F.col("Type").alias("cur_Type"),
        cur("StageName").alias("Current_StageName"),
        cur("Current_QB_USD").alias("Current_QB_USD"),
        cur("CloseDate").alias("Current_Closedate"),
        cur("bucket").alias("cur_bucket"),
        (F.col("ACV_Bookings") / F.col("s_rate")).alias("snap_QB_USD"),
        "s_Name", "s_SAO_Date", "s_AccountId", "previous_StageName", "previous_CloseDate",
        cur("Name").alias("cur_Name"), cur("SAO_Date").alias("cur_SAO_Date"),
        cur("Cohort_Close_Date").alias("cur_Cohort_Close_Date"),
        cur("sales_territory").alias("region_bucket_opp_owner"))


def coverage_by_region(spark: SparkSession, sf_dir: str, p: ReportParams, wide: DataFrame | None = None, **inputs) -> DataFrame:
    """Pipe, new, pulled in, pushed, won and lost per (Type, region bucket).

    ``wide``: rows of ``coverage_wide``; ``inputs``: landed ``opportunity`` / ``snapshots`` / ``changes``."""
    w = wide if wide is not None else coverage_wide(spark, sf_dir, p, **inputs)
    qe = F.lit(p.q_end)
    won = F.col("Current_StageName") == dims.STAGE_CLOSED_WON
    lost = F.col("Current_StageName") == dims.STAGE_CLOSED_LOST
    # the snapshot row's region: today's region of the deal (missing -> rest of world)
    snap_bucket = F.coalesce(F.col("snap_bucket_raw"), F.lit(dims.BUCKET_REST))
    rows = F.array(
        F.when(F.col("in_snap"), F.struct(F.lit("start").alias("src"), F.col("snap_Type").alias("Type"),
                                          snap_bucket.alias("region"))),
        F.when(F.col("in_pulled"), F.struct(F.lit("pulled").alias("src"), F.col("cur_Type").alias("Type"),
                                            F.col("cur_bucket").alias("region"))),
        F.when(F.col("in_new"), F.struct(F.lit("new").alias("src"), F.col("cur_Type").alias("Type"),
                                         F.col("cur_bucket").alias("region"))),
        F.when(F.col("in_found"), F.struct(F.lit("found").alias("src"), F.col("cur_Type").alias("Type"),
                                           F.col("cur_bucket").alias("region"))),
        F.when(F.col("in_total") & won, F.struct(F.lit("total_won").alias("src"), F.col("cur_Type").alias("Type"),
                                                 F.col("cur_bucket").alias("region"))))
    s = (w.withColumn("_r", F.explode(F.filter(rows, lambda x: x.isNotNull())))
          .select(F.col("_r.src").alias("src"), F.col("_r.Type").alias("Type"),
                  F.col("_r.region").alias("Merged_Account_Region_bucket"),
                  money(F.col("Current_QB_USD")).alias("amt"), "Current_Closedate",
                  won.alias("won"), lost.alias("lost")))

    src = F.col("src")
    amt = F.col("amt")

    def measure(present: Column, value_pred: Column) -> Column:
        """Sum over rows matching value_pred; NULL when no row matches ``present``."""
        return F.when(F.count(F.when(present, F.lit(1))) > 0,
                      F.coalesce(F.sum(F.when(value_pred, amt)), F.lit(0)))

    start = src == "start"
    close_in = F.coalesce(F.col("Current_Closedate") < qe, F.lit(False))
    won_ok, lost_ok = F.coalesce(F.col("won"), F.lit(False)), F.coalesce(F.col("lost"), F.lit(False))
    agg = s.groupBy("Type", "Merged_Account_Region_bucket").agg(
        measure(start, start).alias("pipe"),
        measure(start, start & won_ok & close_in).alias("pw"),
        measure(start, start & F.coalesce(F.col("Current_Closedate") >= qe, F.lit(False))).alias("pushed"),
        measure(start, start & lost_ok & close_in).alias("lost"),
        measure(src == "pulled", src == "pulled").alias("pulled"),
        measure((src == "pulled") & won_ok, (src == "pulled") & won_ok).alias("won_pulled"),
        measure(src == "new", src == "new").alias("new"),
        measure((src == "new") & won_ok, (src == "new") & won_ok).alias("won_new"),
        measure(src == "found", src == "found").alias("found"),
        measure((src == "found") & won_ok, (src == "found") & won_ok).alias("won_found"),
        measure(src == "total_won", src == "total_won").alias("total_won"))
    z = F.lit(0)
    return agg.select(
        "Type", "Merged_Account_Region_bucket",
        usd(F.coalesce("pipe", z) + F.coalesce("found", z)).alias("pipe"),
        usd(F.col("new")).alias("New_Pipe"),
        usd(F.col("pulled")).alias("Pulled_In"),
        usd(F.col("pushed")).alias("pushed"),
        usd(F.col("total_won")).alias("Total_Won"),
        usd(F.coalesce("pw", z) + F.coalesce("won_found", z)).alias("Pipeline_Won"),
        usd(F.col("won_pulled")).alias("Won_From_Pulled_In"),
        usd(F.col("won_new")).alias("Won_From_New_Pipe"),
        usd(F.col("lost")).alias("lost"))


def coverage_tables(coverage: DataFrame) -> dict[str, DataFrame]:
    """The report's two tabs: new business and existing business, region descending."""
    out = {}
    for name, t in [("new_business", dims.TYPE_NEW), ("existing_business", dims.TYPE_EXISTING)]:
        out[name] = (coverage.where(F.col("Type") == t).drop("Type")
                             .orderBy(F.desc_nulls_last("Merged_Account_Region_bucket")))
    return out


# ------------------------------------------------------------ report tabs
def _link(id_col: str, name_col: str):
    from pipewright.functions.text import link_formula, record_link
    from pipewright.plans.scorecard import BASE_URL
    return link_formula(record_link(F.col(id_col), "Opportunity", BASE_URL), F.col(name_col))


def v2_tabs(spark: SparkSession, sf_dir: str, p: ReportParams, wide: DataFrame | None = None) -> dict[str, DataFrame]:
    """The v2 report's deal tabs, all read from one wide table.

    starting_pipeline  anchor-snapshot deals with today's values, then the
                       found deals (previous stage 'Found'); a found row keeps
                       only the columns the starting tab has (its current-stage
                       column differs in case, so it is left empty)
    pulled_in          pulled-in deals that were forecast in the quarter
    new_pipe           new pipe created in the quarter
    total_won          won deals of the quarter's totals
    """
    w = wide if wide is not None else coverage_wide(spark, sf_dir, p)
    snap_bucket = F.coalesce(F.col("snap_bucket_raw"), F.lit(dims.BUCKET_REST))
    null_s, null_d, null_f = F.lit(None).cast("string"), F.lit(None).cast("date"), F.lit(None).cast("double")
    # one pass: a deal gives its anchor-snapshot row and/or its found row (a found row keeps only
    # the columns the starting tab has; its current-stage column differs in case, so it stays empty)
    start_row = F.struct(
        _link("Id", "s_Name").alias("Name"), F.col("snap_Type").alias("Type"), F.col("s_SAO_Date").alias("SAO_Date"),
        F.col("s_AccountId").alias("AccountId"), F.col("previous_StageName").alias("previous_StageName"),
        F.col("previous_CloseDate").alias("previous_CloseDate"), F.col("snap_QB_USD").alias("QB_USD"),
        snap_bucket.alias("Region_Bucket_Account"), F.col("Current_StageName").alias("current_StageName"),
        F.col("Current_QB_USD").alias("Current_QB_USD"), F.col("Current_Closedate").alias("Current_Closedate"),
        F.col("region_bucket_opp_owner").alias("region_bucket_opp_owner"),
        snap_bucket.alias("Merged_Account_Region_bucket"))
    found_row = F.struct(
        _link("Id", "cur_Name").alias("Name"), F.col("cur_Type").alias("Type"), F.col("cur_SAO_Date").alias("SAO_Date"),
        F.lit(None).cast("long").alias("AccountId"), F.lit("Found").alias("previous_StageName"),
        null_d.alias("previous_CloseDate"), null_f.alias("QB_USD"), null_s.alias("Region_Bucket_Account"),
        null_s.alias("current_StageName"), F.col("Current_QB_USD").alias("Current_QB_USD"),
        F.col("Current_Closedate").alias("Current_Closedate"), null_s.alias("region_bucket_opp_owner"),
        F.col("cur_bucket").alias("Merged_Account_Region_bucket"))
    rows = F.filter(F.array(F.when(F.col("in_snap"), start_row), F.when(F.col("in_found"), found_row)),
                    lambda x: x.isNotNull())
    starting = (w.where(F.col("in_snap") | F.col("in_found"))
                 .select(F.col("Id").alias("id"), F.explode(rows).alias("r")).select("id", "r.*"))

    def today_cols(df: DataFrame) -> DataFrame:
        return df.select(
            "Id", _link("Id", "cur_Name").alias("Name"), F.col("cur_Type").alias("Type"), "Current_StageName",
            "Current_QB_USD", "Current_Closedate", "region_bucket_opp_owner", F.col("cur_SAO_Date").alias("SAO_Date"),
            F.col("cur_Cohort_Close_Date").alias("Cohort_Close_Date"),
            F.col("cur_bucket").alias("Merged_Account_Region_bucket"))

    new = w.where(F.col("in_new")).select(
        "Id", _link("Id", "cur_Name").alias("Name"), "Current_Closedate", F.col("cur_SAO_Date").alias("SAO_Date"),
        F.col("cur_bucket").alias("Merged_Account_Region_bucket"), F.col("cur_Type").alias("Type"),
        "Current_QB_USD", F.col("Current_StageName").alias("current_StageName"))
    total_won = w.where(F.col("in_total") & (F.col("Current_StageName") == dims.STAGE_CLOSED_WON)).select(
        "Id", _link("Id", "cur_Name").alias("Name"), "Current_Closedate", F.col("cur_SAO_Date").alias("SAO_Date"),
        F.col("cur_Type").alias("Type"), F.col("cur_bucket").alias("Merged_Account_Region_bucket"),
        "Current_QB_USD", "Current_StageName")
    return {"starting_pipeline": starting, "pulled_in": today_cols(w.where(F.col("in_pulled"))),
            "new_pipe": new, "total_won": total_won}


def pulled_not_forecast(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Deals pulled into the quarter but never forecast in it: v2 leaves them out of
    Pulled In while still counting them as known, so their wins show only in Total Won."""
    w = coverage_wide(spark, sf_dir, p)
    return w.where(F.col("pulled_any") & ~F.col("in_pulled")).select(
        "Id", F.col("cur_Type").alias("Type"), F.col("cur_bucket").alias("Merged_Account_Region_bucket"),
        "Current_StageName", "Current_QB_USD", "Current_Closedate")
