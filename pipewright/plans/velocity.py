"""Deal velocity: days spent in each sales stage.

``stage_spans`` has one row per deal and one column per stage; ``time_in_stage`` turns the stage dates of closed-won deals into one row per
(deal, stage) with an unpivot (one scan, not one scan per stage).
``team_velocity`` and ``rep_velocity`` give mean and median days per manager /
rep and stage, with every stage present for each observed manager / rep
(empty ones NULL), from one aggregation; ``velocity_compare`` puts them side by side as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.functions.periods import ReportParams
from pipewright.operators import joins
from pipewright.operators.complete import level_stats
from pipewright.operators.reshape import prefix_columns
from pipewright.sources import crm

# stage label -> (end date, start date) of the span counted for it
STAGE_SPANS = [
    ("Discovery", "SAO_Date", "Discovery_Set_Date"),
    ("Solution Overview", "Eval_Planning_Date", "SAO_Date"),
    ("Eval Planning", "Tech_Eval_Date", "Eval_Planning_Date"),
    ("Tech Eval", "Negotiation_Date", "Tech_Eval_Date"),
    ("Negotiation", "CloseDate", "Negotiation_Date"),
]


def _nonneg_rounded(x: Column) -> Column:
    """Round half to even; negative -> 0; NaN/NULL -> NULL (adding 0.0 turns -0.0 into 0.0)."""
    r = F.bround(x, 0)
    return F.when(r.isNull() | F.isnan(r), F.lit(None).cast("double")) \
            .otherwise(F.when(r < 0, F.lit(0.0)).otherwise(r) + F.lit(0.0))


def _share(mean: Column, median: Column) -> Column:
    txt = lambda c: F.coalesce(c.cast("long").cast("string"), F.lit("NA"))
    return F.concat(txt(mean), F.lit(", "), txt(median))


def stage_spans(spark: SparkSession, sf_dir: str, p: ReportParams, with_product: bool = True) -> DataFrame:
    """Closed-won new/expansion deals with the days of each stage in a column of its name.

    The product comes from the order lines (the largest table); summaries
    that do not output it pass ``with_product=False``.
    """
    o = crm.opportunity(spark, sf_dir, with_product=with_product)
    if not with_product:
        o = o.withColumn("ARR_Product", F.lit(None).cast("string"))
    u = crm.user(spark, sf_dir).select(F.col("Id").alias("u_Id"), F.col("Name").alias("Opp_Owner"),
                                       F.col("Manager").alias("Opp_Owner_Manager"))
    ct = crm.currency(spark, sf_dir)
    o = o.where((F.col("Test_Account") == F.lit(False)) & (F.col("StageName") == dims.STAGE_CLOSED_WON)
                & F.col("Category").isin(dims.VELOCITY_CATEGORIES)
                & (F.col("CloseDate") >= F.lit(p.velocity_since)))
    df = (joins.lookup(o, u, "OwnerId", "u_Id", F.col("Id"))
           .join(F.broadcast(ct), o.CurrencyIsoCode == ct.IsoCode, "left"))
    return df.select(
        "Opp_Owner_Manager", F.col("Id").alias("Opp_Id"), F.col("Name").alias("Opp_Name"),
        F.col("ARR_Product").alias("Product"), (F.col("ACV_Bookings") / F.col("ConversionRate")).alias("QB_USD"),
        "Opp_Owner", "StageName", "Category", "Type",
        *[F.datediff(F.col(end), F.col(start)).alias(label) for label, end, start in STAGE_SPANS])


def time_in_stage(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Days per stage in long form (NULL days kept)."""
    wide, labels = stage_spans(spark, sf_dir, p), [label for label, _, _ in STAGE_SPANS]
    return wide.unpivot([c for c in wide.columns if c not in labels], labels, "Stage", "Days")


def _velocity(df: DataFrame, keys: list[str], days: dict[str, Column]) -> DataFrame:
    """Rounded mean and median of each stage's days per key, every stage present, and their text."""
    stats = level_stats(df, keys, days, "Stage", "stage_rank")
    mean, median = _nonneg_rounded(F.col("mean")), _nonneg_rounded(F.col("median"))
    return stats.select(*keys, "Stage", "stage_rank", mean.alias("mean_days"), median.alias("median_days"),
                        _share(mean, median).alias("mean_median"))


def team_velocity(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Mean and median days per manager and stage over closed-won deals."""
    wide = stage_spans(spark, sf_dir, p, with_product=False)
    days = {s: F.col(f"`{s}`") for s in dims.VELOCITY_STAGE_ORDER}
    # a manager is observed by a deal with days in any stage
    wide = wide.where(F.coalesce(*days.values()).isNotNull())
    return _velocity(wide, ["Opp_Owner_Manager"], days)


def rep_velocity(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Mean and median days stale of open deals per manager, rep and stage."""
    o = crm.opportunity(spark, sf_dir)
    u = crm.user(spark, sf_dir).select(F.col("Id").alias("u_Id"), F.col("Name").alias("Opp_Owner"),
                                       F.col("Manager").alias("Opp_Owner_Manager"))
    o = o.where(F.col("StageName").isin(dims.VELOCITY_STAGE_ORDER) & (F.col("Test_Account") == F.lit(False))
                & F.col("Category").isin(dims.VELOCITY_CATEGORIES))
    df = joins.lookup(o, u, "OwnerId", "u_Id", F.col("Id")).select(
        "Opp_Owner_Manager", "Opp_Owner", F.col("StageName").alias("Stage"), "Days_Stale")
    reps = crm.rep_group(spark, sf_dir).select(F.col("Name").alias("rep"))
    df = df.join(F.broadcast(reps), df.Opp_Owner == reps.rep, "left_semi")
    days = {s: F.when(F.col("Stage") == s, F.col("Days_Stale")) for s in dims.VELOCITY_STAGE_ORDER}
    return _velocity(df, ["Opp_Owner_Manager", "Opp_Owner"], days)


def velocity_compare(spark: SparkSession, sf_dir: str, p: ReportParams) -> DataFrame:
    """Each rep's stage velocity beside the team's; text with a missing part -> '.'."""
    rep = rep_velocity(spark, sf_dir, p)
    team = prefix_columns(team_velocity(spark, sf_dir, p).select("Opp_Owner_Manager", "Stage", "mean_median"), "Team_")
    df = rep.join(team, rep.Opp_Owner_Manager.eqNullSafe(team.Team_Opp_Owner_Manager)
                  & (rep.Stage == team.Team_Stage), "inner")
    dot = lambda c: F.when(F.col(c).contains("NA"), F.lit(".")).otherwise(F.col(c))
    return (df.select("Opp_Owner_Manager", "Opp_Owner", "Stage", "stage_rank",
                      dot("mean_median").alias("mean_median"), dot("Team_mean_median").alias("Team_mean_median"))
              .orderBy(F.asc_nulls_last("Opp_Owner"), "stage_rank"))
