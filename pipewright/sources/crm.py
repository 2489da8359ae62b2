"""CRM-shaped tables derived from the TPC-H-style test tables.

The reports read CRM objects (opportunity, account, user, role, currency, a
daily snapshot table and a field-change log). The test data holds orders,
customers, suppliers, parts and events instead, so these builders derive the
CRM objects from them with fixed arithmetic rules (k = order key):

  opportunity   one row per order; stage from order status, type/category/
                renewal type/nulls from k modulo small primes, dates from the
                order date, money in the customer's local currency
  currency      one code and rate per region
  account       customer;  user: supplier (owners are users 0-9);  user_role: four roles
  history       one row per opportunity and snapshot date (created by then); close
                date shifted for k % 6 in (0, 1) until the change log moves it; another
                category for k % 7 = 3 and 3% less money for k % 5 = 2
  field_history close-date changes for k % 6 in (0, 1), a second one for k % 12 = 0
  activity      events as rep activity metrics

The same rules are written independently as DuckDB SQL in
``pipewright.oracle.fixtures``; both engines must build identical rows.

Every builder takes the source of the tables: a folder with the test tables, or
a mapping of CRM tables (name -> DataFrame, as ``landing.attach`` gives it).
With a mapping the job reads those tables alone and nothing is derived.

Every builder reads only the columns it needs. Joins to nation/region use a
broadcast because those tables have a fixed size (25 and 5 rows); joins to
customer, part and lineitem are left to the planner (AQE picks broadcast at
runtime only when the measured side is small).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.sources.tables import read

CURRENCY_META = {"type": "currency"}

# ====================== FIXED VALUES (test-data rules) ======================
# region key -> (currency code, units per USD, CRM region name)
REGION_RULES = [(0, "USD", 1.0, "Rest of EMEA"), (1, "EUR", 0.9, "North America"),
                (2, "GBP", 0.8, "APJ"), (3, "JPY", 150.0, "DACH"), (4, "INR", 83.0, "Other")]
# stage of an order by status
STAGES_P = ["Proposal", "Negotiation", "Tech Eval", "Eval Planning"]            # by k % 4
STAGES_O = ["Discovery", "Solution Overview", "Engaged", "Offer", "Temporary"]  # by k % 5
# type by k % 10: 0-3, 4-7, 8, 9
TYPES = ["New Business"] * 4 + ["Existing Business"] * 4 + ["Expansion", "Professional Services"]
# category by (k div 10) % 8; the last one is missing
CATEGORIES = ["New", "Expansion", "SAP - Expansion", "Renewal", "Flips - Maintenance",
              "Flips - Term License", "Professional Services", None]
# renewal type by k % 5
RENEWAL_TYPES = ["Annual Installment Billing", "Standard", None, "Prorated Installments", "Standard"]
EXPANSION_CATEGORIES = ["Upsell", "Cross-sell", None]                           # by k % 3
NEXT_STEPS = ["Call", "Send quote", None, "Legal review"]                       # by k % 4
# by key; the role an owner had at assignment is the one at (k div 4) % 5, the last one is missing
ROLES = [(0, "Customer Success"), (1, "Strategic Accounts"), (2, "Account Executive"), (3, "Enterprise")]
N_USERS = 10
USER_WITHOUT_MANAGER = 7
# rep groups and owners excluded from scorecards (synthetic names)
REP_GROUPS = [("Rep-0", "CAM"), ("Rep-5", "CAM"), ("Rep-10", "CAM"),
              ("Rep-1", "SAM"), ("Rep-6", "SAM"),
              ("Rep-2", "EMEA"), ("Rep-7", "EMEA"), ("Rep-12", "EMEA"),
              ("Rep-3", "Enterprise NA"), ("Rep-8", "Enterprise NA"),
              ("Rep-4", "Commercial NA"), ("Rep-9", "Commercial NA"), ("Rep-13", "Commercial NA")]
EXCLUDED_OWNERS = ["Rep-6"]
# ==================== END FIXED VALUES (test-data rules) ====================


Source = str | Mapping[str, DataFrame]


def entity(name: str) -> Callable:
    """A builder whose table a mapping gives under ``name``."""
    def wrap(build: Callable) -> Callable:
        @wraps(build)
        def get(spark: SparkSession, source: Source, *args, **kw) -> DataFrame:
            return source[name] if isinstance(source, Mapping) else build(spark, source, *args, **kw)
        return get
    return wrap


def _pick(idx: Column, values: Sequence) -> Column:
    """values[idx] as one flat CASE expression (NULL for a None entry or any other idx)."""
    expr = None
    for i, v in enumerate(values):
        if v is None:
            continue
        expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
    return expr.otherwise(F.lit(None))


def _div(c: Column, n: int) -> Column:
    return F.floor(c / n).cast("long")


def _opp_id(k: Column) -> Column:
    return F.concat(F.lit("006"), F.lpad(k.cast("string"), 12, "0"))


def _null_if(k: Column, m: int, value: Column) -> Column:
    return F.when(k % m == 0, F.lit(None)).otherwise(value)


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "region", ["r_regionkey"])
    key = F.col("r_regionkey")
    code = _pick(key, [c for _, c, _, _ in REGION_RULES])
    rate = _pick(key, [v for _, _, v, _ in REGION_RULES])
    return r.select("r_regionkey", code.alias("IsoCode"), rate.alias("ConversionRate"))


@entity("currency")
def currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CurrencyType(IsoCode, ConversionRate): one row per code."""
    return region_map(spark, sf_dir).select("IsoCode", "ConversionRate").where(F.col("IsoCode").isNotNull())


def _nation_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency code and region name per nation: the rules hold for region keys, so the region table is not read."""
    key = F.col("n_regionkey")
    return read(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"]).select(
        "n_nationkey", _pick(key, [c for _, c, _, _ in REGION_RULES]).alias("IsoCode"),
        _pick(key, [n for _, _, _, n in REGION_RULES]).alias("RegionName"))


def _product_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, types): the distinct part types of all lines of each order, sorted.

    The set is bounded by the list of part types, not by the order's lines.
    """
    li = read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    p = read(spark, sf_dir, "part", ["p_partkey", "p_type"])
    lp = li.join(p, li.l_partkey == p.p_partkey, "left")
    return lp.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_type")).alias("types"))


def with_products(spark: SparkSession, sf_dir: str, deals: DataFrame) -> DataFrame:
    """``deals`` (one row per ``Id``, with ``_k``) and their Product: the distinct part types of their lines, sorted.

    For deals that a job has already cut down: only their lines meet the parts
    and are grouped.
    """
    li = read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    p = read(spark, sf_dir, "part", ["p_partkey", "p_type"])
    lines = (deals.join(li, F.col("_k") == F.col("l_orderkey"), "left")
                  .join(p, F.col("l_partkey") == F.col("p_partkey"), "left"))
    others = [c for c in deals.columns if c not in ("Id", "_k")]
    per = lines.groupBy("Id").agg(F.array_sort(F.collect_set("p_type")).alias("__types"),
                                  *[F.any_value(c).alias(c) for c in others])
    return per.withColumn("Product", F.when(F.size("__types") > 0, F.array_join("__types", ";"))).drop("__types")


@entity("opportunity")
def opportunity_core(spark: SparkSession, sf_dir: str, with_product: bool = False) -> DataFrame:
    """Opportunity rows plus the internal order key ``_k`` used by other builders."""
    o = read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                       "o_orderdate", "o_orderpriority"])
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    df = (o.join(c, o.o_custkey == c.c_custkey, "left")
           .join(F.broadcast(_nation_geo(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    if with_product:
        df = df.join(_product_by_order(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")

    k = F.col("o_orderkey")
    close = F.col("o_orderdate").cast("date")
    df = df.withColumns({"_k": k, "CloseDate": close})
    df = df.withColumn("CreatedDate", F.date_sub(F.col("CloseDate"), (30 + (7 * k) % 300).cast("int")))
    df = df.withColumn("SAO_Date", _null_if(k, 11, F.date_add(F.col("CreatedDate"), ((13 * k) % 90).cast("int"))))
    stage = (F.when(F.col("o_orderstatus") == "F",
                    F.when(_div(k, 6) % 3 == 0, F.lit("Closed Lost")).otherwise(F.lit("Closed Won")))
              .when(F.col("o_orderstatus") == "P", _pick(k % 4, STAGES_P))
              .when(F.col("o_orderstatus") == "O", _pick(k % 5, STAGES_O)))
    acv = _null_if(k, 13, F.col("o_totalprice"))
    sao = F.col("SAO_Date")
    cols = [
        _opp_id(k).alias("Id"),
        F.col("o_custkey").alias("AccountId"),
        (_div(k, 3) % N_USERS).alias("OwnerId"),
        F.concat(F.lit("Deal-"), k.cast("string")).alias("Name"),
        stage.alias("StageName"),
        _pick(k % 10, TYPES).alias("Type"),
        (k % 50 == 0).alias("Test_Account"),
        _pick(_div(k, 10) % 8, CATEGORIES).alias("Category"),
        _null_if(k, 53, F.col("RegionName")).alias("Region"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("o_orderpriority").alias("LeadSource"),
        F.col("IsoCode").alias("CurrencyIsoCode"),
        F.col("CloseDate"),
        F.col("CreatedDate"),
        sao,
        F.when(k % 8 == 5, F.date_add("CloseDate", 40)).otherwise(F.col("CloseDate")).alias("Cohort_Close_Date"),
        F.concat(F.year("CloseDate").cast("string"), F.lit("-Q"), F.quarter("CloseDate").cast("string")).alias("Fiscal"),
        acv.alias("ACV_Bookings", metadata=CURRENCY_META),
        F.col("o_totalprice").alias("Amount", metadata=CURRENCY_META),
        (F.col("o_totalprice") * F.lit(0.5)).alias("ExpectedRevenue", metadata=CURRENCY_META),
        F.when(k % 10 != 8, acv).alias("Software_QB", metadata=CURRENCY_META),
        F.when(k % 10 == 8, acv).alias("RW_Expansion_Amount", metadata=CURRENCY_META),
        _null_if(k, 7, acv * F.lit(0.9)).alias("Managers_Forecast", metadata=CURRENCY_META),
        _null_if(k, 17, acv * F.lit(0.95)).alias("Recurring_Booking_PY", metadata=CURRENCY_META),
        _null_if(k, 19, acv * F.lit(1.02)).alias("Billing_Period_1", metadata=CURRENCY_META),
        _null_if(k, 23, ((3 * k) % 200).cast("int")).alias("Days_Stale"),
        _pick(k % 5, RENEWAL_TYPES).alias("Renewal_Type"),
        (k % 80).cast("int").alias("MEDDPICC_Score"),
        _pick(k % 3, EXPANSION_CATEGORIES).alias("Expansion_Category"),
        _pick(k % 4, NEXT_STEPS).alias("NextStep"),
        _pick(_div(k, 4) % 5, [name for _, name in ROLES]).alias("Owner_Role_at_Assignment"),
        _null_if(k, 9, F.date_add("CloseDate", ((11 * k) % 400).cast("int"))).alias("Existing_Contract_End_Date"),
        _null_if(k, 29, F.date_sub(sao, 10)).alias("Discovery_Set_Date"),
        _null_if(k, 31, F.date_add(sao, (k % 20).cast("int"))).alias("Eval_Planning_Date"),
        _null_if(k, 37, F.date_add(sao, (20 + k % 15).cast("int"))).alias("Tech_Eval_Date"),
        _null_if(k, 41, F.date_add(sao, (30 + k % 25).cast("int"))).alias("Negotiation_Date"),
        F.col("_k"),
    ]
    if with_product:
        some = F.size("types") > 0
        cols += [F.when(some, F.array_join("types", ";")).alias("Product"),
                 F.when(some, F.get("types", F.lit(0))).alias("ARR_Product")]
    return df.select(*cols)


def opportunity(spark: SparkSession, sf_dir: str, with_product: bool = False) -> DataFrame:
    """The current opportunity object (one row per deal)."""
    return opportunity_core(spark, sf_dir, with_product).drop("_k")


@entity("account")
def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer", ["c_custkey", "c_name"]).select(
        F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name"))


@entity("users")
def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user per supplier; deals are owned by users 0..N_USERS-1 ((k div 3) % N_USERS).

    The table grows with the data, so joins to it carry no broadcast hint (AQE
    broadcasts it at runtime only when it is measured small).
    """
    s = read(spark, sf_dir, "supplier", ["s_suppkey"])
    i = F.col("s_suppkey")
    return s.select(
        i.alias("Id"),
        F.concat(F.lit("Rep-"), i.cast("string")).alias("Name"),
        F.when(i == USER_WITHOUT_MANAGER, F.lit(None))
         .otherwise(F.concat(F.lit("Manager-"), (i % 3).cast("string"))).alias("Manager"),
        (i % 4).alias("UserRoleId"),
        F.when(i % 2 == 0, F.lit("NA")).otherwise(F.lit("EU + ROW")).alias("sales_territory"))


@entity("user_role")
def user_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(ROLES, "Id long, Name string")


@entity("rep_group")
def rep_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(REP_GROUPS, "Name string, Group string")


@entity("excluded_owner")
def excluded_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in EXCLUDED_OWNERS], "Name string")


def fixture_snapshot_days(anchor: dt.date, end: dt.date) -> list[dt.date]:
    """The days on which the derived snapshot table has rows: the anchor and every 7th day after it, before ``end``.

    A rule of the test data only: the jobs read every day that the snapshot
    table holds in their window, whichever days those are.
    """
    out, d = [], anchor
    while d < end:
        out.append(d)
        d += dt.timedelta(days=7)
    return out


def history(spark: SparkSession, sf_dir: Source, dates: Sequence[dt.date]) -> DataFrame:
    """Snapshot table: one row per (opportunity created by then, snapshot date), for ``dates``."""
    if isinstance(sf_dir, Mapping):
        return sf_dir["history"].where(F.col("snapshot_date").isin(list(dates)))
    return _history(spark, sf_dir, dates)


def snapshot_window(spark: SparkSession, sf_dir: Source, start: dt.date, end: dt.date) -> DataFrame:
    """Every day that the snapshot table holds with ``start <= snapshot_date < end``."""
    if isinstance(sf_dir, Mapping):
        day = F.col("snapshot_date")
        return sf_dir["history"].where((day >= F.lit(start)) & (day < F.lit(end)))
    return _history(spark, sf_dir, fixture_snapshot_days(start, end))


def _history(spark: SparkSession, sf_dir: str, dates: Sequence[dt.date]) -> DataFrame:
    """The derived snapshot table.

    Columns follow the dated snapshot of the CRM: frozen stage, close date and
    money, plus ``snapshot_date`` (the partition column of a landed table).
    """
    core = opportunity_core(spark, sf_dir)
    cur = currency(spark, sf_dir)
    snaps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(dates)]))
    df = (core.join(F.broadcast(cur), core.CurrencyIsoCode == cur.IsoCode, "left")
              .withColumn("_s", snaps)
              .where(F.col("CreatedDate") <= F.col("_s.d")))
    k = F.col("_k")
    rate = F.col("ConversionRate")
    close = F.col("CloseDate")
    # the snapshot differs from today for some deals: another category (k % 7 = 3)
    # and 3% less money (k % 5 = 2)
    acv = F.when(k % 5 == 2, F.col("ACV_Bookings") * F.lit(0.97)).otherwise(F.col("ACV_Bookings"))
    category = F.when(k % 7 == 3, _pick((_div(k, 10) + 1) % 8, CATEGORIES)).otherwise(F.col("Category"))
    return df.select(
        "Id",
        F.col("_s.d").alias("snapshot_date"),
        (F.col("_s.d").cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("Snapshot_Time"),
        F.when(k % 29 == 0, F.lit("Closed Lost")).otherwise(F.lit("Proposal")).alias("StageName"),
        "Type",
        # frozen close date: shifted for k % 6 in (0, 1); snapshots after the anchor
        # that are taken on or after the first close-date change show the new date
        F.when(((k % 6 == 0) | (k % 6 == 1)) & (F.col("_s.i") >= 1)
               & (F.col("_s.d") >= F.date_sub(close, (k % 120).cast("int"))), close)
         .when(k % 6 == 0, F.date_add(close, 95)).when(k % 6 == 1, F.date_sub(close, 95))
         .otherwise(close).alias("CloseDate"),
        "SAO_Date", category.alias("Category"),
        F.when(k % 10 != 8, acv / rate).alias("Software_USD"),
        F.when(k % 10 == 8, acv / rate).alias("Expansion_USD"),
        (acv / rate).alias("qb_usd"),
        "Name", "AccountId", "OwnerId", "Renewal_Type", acv.alias("ACV_Bookings"),
        F.when((k + F.col("_s.i")) % 7 == 0, F.lit(None))
         .otherwise(acv * F.lit(0.9)).alias("Managers_Forecast"),
        "Test_Account", "CurrencyIsoCode")


@entity("field_history")
def field_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close-date change log (OpportunityId, field, OldValue, NewValue, CreatedDate).

    One pass over the orders; each qualifying deal yields one or two rows.
    """
    o = read(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    core = o.select(_opp_id(F.col("o_orderkey")).alias("Id"), F.col("o_orderdate").cast("date").alias("CloseDate"),
                    F.col("o_orderkey").alias("_k"))
    k, close = F.col("_k"), F.col("CloseDate")
    first = F.struct(
        F.when(k % 6 == 0, F.date_add(close, 95)).otherwise(F.date_sub(close, 95)).alias("old"),
        F.date_sub(close, (k % 120).cast("int")).alias("created"))
    second = F.when(k % 12 == 0, F.struct(
        F.date_add(close, 95).alias("old"),
        F.date_add(close, (5 - k % 30).cast("int")).alias("created")))
    ev = F.explode(F.filter(F.array(first, second), lambda x: x.isNotNull()))
    return (core.where((k % 6 == 0) | (k % 6 == 1))
                .select("Id", "CloseDate", ev.alias("e"))
                .select(F.col("Id").alias("OpportunityId"),
                        F.lit("CloseDate").alias("field"),
                        F.col("e.old").cast("string").alias("OldValue"),
                        F.col("CloseDate").cast("string").alias("NewValue"),
                        (F.col("e.created").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("CreatedDate")))


@entity("activity")
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", ["user_id", "event_type", "value", "ts"])
    return e.select(F.concat(F.lit("Rep-"), F.col("user_id").cast("string")).alias("Name"),
                    F.col("event_type").alias("Metric"),
                    F.col("value").alias("Amount"),
                    F.col("ts").cast("date").alias("ActivityDate"))


def register_crm_views(spark: SparkSession, sf_dir: str, snapshot_dates: Sequence[dt.date] = ()) -> list[str]:
    """Register the CRM objects as temp views so reports can also be written in
    SQL (``spark.sql``), the way the original scripts embedded their queries.

    Views: opportunity, account, users, user_role, currency, field_history,
    activity, rep_group, excluded_owner and, when dates are given, history.
    """
    views = {"opportunity": opportunity(spark, sf_dir, with_product=True), "account": account(spark, sf_dir),
             "users": user(spark, sf_dir), "user_role": user_role(spark, sf_dir), "currency": currency(spark, sf_dir),
             "field_history": field_history(spark, sf_dir), "activity": activity(spark, sf_dir),
             "rep_group": rep_group(spark, sf_dir), "excluded_owner": excluded_owner(spark, sf_dir)}
    if snapshot_dates:
        views["history"] = history(spark, sf_dir, snapshot_dates)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
