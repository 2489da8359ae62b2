"""Extract, classification, currency text and links."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.functions.money import currency_codes_pattern, money, scrub_currency, scrub_usd, usd
from pipewright.functions.nulls import cond_sum, in_set
from pipewright.functions.periods import ReportParams
from pipewright.functions.text import clean_names, link_formula, record_link
from pipewright.operators import families, joins
from pipewright.session import ensure_checkpoint_dir
from pipewright.sources import crm
from pipewright.sources.publish import publish, read_published
from pipewright.sources.tables import currency_fields

# ===================== FIXED VALUES (test-data rules) =====================
# product family of each part type (the test data's "products")
PRODUCT_FAMILIES = {"ECONOMY": "Core", "SMALL": "Core", "LARGE": "Platform", "MEDIUM": "Platform",
                    "PROMO": "Services", "STANDARD": "Services"}
# overlapping product lists (whole multi-select values; NULL is listed like any value)
ALL_PRODUCTS = ["ECONOMY", "SMALL", "LARGE", "MEDIUM", "PROMO", None, "ECONOMY;SMALL", "LARGE;MEDIUM", "ECONOMY;LARGE",
                "MEDIUM;PROMO", "ECONOMY;MEDIUM;SMALL", "LARGE;PROMO;SMALL", "MEDIUM;PROMO;SMALL", "ECONOMY;LARGE;MEDIUM;SMALL"]
SCHEDULING_PRODUCTS = ["ECONOMY", "SMALL", "ECONOMY;SMALL", "ECONOMY;LARGE", "ECONOMY;MEDIUM;SMALL"]
FINANCE_PRODUCTS = ["LARGE", "ECONOMY;LARGE", "LARGE;MEDIUM", "LARGE;PROMO;SMALL", "ECONOMY;LARGE;MEDIUM;SMALL"]
TRANSFER_PRODUCTS = ["MEDIUM", "MEDIUM;PROMO"]
OTHER_ACQUIRED_PRODUCTS = ["PROMO", "MEDIUM;PROMO;SMALL"]
# funnels of the lead sources; one source can feed several
OUTBOUND_SOURCES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
INBOUND_SOURCES = ["3-MEDIUM", "4-NOT SPECIFIED"]
# record hosts of the link builders (synthetic)
HOST_A = "https://crm-a.example.com"
HOST_B = "https://crm-b.example.com"
HOST_C = "https://crm-c.example.com"
# =================== END FIXED VALUES (test-data rules) ===================


def as_map(mapping: dict | DataFrame) -> Column:
    """A small key -> value mapping as a map column.

    A dict becomes a literal map; a two-column dimension table (key, value)
    becomes a map through a scalar subquery (``map_from_entries`` of its rows),
    which passes the whole dimension through the driver as one literal: only
    for dimensions of a known small size. Lookups stay narrow expressions (no
    join, no shuffle); a repeated key is an error.
    """
    if isinstance(mapping, DataFrame):
        k, v = mapping.columns[:2]
        return mapping.select(F.map_from_entries(F.collect_list(F.struct(F.col(k), F.col(v))))).scalar()
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def _lookup(mapping: dict | DataFrame | Column, key: Column) -> Column:
    """Value of ``key`` in a small mapping; NULL for a missing or NULL key."""
    m = mapping if isinstance(mapping, Column) else as_map(mapping)
    return F.when(key.isNull(), F.lit(None).cast("string")).otherwise(F.try_element_at(m, key))


# ------------------------------------------------------------------- W01
def with_converted_currency(df: DataFrame, currency: DataFrame, iso_col: str = "CurrencyIsoCode") -> DataFrame:
    """Add ``<field>_Converted`` (USD) for every field whose metadata marks it as
    currency, using the row's currency code. Works on any object table; the
    currency table (one row per code) is broadcast."""
    fields = currency_fields(df)
    if not fields:
        return df
    ct = currency.select(F.col("IsoCode").alias("__iso"), F.col("ConversionRate").alias("__rate"))
    joined = df.join(F.broadcast(ct), df[iso_col] == ct["__iso"], "left")
    conv = [(F.col(f"`{f}`") / F.col("__rate")).alias(f"{f}_Converted") for f in fields]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *conv)


def with_clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to a warehouse-safe name (see ``text.clean_name``)."""
    return df.toDF(*clean_names(df.columns))


def extract_object(obj: DataFrame, currency: DataFrame, clean: bool = True) -> DataFrame:
    """All fields of one CRM object, plus converted currency fields, names cleaned."""
    out = with_converted_currency(obj, currency)
    return with_clean_names(out) if clean else out


def ingest_converted(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """The opportunity object with related names, a ``<field>_Converted``
    USD column for every field whose metadata marks it as currency, and names
    cleaned for a warehouse table."""
    o = crm.opportunity(spark, sf_dir)
    a = crm.account(spark, sf_dir).select(F.col("Id").alias("__a_id"), F.col("Name").alias("Account.Name"))
    u = crm.user(spark, sf_dir).select(F.col("Id").alias("__u_id"), F.col("Name").alias("Owner Name"))
    obj = (joins.lookup(o.join(a, o.AccountId == a["__a_id"], "left"), u, "OwnerId", "__u_id", F.col("Id"))
            .select(*[F.col(f"`{c}`") for c in o.columns], F.col("`Account.Name`"), F.col("`Owner Name`")))
    return extract_object(obj, crm.currency(spark, sf_dir))


def extract_and_load(spark: SparkSession, sf_dir: str, path: str) -> int:
    """Extract with converted money and publish it as the table ``opportunity`` of ``path``; its rows."""
    return publish(spark, path, {"opportunity": ingest_converted(spark, sf_dir)})["opportunity"]


def ingest_loaded(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """The extract as it reads back after loading it in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark)}/extract"
    extract_and_load(spark, sf_dir, path)
    return read_published(spark, path, "opportunity")


# ------------------------------------------------------------------- W22
def classify(df: DataFrame, product_families: dict | DataFrame = PRODUCT_FAMILIES) -> DataFrame:
    """Group labels from the dimensions; all narrow (map lookups).

    ``product_families`` is a dict or a (product, family) dimension table.
    product_family: family of the whole multi-select value when listed,
    otherwise the distinct families of its ';'-separated parts, sorted and
    joined with ';' (NULL when none is listed).
    """
    # the map is attached as a column so the lambda below can read it (a subquery cannot sit inside one)
    df = df.withColumn("__families", as_map(product_families))
    fam = F.col("__families")
    whole = _lookup(fam, F.col("Product"))
    parts = F.array_sort(F.array_distinct(F.filter(
        F.transform(F.split(F.col("Product"), ";"), lambda x: _lookup(fam, x)),
        lambda x: x.isNotNull())))
    by_parts = F.when(F.size(parts) > 0, F.array_join(parts, ";"))
    type_group = {t: g for t, g, _ in dims.TYPE_GROUPS}
    flip_kind = {t: k for t, _, k in dims.TYPE_GROUPS if k}
    region_group = {r: ("North America" if r in dims.NORTH_AMERICA_REGIONS else "EMEA") for r in dims.ALL_REGIONS}
    return df.select(
        "Id", "Product", F.coalesce(whole, by_parts).alias("product_family"),
        "Type", _lookup(type_group, F.col("Type")).alias("type_group"),
        _lookup(flip_kind, F.col("Type")).alias("flip_kind"),
        "Region", _lookup(region_group, F.col("Region")).alias("region_group"),
        "StageName", in_set(F.col("StageName"), dims.CLOSED_STAGES).alias("is_closed"),
        in_set(F.col("StageName"), dims.JUNK_STAGES).alias("is_junk_stage"))


def opp_classified(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Every deal with its product family, type group and region group."""
    return classify(crm.opportunity(spark, sf_dir, with_product=True))


def product_lists() -> dict[str, list[str | None]]:
    """Families by name. Acquired products are two lists together, the heritage family is the rest of all products."""
    acquired = TRANSFER_PRODUCTS + OTHER_ACQUIRED_PRODUCTS
    return {"Scheduling": SCHEDULING_PRODUCTS, "Finance": FINANCE_PRODUCTS, "Transfer": TRANSFER_PRODUCTS,
            "Acquired": acquired, "Heritage": families.rest(ALL_PRODUCTS, acquired)}


def funnel_lists() -> dict[str, list[str]]:
    """Funnels by name, as lists of lead sources; the expansion funnel takes the deals of its types instead."""
    _, outbound, inbound = dims.FUNNELS
    return {outbound: OUTBOUND_SOURCES, inbound: INBOUND_SOURCES}


def with_families(deals: DataFrame) -> DataFrame:
    """``deals`` with ``families`` (of the whole product value), ``part_families`` (of its parts) and ``funnels``, sorted arrays."""
    lists = product_lists()
    expansion = in_set(F.col("Type"), [dims.TYPE_EXISTING, dims.TYPE_EXPANSION])
    return deals.withColumns({
        "families": families.labels(F.col("Product"), lists), "part_families": families.part_labels(F.col("Product"), lists),
        "funnels": F.when(expansion, F.array(F.lit(dims.FUNNELS[0]))).otherwise(families.labels(F.col("LeadSource"), funnel_lists()))})


def opp_families(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Every label of every deal: its product families (a value can be in several) and its funnels."""
    d = with_families(crm.opportunity(spark, sf_dir, with_product=True))
    text = {c: F.array_join(c, ";").alias(c) for c in ("families", "part_families", "funnels")}
    return d.select("Id", "Product", text["families"], F.size("families").cast("long").alias("n_families"), text["part_families"],
                    "Type", "LeadSource", text["funnels"], F.array_contains("families", "Acquired").alias("is_acquired"),
                    (F.size("funnels") > 0).alias("in_funnel"))


def family_totals(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Deals and bookings in USD per family and funnel; a deal counts under each of its labels, and under none as ''."""
    d = with_families(crm.opportunity(spark, sf_dir, with_product=True))
    ct = crm.currency(spark, sf_dir)
    d = d.join(F.broadcast(ct), d.CurrencyIsoCode == ct.IsoCode, "left")

    def each(c: str) -> Column:
        return F.explode(F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit(""))))
    d = d.withColumn("family", each("families")).withColumn("funnel", each("funnels"))
    return d.groupBy("family", "funnel").agg(F.count(F.lit(1)).alias("deals"),
                                             usd(cond_sum(F.lit(True), money(F.col("ACV_Bookings") / F.col("ConversionRate")))).alias("QB_USD"))


# ------------------------------------------------------------------- W26
def currency_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals with a formatted currency text field, as a report export gives it.

    Test-data rule (k = order key): '<code> <n,nnn>.<cc>' with n = 37k mod
    100000 and cc = k mod 100; a minus sign when k % 9 = 0, an unknown code
    'XXX' when k % 17 = 0, empty text when k % 31 = 0.
    """
    core = crm.opportunity_core(spark, sf_dir).select("Id", "CurrencyIsoCode", "_k")
    k = F.col("_k")
    num = F.concat(F.when(k % 9 == 0, F.lit("-")).otherwise(F.lit("")),
                   F.format_number(((k * 37) % 100000).cast("long"), 0), F.lit("."),
                   F.lpad((k % 100).cast("string"), 2, "0"))
    text = (F.when(k % 31 == 0, F.lit(""))
             .when(k % 17 == 0, F.concat(F.lit("XXX "), num))
             .otherwise(F.concat(F.col("CurrencyIsoCode"), F.lit(" "), num)))
    return core.select("Id", text.alias("amount_text"))


def currency_scrub(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Currency text -> number, USD-only and all-codes variants."""
    t = currency_text(spark, sf_dir)
    pattern = currency_codes_pattern(crm.currency(spark, sf_dir))
    return t.select("Id", "amount_text",
                    scrub_usd(F.col("amount_text")).alias("usd_value"),
                    scrub_currency(F.col("amount_text"), pattern).alias("value"))


# ------------------------------------------------------------------- W31
def record_links(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Record links (three hosts, two record kinds) and a link formula for every deal."""
    o = crm.opportunity(spark, sf_dir)
    opp_b = record_link(F.col("Id"), "Opportunity", HOST_B)
    return o.select(
        "Id", "Name", "AccountId",
        record_link(F.col("Id"), "Opportunity", HOST_A).alias("opp_link_a"),
        opp_b.alias("opp_link_b"),
        record_link(F.col("AccountId"), "Account", HOST_A).alias("account_link_a"),
        record_link(F.col("AccountId"), "Account", HOST_C).alias("account_link_c"),
        link_formula(opp_b, F.col("Name")).alias("name_link"))


# ------------------------------------------------------------------- W29
def flatten_nested(df: DataFrame, first: tuple = ("name", "label")) -> DataFrame:
    """Complex columns (array / map / struct) become JSON text columns named
    ``_<name>``; the ``first`` columns, when present, lead."""
    from pyspark.sql.types import ArrayType, MapType, StructType
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f"_{f.name}"))
        else:
            out.append(F.col(f"`{f.name}`"))
    flat = df.select(*out)
    lead = [c for c in first if c in flat.columns]
    return flat.select(*lead, *[c for c in flat.columns if c not in lead])


def flatten_customers(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """W29 on customers with a struct, the list of their orders (bounded by a customer's orders) and a map."""
    from pipewright.sources.tables import read
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    o = read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(
        F.struct(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status")))).alias("orders"))
    d = c.join(per, c["c_custkey"] == per["o_custkey"], "left")
    orders = F.coalesce("orders", F.array().cast(per.schema["orders"].dataType))
    return flatten_nested(d.select(
        "c_custkey", F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("place"),
        orders.alias("orders"), F.create_map("c_mktsegment", F.size(orders)).alias("counts")))
