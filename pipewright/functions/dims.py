"""Fixed values and the small dimension tables built from them.

Every list below is a value set the reports test against; a different value
gives a different number, so they are stated here once, in the order the
reports use them. The dimension tables made from them are literal and tiny,
so broadcasting them is safe at any data size.

People (owners to exclude, rep groups) and product families are *inputs*, not
fixed values: they are passed in as tables (see ``sources.crm``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ============================ FIXED VALUES ============================
# --- stages
STAGE_CLOSED_WON = "Closed Won"
STAGE_CLOSED_LOST = "Closed Lost"
CLOSED_WON_STAGES = ["5-Closed", "Closed Won"]
CLOSED_LOST_STAGES = ["99-Lost", "Closed Lost"]
CLOSED_STAGES = CLOSED_WON_STAGES + CLOSED_LOST_STAGES
JUNK_STAGES = ["Unqualified", "Disqualified", "Needs Analysis", "0-Suspect", "Attempting Contact",
               "Discovery", "Temporary", "Untouched", "No Response", "Closed Deferred", "Identified",
               "Alternate Configuration", "Data Quality", "Nurture"]
HOUSEKEEPING_STAGES = ["Temporary", "Data Quality"]
EARLY_STAGES = ["Identify", "Discovery", "Demonstration", "Untouched"]

# stage order of the open-pipeline tables (lowest rank first)
PIPELINE_STAGE_ORDER = ["Engaged", "Demonstration", "Business Review", "Offer", "Sales Accepted Opp",
                        "Solution Overview", "Eval Planning", "POC", "Tech Eval", "Proposal",
                        "Negotiation", "Awaiting Approval", "Sign-Off", "Order Confirmed", "Closed Won"]
RENEWAL_PIPELINE_STAGES = ["Engaged", "Business Review", "Offer", "Awaiting Approval", "Order Confirmed"]
# stages dropped from the stage-mix table
STAGE_MIX_EXCLUDED = ["Closed Lost", "Discovery", "Data Quality", "Nurture", "Temporary",
                      "Disqualified", "Identify", "Attempting Contact", "Untouched"]
# stages dropped from the top-deals table (in addition to CLOSED_STAGES)
TOP_DEALS_EXCLUDED = ["Discovery", "Data Quality", "Nurture", "Temporary", "Disqualified",
                      "Attempting Contact", "Demonstration", "Untouched", "Identify"]
# stage order of the deal-velocity tables
VELOCITY_STAGE_ORDER = ["Discovery", "Solution Overview", "Eval Planning", "Tech Eval", "Negotiation"]

# --- opportunity types and categories
TYPE_NEW = "New Business"
TYPE_EXISTING = "Existing Business"
TYPE_EXPANSION = "Expansion"
FLIP_CATEGORIES = ["Flips - Maintenance", "Flips - Term License"]
RENEWAL_CATEGORIES = ["Renewal"] + FLIP_CATEGORIES
NON_PIPELINE_CATEGORIES = ["Professional Services", "Data Error - See Rev Ops"]
VELOCITY_CATEGORIES = ["New", "Expansion", "SAP - Expansion"]
INSTALLMENT_RENEWAL_TYPES = ["Annual Installment Billing", "Prorated Installments", "Annual Booking"]

# type groups: (type, group, flip kind)
TYPE_GROUPS = [
    ("Grandfathered Renewal", "Flip", None),
    ("Subscription", "Flip", None),
    ("Subscription Flip", "Flip", "Maintenance Flip"),
    ("Term Flip", "Flip", "Term Flip"),
    ("SAP Flip", "Flip", "SAP Flip"),
    ("New Logo", "New Business", None),
    ("New Business", "New Business", None),
    ("Pilot / POC", "New Business", None),
    ("Existing Customer", "Expansion", None),
    ("Add-on Sales", "Expansion", None),
    ("Existing Business", "Expansion", None),
    ("On Premise to SaaS", "Expansion", None),
    ("Perpetual to Term", "Expansion", None),
    ("Professional Services", "Professional Services", None),
    ("null", "Junk", None),
    ("Temporary", "Junk", None),
    ("Expenses", "Junk", None),
    ("Renewal", "Renewal", None),
    ("Renewal Business", "Renewal", None),
]

# --- funnels
FUNNELS = ["Expansion", "New Sales - Outbound", "New Sales - Inbound"]

# --- regions
NORTH_AMERICA_REGIONS = ["North America", "LATAM"]
ALL_REGIONS = ["Benelux", "North America", "DACH", "UK", "APJ", "Rest of EMEA", "LATAM", "Nordics",
               "Other", "Eastern Europe"]
GEO_NORTH_AMERICA = "North America"
GEO_REST = "EMEA + ROW"
BUCKET_NORTH_AMERICA = "NA"
BUCKET_REST = "EU + ROW"

# --- owner role classes: lower-cased role name LIKE pattern -> class, first match wins
ROLE_CLASSES = [("%customer%", "CAM"), ("%strategic%", "SAM")]
ROLE_CLASS_DEFAULT = "AE"

# --- limits and formats
TOP_DEALS_PER_OWNER = 10
NOTES_LIMIT = 50_000          # notes at or above this length are cut to NOTES_LIMIT - 1 chars
RECORD_PATH = "/lightning/r/{kind}/{id}/view"
LINK_FORMULA = '=HYPERLINK("{url}","{name}")'
# ========================== END FIXED VALUES ==========================


def stage_dim(spark: SparkSession, order: list[str] = PIPELINE_STAGE_ORDER) -> DataFrame:
    """(stage, stage_rank) with rank 1 for the first level."""
    return spark.createDataFrame([(s, i + 1) for i, s in enumerate(order)], "stage string, stage_rank int")


def geo(region):
    """Two-way geography; anything not North American (NULL included) is the rest."""
    from pipewright.functions.nulls import in_set
    return F.when(in_set(region, NORTH_AMERICA_REGIONS), F.lit(GEO_NORTH_AMERICA)).otherwise(F.lit(GEO_REST))


def region_bucket(region):
    """SQL CASE form of the geography (same NULL rule: NULL -> rest)."""
    return F.when(region.isin(NORTH_AMERICA_REGIONS), F.lit(BUCKET_NORTH_AMERICA)).otherwise(F.lit(BUCKET_REST))


def role_class(role_name):
    lo = F.lower(role_name)
    expr = None
    for pattern, cls in ROLE_CLASSES:
        expr = F.when(lo.like(pattern), F.lit(cls)) if expr is None else expr.when(lo.like(pattern), F.lit(cls))
    return expr.otherwise(F.lit(ROLE_CLASS_DEFAULT))
