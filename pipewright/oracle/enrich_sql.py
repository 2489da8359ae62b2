"""DuckDB texts for extract, classification, currency text, links and the audited merge."""

from __future__ import annotations

from pipewright.functions import dims
from pipewright.functions.periods import ReportParams
from pipewright.oracle.fixtures import _lit, views
from pipewright.oracle.scorecard_sql import _in
from pipewright.plans import accounts, enrich

CURRENCY_FIELDS = ["ACV_Bookings", "Amount", "ExpectedRevenue", "Software_QB", "RW_Expansion_Amount",
                   "Managers_Forecast", "Recurring_Booking_PY", "Billing_Period_1"]


def _values(name: str, cols: str, rows) -> str:
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join(_lit(v) for v in r) + ")" for r in rows) + f") t({cols}))"


def ingest_converted(p: ReportParams | None = None) -> str:
    conv = ", ".join(f"o.{f} / ct.ConversionRate AS {f}_Converted" for f in CURRENCY_FIELDS)
    return views("opportunity", "account", "users", "currency") + f"""
SELECT o.*, a.Name AS Account_Name, u.Name AS Owner_Name, {conv}
FROM opportunity o
LEFT JOIN account a ON o.AccountId = a.Id
LEFT JOIN users u ON o.OwnerId = u.Id
LEFT JOIN currency ct ON o.CurrencyIsoCode = ct.IsoCode"""


def opp_classified(p: ReportParams | None = None) -> str:
    fam = _values("fam", "p, fam", sorted(enrich.PRODUCT_FAMILIES.items()))
    tg = _values("tg", "Type, type_group, flip_kind", dims.TYPE_GROUPS)
    rg = _values("rg", "Region, region_group",
                 [(r, "North America" if r in dims.NORTH_AMERICA_REGIONS else "EMEA") for r in dims.ALL_REGIONS])
    return views("opportunity", with_product=True) + f""",
{fam}, {tg}, {rg},
parts AS (SELECT Id, unnest(string_split(Product, ';')) AS part FROM opportunity),
pf AS (
  SELECT parts.Id, string_agg(DISTINCT fam.fam, ';' ORDER BY fam.fam) AS f
  FROM parts JOIN fam ON parts.part = fam.p GROUP BY parts.Id
)
SELECT o.Id, o.Product, coalesce(w.fam, pf.f) AS product_family, o.Type, tg.type_group, tg.flip_kind,
       o.Region, rg.region_group, o.StageName,
       coalesce(o.StageName IN {_in(dims.CLOSED_STAGES)}, FALSE) AS is_closed,
       coalesce(o.StageName IN {_in(dims.JUNK_STAGES)}, FALSE) AS is_junk_stage
FROM opportunity o
LEFT JOIN fam w ON o.Product = w.p
LEFT JOIN pf ON o.Id = pf.Id
LEFT JOIN tg ON o.Type = tg.Type
LEFT JOIN rg ON o.Region = rg.Region"""


def _family_ctes() -> str:
    """Deals with their labels, the lists as tables: families f (label, value), funnels u (label, source)."""
    acquired = enrich.TRANSFER_PRODUCTS + enrich.OTHER_ACQUIRED_PRODUCTS
    named = [("Scheduling", enrich.SCHEDULING_PRODUCTS), ("Finance", enrich.FINANCE_PRODUCTS), ("Transfer", enrich.TRANSFER_PRODUCTS),
             ("Acquired", acquired)]
    listed = _values("listed", "label, value", [(n, v) for n, vs in named for v in vs])
    every = _values("every", "value", [(v,) for v in enrich.ALL_PRODUCTS])
    sources = _values("u", "label, source", [("New Sales - Outbound", v) for v in enrich.OUTBOUND_SOURCES]
                      + [("New Sales - Inbound", v) for v in enrich.INBOUND_SOURCES])
    return views("opportunity", "currency", with_product=True) + f""",
{listed}, {every}, {sources},
f AS (SELECT label, value FROM listed UNION ALL
      SELECT 'Heritage', value FROM (SELECT value FROM every EXCEPT SELECT value FROM listed WHERE label = 'Acquired')),
parts AS (SELECT Id, unnest(CASE WHEN Product IS NULL THEN [NULL] ELSE string_split(Product, ';') END) AS part FROM opportunity),
whole AS (SELECT o.Id, label FROM opportunity o JOIN f ON f.value IS NOT DISTINCT FROM o.Product),
piece AS (SELECT DISTINCT parts.Id, label FROM parts JOIN f ON f.value IS NOT DISTINCT FROM part),
funnel AS (SELECT Id, 'Expansion' AS label FROM opportunity WHERE Type IN ('Existing Business', 'Expansion') UNION ALL
           SELECT o.Id, u.label FROM opportunity o JOIN u ON u.source = o.LeadSource
           WHERE coalesce(o.Type NOT IN ('Existing Business', 'Expansion'), TRUE))
"""


def opp_families(p: ReportParams | None = None) -> str:
    def text(t: str) -> str:
        return f"coalesce((SELECT string_agg(label, ';' ORDER BY label) FROM {t} x WHERE x.Id = o.Id), '')"
    return _family_ctes() + f"""
SELECT o.Id, o.Product, {text("whole")} AS families, (SELECT count(*) FROM whole x WHERE x.Id = o.Id) AS n_families,
       {text("piece")} AS part_families, o.Type, o.LeadSource, {text("funnel")} AS funnels,
       EXISTS (FROM whole x WHERE x.Id = o.Id AND label = 'Acquired') AS is_acquired,
       EXISTS (FROM funnel x WHERE x.Id = o.Id) AS in_funnel
FROM opportunity o"""


def family_totals(p: ReportParams | None = None) -> str:
    from pipewright.oracle.scorecard_sql import _m, _usd
    amount = _m("o.ACV_Bookings / ct.ConversionRate")
    return _family_ctes() + f"""
SELECT coalesce(w.label, '') AS family, coalesce(fu.label, '') AS funnel, count(*) AS deals,
       {_usd(f"coalesce(sum({amount}), 0)")} AS QB_USD
FROM opportunity o LEFT JOIN whole w ON w.Id = o.Id LEFT JOIN funnel fu ON fu.Id = o.Id
LEFT JOIN currency ct ON ct.IsoCode = o.CurrencyIsoCode
GROUP BY ALL"""


def currency_scrub(p: ReportParams | None = None) -> str:
    num = ("(CASE WHEN _k % 9 = 0 THEN '-' ELSE '' END) || format('{:,}', (_k * 37) % 100000) || '.' || "
           "lpad(CAST(_k % 100 AS VARCHAR), 2, '0')")
    return views("opportunity") + f""",
texts AS (
  SELECT Id, CASE WHEN _k % 31 = 0 THEN '' WHEN _k % 17 = 0 THEN 'XXX ' || {num}
                  ELSE CurrencyIsoCode || ' ' || {num} END AS amount_text
  FROM opportunity_k
),
stripped AS (
  SELECT Id, amount_text, replace(amount_text, 'USD ', '') AS u,
         regexp_replace(amount_text,
                        (SELECT '(' || string_agg(IsoCode || ' ', '|' ORDER BY IsoCode) || ')' FROM currency), '', 'g') AS c
  FROM texts
)
SELECT Id, amount_text,
       CASE WHEN contains(u, '-') THEN NULL ELSE TRY_CAST(trim(replace(u, ',', '')) AS DOUBLE) END AS usd_value,
       CASE WHEN contains(c, '-') THEN NULL ELSE TRY_CAST(trim(replace(c, ',', '')) AS DOUBLE) END AS value
FROM stripped"""


def record_links(p: ReportParams | None = None) -> str:
    def url(host: str, kind: str, idx: str) -> str:
        return f"'{host}/lightning/r/{kind}/' || CAST({idx} AS VARCHAR) || '/view'"
    opp_b = url(enrich.HOST_B, "Opportunity", "Id")
    return views("opportunity") + f"""
SELECT Id, Name, AccountId,
       {url(enrich.HOST_A, "Opportunity", "Id")} AS opp_link_a,
       {opp_b} AS opp_link_b,
       {url(enrich.HOST_A, "Account", "AccountId")} AS account_link_a,
       {url(enrich.HOST_C, "Account", "AccountId")} AS account_link_c,
       '=HYPERLINK("' || {opp_b} || '","' || coalesce(Name, 'NA') || '")' AS name_link
FROM opportunity"""


def flatten_nested() -> str:
    """Nested columns as JSON text: a struct, an array of structs and a map of an order's lines."""
    return """
SELECT c_name AS name, c_custkey,
       '{"segment":' || to_json(c_mktsegment) || ',"nation":' || c_nationkey || '}' AS _place,
       '[' || coalesce(string_agg('{"order":' || o_orderkey || ',"status":' || to_json(o_orderstatus) || '}', ','
                                  ORDER BY o_orderkey) FILTER (o_orderkey IS NOT NULL), '') || ']' AS _orders,
       '{"' || c_mktsegment || '":' || count(o_orderkey) || '}' AS _counts
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_name, c_custkey, c_mktsegment, c_nationkey"""


ACCOUNT_CTES = f"""WITH acct AS (
  SELECT c_custkey AS Id, c_name AS Name, c_mktsegment AS Segment, c_acctbal AS Balance
  FROM customer, range(if(c_custkey % 101 = 0, 2, 1))
),
changes AS (
  SELECT if(rule.nokey, NULL, c_custkey + if(rule.fresh, {accounts.NEW_KEY_OFFSET}, 0)) AS Id,
         if(rule.fresh, 'New ', '') || c_name AS Name, c_mktsegment AS Segment,
         c_acctbal + CAST(rule.extra AS DOUBLE) AS Balance, rule.seq AS seq
  FROM customer JOIN (VALUES (7, 0, 100, 1, FALSE, FALSE), (49, 0, 200, 2, FALSE, FALSE), (7, 1, 0, 1, FALSE, FALSE),
       (11, 0, 0, 1, TRUE, FALSE), (13, 0, 300, 3, FALSE, FALSE), (13, 0, 400, 3, FALSE, FALSE),
       (17, 0, 500, 4, FALSE, FALSE), (17, 0, 500, 4, FALSE, FALSE), (101, 0, 600, 5, FALSE, FALSE),
       (97, 0, 700, 6, FALSE, TRUE)) rule(m, r, extra, seq, fresh, nokey) ON c_custkey % rule.m = rule.r
),
held AS (SELECT Id, count(*) AS copies FROM acct GROUP BY Id),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.Id ORDER BY c.seq DESC, c.Name DESC, c.Segment DESC, c.Balance DESC) AS rn,
         coalesce(copies, 0) AS copies
  FROM changes c LEFT JOIN held ON held.Id = c.Id
),
last AS (SELECT * FROM ranked WHERE rn = 1 AND Id IS NOT NULL)
"""


def audited_merge(mode: str = "upsert") -> str:
    missing = "'inserted'" if mode == "upsert" else "'missing key'"
    return ACCOUNT_CTES + f"""
SELECT r.Id, r.seq,
       CASE WHEN r.Id IS NULL THEN 'no key' WHEN copies > 1 THEN 'ambiguous key' WHEN rn > 1 THEN 'superseded'
            WHEN copies = 0 THEN {missing}
            WHEN EXISTS (SELECT 1 FROM acct a WHERE a.Id = r.Id AND a.Name = r.Name AND a.Segment = r.Segment
                         AND a.Balance = r.Balance) THEN 'unchanged'
            ELSE 'updated' END AS outcome
FROM ranked r"""


def merged_accounts(mode: str = "upsert") -> str:
    new = "UNION ALL SELECT Id, Name, Segment, Balance FROM last WHERE copies = 0" if mode == "upsert" else ""
    return ACCOUNT_CTES + f"""
SELECT a.Id, coalesce(l.Name, a.Name) AS Name, coalesce(l.Segment, a.Segment) AS Segment,
       coalesce(l.Balance, a.Balance) AS Balance
FROM acct a LEFT JOIN last l ON l.Id = a.Id AND l.copies = 1
{new}"""


def accounts_before_image() -> str:
    return ACCOUNT_CTES + "SELECT * FROM acct WHERE Id IN (SELECT Id FROM changes)"


def reverted_accounts() -> str:
    return ACCOUNT_CTES + "SELECT * FROM acct"


REVERT_CTES = ACCOUNT_CTES + """,
touched AS (
  SELECT l.*, a.Name AS old_Name, a.Segment AS old_Segment, a.Balance AS old_Balance
  FROM last l LEFT JOIN acct a ON a.Id = l.Id
  WHERE copies = 0 OR (copies = 1 AND (l.Name, l.Segment, l.Balance) IS DISTINCT FROM (a.Name, a.Segment, a.Balance))
),
merged AS (
  SELECT a.Id, coalesce(l.Name, a.Name) AS Name, coalesce(l.Segment, a.Segment) AS Segment, coalesce(l.Balance, a.Balance) AS Balance
  FROM acct a LEFT JOIN last l ON l.Id = a.Id AND l.copies = 1
  UNION ALL SELECT Id, Name, Segment, Balance FROM last WHERE copies = 0
),
edited AS (
  SELECT Id, Name, Segment, if(Id % 21 = 0, Balance + 1, Balance) AS Balance
  FROM merged, range(if(Id % 26 = 0, 2, 1)) WHERE Id % 22 <> 0
),
sized AS (SELECT *, count(*) OVER (PARTITION BY Id) AS copies_now FROM edited),
judged AS (
  SELECT DISTINCT t.*, CASE WHEN s.Id IS NULL THEN 'gone'
      WHEN s.copies_now > 1 OR (s.Name, s.Segment, s.Balance) IS DISTINCT FROM (t.Name, t.Segment, t.Balance) THEN 'changed since'
      WHEN t.copies = 0 THEN 'deleted' ELSE 'restored' END AS outcome
  FROM touched t LEFT JOIN sized s ON s.Id = t.Id
)
"""


def revert_outcomes() -> str:
    return REVERT_CTES + "SELECT Id, outcome FROM judged"


def reverted_after_edits() -> str:
    return REVERT_CTES + """
SELECT s.Id, if(j.outcome = 'restored', j.old_Name, s.Name) AS Name, if(j.outcome = 'restored', j.old_Segment, s.Segment) AS Segment,
       if(j.outcome = 'restored', j.old_Balance, s.Balance) AS Balance
FROM sized s LEFT JOIN judged j ON j.Id = s.Id WHERE j.outcome IS DISTINCT FROM 'deleted'"""
