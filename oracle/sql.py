"""Query name -> SQL."""

from __future__ import annotations

import re

from lakehouse_kpis.sources import fixed
from oracle.base import BUCKET, PRELUDE, big, dbl, mapped

ORACLE: dict[str, str] = {}


def add(name: str, tail: str) -> None:
    assert name not in ORACLE, name
    ORACLE[name] = PRELUDE + tail.strip()


# --- landed -------------------------------------------------------------------------------

add("bronze_products", f"""
SELECT item AS ITEMID, name AS ITEMNAME, grp AS ITEMGROUPID, tier AS PRODUCTSUBTYPE,
  {mapped('grp', fixed.SALES_UNITS, 'each')} AS SALESUNIT, {dbl('cost')} AS UNITCOST_USD,
  {dbl('price')} AS LISTPRICE_USD, off AS DISCONTINUED, made AS CREATEDDATETIME,
  'USMF' AS DATAAREAID
FROM b_products""")
add("bronze_customers", f"""
SELECT account AS ACCOUNTNUM, name || ' ' AS NAME, email AS EMAIL, phone AS PHONE,
  street AS ADDRESS_LINE1, city AS CITY, state AS STATE_PROVINCE, zip AS POSTAL_CODE,
  country AS COUNTRY, territory AS TERRITORY, segment AS CUSTGROUP, blocked AS BLOCKED,
  {dbl('credit')} AS CREDITLIMIT_USD, created AS CREATEDDATETIME,
  modified AS MODIFIEDDATETIME, 'USMF' AS DATAAREAID
FROM b_customers""")
add("bronze_invoice_lines", f"""
SELECT invoice AS INVOICEID, num AS LINENUM, account AS INVOICEACCOUNT, item AS ITEMID,
  day AS INVOICEDATE, qty AS QTY, {dbl('price')} AS SALESPRICE, {dbl('amount')} AS LINEAMOUNT,
  {dbl('tax')} AS TAXAMOUNT, 'USD' AS CURRENCYCODE, 'USMF' AS DATAAREAID,
  CAST(day AS TIMESTAMP) AS POSTEDDATETIME,
  'SR' || sha1(invoice || num) AS _SYSROWID, CAST(day AS TIMESTAMP) AS _SINKMODIFIEDTIME
FROM b_lines""")
add("bronze_markups", f"""
SELECT 'MK-' || sha1(invoice) || '-' || code AS RECID, invoice AS INVOICEID,
  code AS MARKUPCODE, {dbl('value')} AS VALUE,
  {mapped('code', fixed.CHARGE_ACCOUNTS)} AS MARKUPACCOUNT, CAST(posted AS TIMESTAMP) AS TRANSDATE,
  'USMF' AS DATAAREAID
FROM b_markups""")
CHANNELS = ", ".join(str(row) for row in fixed.DIMENSION_VALUES)
add("bronze_dimension_values", f"""
SELECT m.*, n AS gl_rows
FROM (VALUES {CHANNELS}) AS m(BU_CODE, BU_NAME, CHANNEL_CODE, CHANNEL_NAME)
LEFT JOIN (SELECT unit, {big('count(*)')} AS n FROM b_gl GROUP BY unit) ON unit = BU_CODE""")
add("bronze_legacy_headers", f"""
SELECT invoice AS INVOICEID, account AS INVOICEACCOUNT, day AS INVOICEDATE,
  {dbl('amount')} AS INVOICEAMOUNT, {dbl('tax')} AS SALESTAXAMOUNT, 'USD' AS CURRENCYCODE,
  posted AS POSTED, 'LEG' AS DATAAREAID
FROM b_headers""")
add("bronze_gl", f"""
SELECT voucher_id AS VOUCHER, transaction_date AS TRANSDATE, gl_account AS ACCOUNTNUM,
  gl_description AS GL_DESCRIPTION, gl_category AS GL_CATEGORY, {dbl('amount_usd')} AS AMOUNTMST,
  'USD' AS CURRENCYCODE, business_unit AS DIM_BUSINESS_UNIT, territory AS DIM_TERRITORY,
  'LEG' AS DATAAREAID
FROM gl""")
add("bronze_employees", f"""
SELECT employee AS EMPLOYEE_ID, name AS FULL_NAME, ssn AS SSN, hired AS HIRE_DATE,
  {dbl('salary')} AS ANNUAL_SALARY, dept_code AS DEPARTMENT_CODE, dept AS DEPARTMENT,
  email AS WORK_EMAIL, territory AS TERRITORY, status AS STATUS
FROM b_employees""")
add("bronze_deals", f"""
SELECT deal AS DEAL_ID, name AS DEAL_NAME, {dbl('amount')} AS AMOUNT_USD, stage AS DEALSTAGE,
  account AS ASSOCIATED_ACCOUNTNUM, created AS CREATED_AT, territory AS TERRITORY,
  lead AS LEAD_SOURCE
FROM b_deals""")
add("bronze_sessions", """
SELECT session AS SESSION_ID, visitor AS USER_PSEUDO_ID, day AS SESSION_DATE, source AS SOURCE,
  medium AS MEDIUM, campaign AS CAMPAIGN, device AS DEVICE_CATEGORY, country AS COUNTRY,
  territory AS TERRITORY, item AS PRODUCT_VIEWED, event AS EVENT_NAME
FROM b_sessions""")

# --- conformed ----------------------------------------------------------------------------

CUSTOMER = f"* REPLACE ({dbl('credit_limit_usd')} AS credit_limit_usd)"
EMPLOYEE = f"* REPLACE ({dbl('annual_salary_usd')} AS annual_salary_usd)"
FACT_MONEY = [
    "unit_sales_price", "gross_line_amount", "freight_amount", "discount_amount",
    "pallet_amount", "net_invoice_amount", "tax_amount",
]


def doubled(columns: list[str]) -> str:
    return "* REPLACE (" + ", ".join(f"{dbl(c)} AS {c}" for c in columns) + ")"


add("silver_dim_customer", f"SELECT {CUSTOMER} FROM customers")
add("silver_dim_product",
    f"SELECT {doubled(['unit_cost_usd', 'list_price_usd'])} FROM products")
add("silver_dim_employee", f"SELECT {EMPLOYEE} FROM employees")
REGIONS = ", ".join(str(row) for row in fixed.REGIONS)
add("silver_dim_region", f"""
SELECT r.*, n AS customers
FROM (VALUES {REGIONS}) AS r(territory_key, country_name, country_code, timezone)
LEFT JOIN (SELECT territory, {big('count(*)')} AS n FROM customers GROUP BY ALL)
  ON territory = territory_key""")
add("silver_dim_date", f"""
SELECT year(invoice_date) || '-Q' || quarter(invoice_date) AS year_quarter,
  CAST(month(invoice_date) AS INTEGER) AS month, strftime(invoice_date, '%b') AS month_name,
  CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS day_of_week,
  strftime(invoice_date, '%A') AS day_name,
  dayofweek(invoice_date) IN (0, 6) AS is_weekend,
  {dbl('sum(net_invoice_amount)')} AS net_revenue, {big('count(*)')} AS line_count
FROM fact GROUP BY ALL""")
add("silver_markup_pivot", f"""
SELECT invoice AS INVOICEID, {dbl('freight')} AS freight_amount,
  {dbl('discount')} AS discount_amount, {dbl('pallet')} AS pallet_amount
FROM pivot_charges""")
add("silver_header_as_line", f"""
SELECT invoice AS invoice_id, 1 AS line_num, day AS invoice_date, account AS customer_key,
  item AS product_key, 1 AS quantity, {dbl('amount')} AS unit_sales_price,
  {dbl('amount')} AS gross_line_amount, {dbl('tax')} AS tax_amount, 'USD' AS currency,
  'AX_2012' AS source_system
FROM b_headers""")
add("silver_fact_invoice_lines", f"SELECT {doubled(FACT_MONEY)} FROM fact")
add("silver_fact_by_increment", f"SELECT {doubled(FACT_MONEY)} FROM fact")


def share(charge: str) -> str:
    """A line's part of a charge in whole cents; odd cents go to the first lines."""
    cents = f"CAST(coalesce({charge}, 0) * 100 AS BIGINT)"
    return f"sign({cents}) * (abs({cents}) // lines + CAST(place <= abs({cents}) % lines AS INT))"


add("silver_equal_allocation", f"""
, placed AS (
  SELECT *, row_number() OVER (PARTITION BY invoice ORDER BY num) AS place,
    count(*) OVER (PARTITION BY invoice) AS lines
  FROM all_lines),
shared AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS invoice_month, system AS source_system,
    {share('freight')} AS freight, {share('discount')} AS discount, {share('pallet')} AS pallet,
    CAST(amount * 100 AS BIGINT) AS gross
  FROM placed LEFT JOIN pivot_charges USING (invoice))
SELECT invoice_month, source_system, {dbl('sum(freight)')} / 100 AS freight_amount,
  {dbl('sum(discount)')} / 100 AS discount_amount, {dbl('sum(pallet)')} / 100 AS pallet_amount,
  {dbl('sum(gross + freight + discount + pallet)')} / 100 AS net_invoice_amount
FROM shared GROUP BY invoice_month, source_system""")
add("silver_allocation_check", f"""
SELECT invoice AS invoice_id, {dbl('coalesce(freight, 0)')} AS freight_amount,
  {dbl('coalesce(discount, 0)')} AS discount_amount,
  {dbl('coalesce(pallet, 0)')} AS pallet_amount, line_count
FROM (SELECT invoice, {big('count(*)')} AS line_count FROM all_lines GROUP BY invoice)
LEFT JOIN pivot_charges USING (invoice)""")
add("silver_fact_gl_transactions", f"SELECT {doubled(['amount_usd'])} FROM gl")
add("silver_fact_web_engagement", "SELECT * FROM web")
add("silver_fact_crm_deals", f"SELECT {doubled(['amount_usd'])} FROM deals")
add("silver_dedupe_latest", f"""
SELECT {doubled(['amount_usd'])} FROM deals
WHERE deal_id IN (
  SELECT arg_max(deal_id, (created_at, deal_id)) FROM deals GROUP BY customer_key)""")

# --- marts --------------------------------------------------------------------------------

DIRECTORY = """customer_key, customer_name, {email} AS email, {phone} AS phone,
  {address} AS address_line1, city, state_province, postal_code, country, territory,
  customer_segment, is_active, CAST(credit_limit_usd AS DOUBLE) AS credit_limit_usd,
  created_at"""
MASK = {
    "email": "CASE WHEN contains(email, '@') THEN '***@' || split_part(email, '@', 2) "
             "WHEN email IS NOT NULL THEN '***' END",
    "phone": "'***-***-' || right(phone, 4)",
    "address": "CASE WHEN address_line1 IS NOT NULL THEN '[REDACTED]' END",
}
PLAIN = {"email": "email", "phone": "phone", "address": "address_line1"}

add("gold_dim_customer", f"SELECT {DIRECTORY.format(**PLAIN)} FROM customers")
add("gold_dim_employee", f"""
SELECT employee_key, full_name, 'XXX-XX-XXXX' AS ssn, {dbl('annual_salary_usd')}
  AS annual_salary_usd, hire_date, department_code, department, work_email, territory, status
FROM employees""")


def summary(rows: str) -> str:
    return f"""
SELECT invoice_month, territory, customer_segment, product_line, product_tier, source_system,
  {big('count(DISTINCT invoice_id)')} AS invoice_count, {big('count(*)')} AS line_count,
  {big('sum(quantity)')} AS units_sold, {dbl('sum(gross_line_amount)')} AS gross_revenue_usd,
  {dbl('sum(discount_amount)')} AS discount_usd,
  {dbl('sum(freight_amount + pallet_amount)')} AS freight_pallet_usd,
  {dbl('sum(net_invoice_amount)')} AS net_revenue_usd,
  {dbl('sum(estimated_cogs_usd)')} AS estimated_cogs_usd,
  {dbl('sum(net_invoice_amount) - sum(estimated_cogs_usd)')} AS estimated_gross_margin_usd
FROM ({rows}) GROUP BY ALL"""


def finance(rows: str) -> str:
    signed = {"REVENUE": ("revenue", "-"), "REVENUE_CONTRA": ("contra_revenue", "-"),
              "COGS": ("cogs", ""), "OPEX": ("opex", ""), "CAPEX": ("capex", "")}
    totals = ",\n  ".join(
        dbl(f"sum(CASE gl_category WHEN '{c}' THEN {s}amount_usd ELSE 0 END)") + f" AS {n}_usd"
        for c, (n, s) in signed.items()
    )
    return f"""
SELECT gl_month, territory, business_unit, gl_category, gl_account, gl_description,
  {totals}, {big('count(*)')} AS gl_line_count
FROM ({rows}) GROUP BY ALL"""


add("gold_sales_summary", summary("SELECT * FROM d_invoices"))
add("matview_sales_summary", summary("SELECT * FROM d_invoices"))
add("matview_finds_months", summary("SELECT * FROM d_invoices"))
add("gov_sales_summary_regional",
    summary("SELECT * FROM d_invoices WHERE territory = 'Canada-West'"))
add("gold_finance_kpis", finance("SELECT * FROM d_gl"))
add("rls_gl_regional", finance("SELECT * FROM d_gl WHERE territory = 'US-West'"))
C360_MONEY = [
    "credit_limit_usd", "lifetime_revenue_usd", "won_pipeline_usd", "open_pipeline_usd",
]
add("gold_customer_360",
    f"SELECT * EXCLUDE (days_since_last_invoice) REPLACE "
    f"({', '.join(f'{dbl(c)} AS {c}' for c in C360_MONEY)}) FROM c360")
add("gold_ar_aging", f"SELECT {doubled(['outstanding_usd'])} FROM aging")
add("gold_ar_aging_series", f"""
SELECT as_of, customer_key, {BUCKET.replace("DATE '2001-08-31'", "as_of")} AS aging_bucket,
  {big('count(DISTINCT invoice_id)')} AS invoice_count, {dbl('sum(net_invoice_amount)')} AS outstanding_usd
FROM fact, (SELECT last_day(DATE '2001-08-01' - to_months(i)) AS as_of FROM range(24) r(i))
GROUP BY ALL""")

# --- metric view --------------------------------------------------------------------------

DIM = {
    "Invoice Month": "invoice_month", "Invoice Year": "invoice_year",
    "Invoice Quarter": "invoice_quarter", "Source System": "source_system",
    "Territory": "territory", "Country": "country", "Customer Segment": "customer_segment",
    "Product Line": "product_line", "Product Tier": "product_tier",
}
_NET, _GROSS = "sum(net_invoice_amount)", "sum(gross_line_amount)"
_MARGIN = f"{_NET} - sum(cogs)"
_INVOICES = "count(DISTINCT invoice_id)"


def over(numerator: str, denominator: str) -> str:
    return (f"CASE WHEN {denominator} = 0 THEN 0 ELSE {dbl(numerator)} / {dbl(denominator)} END")


MEASURE = {
    "Invoice Count": big(_INVOICES),
    "Line Count": big("count(*)"),
    "Units Sold": big("sum(quantity)"),
    "Gross Revenue": dbl(_GROSS),
    "Discounts": dbl("sum(discount_amount)"),
    "Freight & Pallet": dbl("sum(freight_amount + pallet_amount)"),
    "Net Revenue": dbl(_NET),
    "Estimated COGS": dbl("sum(cogs)"),
    "Estimated Gross Margin": dbl(_MARGIN),
    "Gross Margin Pct": over(_MARGIN, _NET),
    "Discount Pct": over("-sum(discount_amount)", _GROSS),
    "Average Invoice Value": over(_NET, _INVOICES),
    "Active Customers": big("count(DISTINCT customer_key)"),
}


def metric(
    dims: list[str], measures: list[str], where: str = "true", rows: str = "metric",
    names: dict[str, str] | None = None,
) -> str:
    names = names or {}
    columns = [f'{DIM[d]} AS "{names.get(d, d)}"' for d in dims]
    columns += [f'{MEASURE[m]} AS "{names.get(m, m)}"' for m in measures]
    group = " GROUP BY " + ", ".join(DIM[d] for d in dims) if dims else ""
    return f"SELECT {', '.join(columns)} FROM {rows} WHERE {where}{group}"


GRAINS = {
    "invoice_count": ("Invoice Count", ["Invoice Month", "Territory"]),
    "line_count": ("Line Count", ["Product Tier"]),
    "units_sold": ("Units Sold", ["Invoice Year", "Product Line"]),
    "gross_revenue": ("Gross Revenue", ["Invoice Quarter"]),
    "discounts": ("Discounts", ["Customer Segment", "Source System"]),
    "freight_pallet": ("Freight & Pallet", ["Country"]),
    "net_revenue": ("Net Revenue", ["Territory", "Product Line"]),
    "cogs": ("Estimated COGS", ["Invoice Month"]),
    "gross_margin": ("Estimated Gross Margin", ["Product Line", "Product Tier"]),
    "gross_margin_pct": ("Gross Margin Pct", ["Invoice Quarter", "Territory"]),
    "discount_pct": ("Discount Pct", ["Invoice Month", "Customer Segment"]),
    "average_invoice": ("Average Invoice Value", ["Source System", "Invoice Year"]),
    "active_customers": ("Active Customers", ["Territory", "Invoice Year"]),
}
for key, (measure, grain) in GRAINS.items():
    add(f"metric_{key}", metric(grain, [measure]))
for key, dim in {
    "month": "Invoice Month", "year": "Invoice Year", "quarter": "Invoice Quarter",
    "system": "Source System", "territory": "Territory", "country": "Country",
    "segment": "Customer Segment", "line": "Product Line", "tier": "Product Tier",
}.items():
    add(f"metric_by_{key}", metric([dim], ["Net Revenue", "Line Count", "Invoice Count"]))
add("metric_total", metric([], list(MEASURE)))
add("metric_all_by_territory_line", metric(["Territory", "Product Line"], list(MEASURE)))
add("metric_unfiltered_total", metric([], ["Line Count", "Net Revenue"], rows="wide"))
add("metric_floor", metric(["Invoice Year"], ["Line Count", "Net Revenue"], rows="metric_floor"))
add("metric_month_range", metric(
    ["Invoice Month"], ["Net Revenue"],
    "invoice_month BETWEEN DATE '2000-03-01' AND DATE '2000-11-01'"))
add("metric_where_text", metric(
    ["Product Tier"], ["Gross Revenue", "Units Sold"],
    "starts_with(territory, 'US-') AND invoice_year > 1997"))
add("metric_where_literal", metric(
    ["Customer Segment"], ["Net Revenue", "Line Count"],
    "territory IS NOT NULL AND country IS NOT NULL"))
add("metric_having", metric(["Invoice Month", "Territory"], ["Net Revenue", "Invoice Count"])
    + f" HAVING {_INVOICES} >= 20 AND {_NET} > 0")
add("rollup_total", metric([], list(MEASURE)))
add("rollup_all_by_territory_line", metric(["Territory", "Product Line"], list(MEASURE)))
add("rollup_where_text", metric(
    ["Product Line"], ["Gross Revenue", "Invoice Count", "Active Customers"],
    "territory LIKE 'US-%' AND invoice_month >= DATE '2000-03-01'"))
add("metric_rank", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY "Product Line"
  ORDER BY "Net Revenue" DESC, "Invoice Month") AS INTEGER) AS place
FROM ({metric(["Product Line", "Invoice Month"], ["Net Revenue"])}) QUALIFY place <= 2""")

# --- business questions -------------------------------------------------------------------

_NR = {"Net Revenue": "net_revenue", "Gross Margin Pct": "gm_pct"}
_YEAR_AGO = "invoice_date >= DATE '2000-08-01'"
add("bq01_revenue_by_line", metric(["Product Line"], ["Net Revenue"], _YEAR_AGO, names=_NR))
add("bq01_revenue_and_margin_by_line", metric(
    ["Product Line"], ["Net Revenue", "Gross Margin Pct"], _YEAR_AGO, names=_NR))
_GM = {"Gross Margin Pct": "gross_margin_pct"}
add("bq02_best_margin_territory",
    metric(["Territory"], ["Gross Margin Pct"], "territory IS NOT NULL", names=_GM)
    + ' ORDER BY gross_margin_pct DESC, "Territory" LIMIT 1')
add("bq02_best_margin_territories", f"""
, m AS ({metric(["Territory"], ["Gross Margin Pct"], names=_GM)})
SELECT * FROM m WHERE gross_margin_pct = (SELECT max(gross_margin_pct) FROM m)""")
add("bq03_top_customers", f"""
SELECT customer_name, customer_segment, territory, {dbl('lifetime_revenue_usd')}
  AS lifetime_revenue_usd, lifetime_invoices, {dbl('open_pipeline_usd')} AS open_pipeline_usd
FROM c360 ORDER BY c360.lifetime_revenue_usd DESC, customer_key LIMIT 10""")
_AGED = f"""
SELECT territory, {BUCKET} AS aging_bucket, {dbl('sum(net_invoice_amount)')} AS outstanding_usd,
  {big("count(DISTINCT invoice_id || '/' || customer_key)")} AS invoice_count
FROM fact JOIN customers USING (customer_key) WHERE %s GROUP BY ALL"""
add("bq04_aging_by_territory", _AGED % "true")
add("bq04_aging_by_known_territory", _AGED % "territory IS NOT NULL")
add("bq05_revenue_by_system", f"""
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, source_system,
  {dbl('sum(net_invoice_amount)')} AS net_revenue
FROM fact WHERE invoice_date >= DATE '1999-08-01' GROUP BY ALL""")
add("bq06_quotes_by_campaign", f"""
SELECT campaign, {big("count(*) FILTER (WHERE event = 'request_quote')")} AS quote_requests
FROM b_sessions WHERE year(day) = 2024 GROUP BY campaign""")
add("bq06_campaigns_with_quotes", f"""
SELECT campaign, {big('count(*)')} AS quote_requests FROM b_sessions
WHERE day >= DATE '2024-01-01' AND event = 'request_quote' GROUP BY campaign""")
add("bq07_margin_trend", metric(
    ["Invoice Month", "Product Line"], ["Net Revenue", "Gross Margin Pct"], names=_NR))
add("bq07_margin_trend_known_lines", metric(
    ["Invoice Month", "Product Line"], ["Gross Margin Pct"], "product_line IS NOT NULL",
    names={"Invoice Month": "month", **_GM}))
add("bq08_quiet_contractors", f"""
SELECT customer_name, territory, {dbl('open_pipeline_usd')} AS open_pipeline_usd,
  last_invoice_date
FROM c360 WHERE customer_segment = 'CONTRACTOR' AND c360.open_pipeline_usd > 100000
  AND coalesce(last_invoice_date, DATE '1900-01-01') < DATE '2001-06-02'""")
_DP = {"Discount Pct": "discount_pct"}
add("bq09_discount_by_segment", metric(
    ["Customer Segment"], ["Discount Pct"], "invoice_year = 2001", names=_DP))
add("bq09_discount_by_known_segment", metric(
    ["Customer Segment"], ["Discount Pct"],
    "invoice_year = 2001 AND customer_segment IS NOT NULL", names=_DP))
_LEDGER = f"""
SELECT CAST(date_trunc('year', transaction_date) AS DATE) AS year, gl_category,
  {dbl('sum(amount_usd_signed)')} AS amount_usd
FROM d_gl WHERE %s GROUP BY ALL"""
add("bq10_ledger_five_years", _LEDGER % "transaction_date >= DATE '1996-08-31'")
add("bq10_ledger_main_categories", _LEDGER % (
    "transaction_date >= DATE '1996-01-01' AND gl_category <> 'REVENUE_CONTRA'"))
add("bq10_ledger_all_years", _LEDGER % "true")
_YEARLY = """
, yearly AS (
  SELECT product_key, year(invoice_date) AS yr, sum(net_invoice_amount) AS revenue
  FROM fact GROUP BY ALL),
steps AS (
  SELECT product_key, yr, revenue,
    lag(revenue) OVER (PARTITION BY product_key ORDER BY yr) AS before
  FROM yearly)
"""
add("bq11_product_growth", _YEARLY + f"""
SELECT product_name, product_line, CAST(yr AS INTEGER) AS yr, {dbl('revenue')} AS net_rev,
  {dbl('before')} AS prev_year_net_rev, {dbl('revenue - before')} AS yoy_growth_usd
FROM steps JOIN products USING (product_key) WHERE before IS NOT NULL
ORDER BY revenue - before DESC, product_key, yr LIMIT 50""")
add("bq11_product_growth_pct", _YEARLY + f"""
SELECT make_date(yr, 1, 1) AS year, product_key, product_name, {dbl('revenue')} AS revenue,
  CASE WHEN before <> 0 THEN {dbl('revenue - before')} / {dbl('before')} * 100 END
    AS yoy_growth_pct
FROM steps JOIN products USING (product_key) WHERE before IS NOT NULL""")
add("bq12_segment_share", f"""
, cells AS (SELECT territory, customer_segment, {_NET} AS cell FROM metric GROUP BY ALL),
wholes AS (SELECT territory, {_NET} AS whole FROM metric GROUP BY ALL)
SELECT c.territory AS "Territory", customer_segment AS "Customer Segment",
  {dbl('cell')} AS net_revenue, {dbl('cell')} / nullif({dbl('whole')}, 0) AS share_of_territory
FROM cells c JOIN wholes w ON w.territory IS NOT DISTINCT FROM c.territory""")
add("bq12_known_segment_share", f"""
, cells AS (SELECT territory, customer_segment, {_NET} AS cell FROM metric
  WHERE customer_segment IS NOT NULL GROUP BY ALL),
wholes AS (SELECT territory, {_NET} AS whole FROM metric GROUP BY ALL)
SELECT territory AS "Territory", customer_segment AS "Customer Segment",
  {dbl('cell')} AS segment_net_revenue, {dbl('whole')} AS territory_net_revenue,
  {dbl('cell')} / nullif({dbl('whole')}, 0) AS revenue_share
FROM cells JOIN wholes USING (territory)""")
add("bq13_campaign_conversion", f"""
, n AS (SELECT campaign, count(*) AS s, count(*) FILTER (WHERE event = 'request_quote') AS q
  FROM b_sessions WHERE day >= DATE '2024-01-01' GROUP BY campaign)
SELECT campaign, {big('s')} AS sessions, {big('q')} AS quotes,
  {dbl('(q * 20000 + s) // (2 * s)')} / 100 AS quote_conv_pct
FROM n""")
add("bq14_revenue_mix", metric(["Customer Segment", "Territory"], ["Net Revenue"], names=_NR))
add("bq15_visible_customers", f"""
SELECT territory, {big('count(*)')} AS rows FROM customers WHERE territory = 'US-East'
GROUP BY territory""")
add("bq15_visible_contacts", f"""
SELECT customer_key, {MASK['email']} AS email, phone, {MASK['address']} AS address_line1,
  territory
FROM customers""")

# --- governance ---------------------------------------------------------------------------

add("mask_email", f"SELECT customer_key, {MASK['email']} AS email FROM customers")
add("mask_phone", f"SELECT customer_key, {MASK['phone']} AS phone FROM customers")
add("mask_address", f"SELECT customer_key, {MASK['address']} AS address_line1 FROM customers")
add("mask_ssn", "SELECT employee_key, 'XXX-XX-XXXX' AS ssn FROM employees")
add("mask_salary", "SELECT employee_key, CAST(NULL AS DOUBLE) AS annual_salary_usd FROM employees")

# persona -> (sees email and address, sees phone, rows)
SEEN = {
    "HR": (True, True, "true"),
    "FINANCE": (True, False, "true"),
    "GLOBAL_LEADERSHIP": (True, True, "true"),
    "SALES_LEADER": (False, True, "true"),
    "SALES_REP": (False, False, "false"),
    "REGIONAL_MGR_US_EAST": (False, False, "territory = 'US-East'"),
    "REGIONAL_MGR_US_WEST": (False, False, "territory = 'US-West'"),
    "REGIONAL_MGR_CA_EAST": (False, False, "territory = 'Canada-East'"),
    "REGIONAL_MGR_CA_WEST": (False, False, "territory = 'Canada-West'"),
}
for name, (mail, phone, rows) in SEEN.items():
    hidden = {"email": "email", "address": "address_line1"} if not mail else {}
    hidden |= {"phone": "phone"} if not phone else {}
    swaps = [f"{MASK[m]} AS {c}" for m, c in hidden.items()]
    swaps.append(f"{dbl('credit_limit_usd')} AS credit_limit_usd")
    add(f"rls_{name.lower()}",
        f"SELECT * REPLACE ({', '.join(swaps)}) FROM customers WHERE {rows}")
_NO_PHONE_MASK = {**MASK, "phone": "phone"}
add("rls_group_fallback", f"""
SELECT {DIRECTORY.format(**_NO_PHONE_MASK)} FROM customers WHERE territory = 'Canada-East'""")
add("rls_unknown_persona", f"""
SELECT territory, {big('count(*)')} AS customers, CAST(0 AS BIGINT) AS visible
FROM customers GROUP BY territory""")
add("rls_admin_group_policy", f"SELECT {EMPLOYEE} FROM employees")
add("persona_active", """
SELECT user_email, arg_max(persona, (set_at, persona)) AS persona, max(set_at) AS set_at
FROM b_personas GROUP BY user_email""")
add("persona_set", """
, changed AS (
  SELECT 'user' || user_id || '@example.com' AS user_email, max(ts) AS set_at
  FROM events WHERE event_type = 'signup' GROUP BY ALL)
SELECT user_email, 'SALES_REP' AS persona, set_at FROM changed
UNION ALL
SELECT * FROM b_personas WHERE user_email NOT IN (SELECT user_email FROM changed)""")
add("persona_invalid", "SELECT * FROM b_personas WHERE persona = 'INTERN'")
GROUP_GRANTS = {
    "hr": ["see:email", "see:phone", "see:address", "see:ssn", "see:salary"],
    "finance": ["see:email", "see:address", "see:salary"],
    "sales_leader": ["see:phone"],
    "global_leadership": ["rows:*"],
    "us_east": ["rows:US-East"], "us_west": ["rows:US-West"],
    "canada_east": ["rows:Canada-East"], "canada_west": ["rows:Canada-West"],
}
_PAIRS = ", ".join(f"('{g}', '{p}')" for g, held in GROUP_GRANTS.items() for p in held)
_NAMES = ", ".join(f"'{g}'" for g in [
    "hr", "finance", "sales_leader", "global_leadership", "us_east", "us_west", "canada_east",
    "canada_west", "visitors"])
add("gov_user_privileges", f"""
SELECT DISTINCT 'user' || user_id || '@example.com' AS user_email, privilege
FROM events JOIN (VALUES {_PAIRS}) AS g(grp, privilege)
  ON grp = ([{_NAMES}])[CAST(user_id + floor(value) AS BIGINT) % 9 + 1]""")
_MATRIX = []
for name, (mail, phone, rows) in SEEN.items():
    def seen(column: str, open_: bool, where: str = rows) -> str:
        return f"(SELECT {big(f'count({column})')} FROM customers WHERE {where})" if open_ else "0"

    def staff(column: str, open_: bool) -> str:
        return f"(SELECT {big(f'count({column})')} FROM employees)" if open_ else "0"

    _MATRIX.append(f"""SELECT '{name}' AS persona,
  {seen('*', True)} AS dim_customer_rows, {big(seen('email', mail))} AS dim_customer_email,
  {big(seen('phone', phone))} AS dim_customer_phone,
  {big(seen('address_line1', mail))} AS dim_customer_address_line1,
  {staff('*', True)} AS dim_employee_rows, {big(staff('ssn', name == 'HR'))} AS dim_employee_ssn,
  {big(staff('annual_salary_usd', name in ('HR', 'FINANCE')))} AS dim_employee_annual_salary_usd,
  (SELECT {big('count(*)')} FROM gl WHERE {rows}) AS fact_gl_transactions_rows""")
add("gov_matrix", "\nUNION ALL\n".join(_MATRIX))
add("gov_metric_regional", metric(["Territory"], ["Net Revenue", "Line Count"], rows="""
(SELECT * REPLACE (CASE territory WHEN 'US-East' THEN territory END AS territory) FROM metric)"""))
add("gov_dashboard_regional", f"""
SELECT customer_segment, territory, {dbl('sum(lifetime_revenue_usd)')} AS lifetime_revenue
FROM c360 WHERE territory = 'US-East' GROUP BY ALL""")

# --- dashboards ---------------------------------------------------------------------------

add("ds_invoices", f"""
SELECT {doubled(FACT_MONEY + ['credit_limit_usd', 'unit_cost_usd',
                                           'estimated_cogs_usd', 'estimated_gross_margin_usd'])
        .replace('* REPLACE', '* EXCLUDE (currency) REPLACE')} FROM d_invoices""")
add("ds_gl", f"""
SELECT voucher_id, transaction_date, gl_month, gl_quarter, gl_year, gl_account, gl_description,
  gl_category, business_unit, territory, {dbl('amount_usd_signed')} AS amount_usd_signed,
  {dbl('amount_usd')} AS amount_usd_raw
FROM d_gl""")
add("ds_web", "SELECT * FROM d_web")
add("ds_crm", f"SELECT {doubled(['amount_usd'])} FROM d_crm")
add("ds_customers_360", f"SELECT {doubled(C360_MONEY)} FROM c360")
add("ds_ar", f"SELECT {doubled(['outstanding_usd'])} FROM d_ar")


def tile(dataset: str, dims: str, measures: str, rest: str = "", where: str = "true") -> str:
    columns = f"{dims}, {measures}" if dims else measures
    group = f" GROUP BY {dims}" if dims else ""
    return f"SELECT {columns} FROM d_{dataset} WHERE {where}{group} {rest}"


_REV = f"{dbl(_NET)} AS net_revenue"
_GMU = f"{dbl('sum(estimated_gross_margin_usd)')} AS gross_margin"
_AVG = f"{dbl(_NET)} / count(*) AS avg_line_value"
_DPC = f"{dbl('-sum(discount_amount)')} / nullif({dbl(_GROSS)}, 0) AS discount_pct"
_AMT = dbl("sum(amount_usd_signed)")
_OUT = f"{dbl('sum(outstanding_usd)')} AS outstanding"
_QUO = big("count(*) FILTER (WHERE event_name = 'request_quote')") + " AS quote_requests"


def distinct(column: str, name: str) -> str:
    return f"{big(f'count(DISTINCT {column})')} AS {name}"


def where_sum(category: str, name: str, sign: str = "") -> str:
    return dbl(f"sum(CASE gl_category WHEN '{category}' THEN {sign}amount_usd ELSE 0 END)") \
        + f" AS {name}"


_ROWS = big("count(*)")
TILES = {
    "executive": {
        "net_revenue": tile("invoices", "", _REV),
        "gross_margin": tile("invoices", "", _GMU),
        "active_customers": tile("invoices", "", distinct("customer_key", "customers")),
        "invoices": tile("invoices", "", distinct("invoice_id", "invoices")),
        "open_pipeline": tile("crm", "", dbl(
            "sum(CASE deal_outcome WHEN 'OPEN' THEN amount_usd ELSE 0 END)")
            + " AS open_pipeline"),
        "avg_line_value": tile("invoices", "", _AVG),
        "revenue_by_month_system": tile("invoices", "invoice_month, source_system", _REV),
        "revenue_by_line": tile("invoices", "product_line", _REV),
        "revenue_by_territory": tile("invoices", "territory", _REV),
        "revenue_by_segment": tile("invoices", "customer_segment", _REV),
        "margin_by_line_tier": tile("invoices", "product_line, product_tier", _GMU),
    },
    "sales": {
        "invoices": tile("invoices", "", distinct("invoice_id", "invoices")),
        "avg_line_value": tile("invoices", "", _AVG),
        "discount_pct": tile("invoices", "", _DPC),
        "deals": tile("crm", "", distinct("deal_id", "deals")),
        "win_rate": tile("crm", "", dbl("count(*) FILTER (WHERE deal_outcome = 'WON')")
                         + " / nullif(count(*) FILTER (WHERE deal_outcome <> 'OPEN'), 0)"
                         + " AS win_rate"),
        "products_sold": tile("invoices", "", distinct("product_key", "products")),
        "revenue_by_month_territory": tile("invoices", "invoice_month, territory", _REV),
        "deals_by_outcome": tile("crm", "deal_outcome", f"{_ROWS} AS deals"),
        "top_customers": tile("invoices", "customer_name", _REV,
                              f"ORDER BY {_NET} DESC, customer_name LIMIT 15"),
        "pipeline_by_stage": tile("crm", "deal_stage", f"{dbl('sum(amount_usd)')} AS pipeline"),
        "discount_pct_by_month": tile("invoices", "invoice_month", _DPC),
    },
    "finance": {
        "revenue": tile("gl", "", where_sum("REVENUE", "revenue", "-")),
        "cogs": tile("gl", "", where_sum("COGS", "cogs")),
        "opex": tile("gl", "", where_sum("OPEX", "opex")),
        "capex": tile("gl", "", where_sum("CAPEX", "capex")),
        "ar_outstanding": tile("ar", "", _OUT),
        "gl_rows": tile("gl", "", f"{_ROWS} AS gl_rows"),
        "amount_by_month_category": tile("gl", "gl_month, gl_category", f"{_AMT} AS amount"),
        "revenue_by_year": tile("gl", "gl_year", where_sum("REVENUE", "revenue", "-")),
        "amount_by_unit_category": tile("gl", "business_unit, gl_category", f"{_AMT} AS amount"),
        "ar_by_bucket_territory": tile("ar", "aging_bucket, territory", _OUT),
        "gl_accounts": tile("gl", "gl_account, gl_description, gl_category",
                            f"{_AMT} AS net_amount"),
    },
    "marketing": {
        "sessions": tile("web", "", distinct("session_id", "sessions")),
        "visitors": tile("web", "", distinct("user_pseudo_id", "visitors")),
        "lead_events": tile("web", "", big("count(*) FILTER (WHERE is_lead_event)")
                            + " AS lead_events"),
        "quote_requests": tile("web", "", _QUO),
        "lead_conversion": tile("web", "", dbl("count(*) FILTER (WHERE is_lead_event)")
                                + " / nullif(count(*), 0) AS lead_conversion"),
        "campaigns": tile("web", "", distinct("campaign", "campaigns")),
        "sessions_by_month_source": tile("web", "session_month, traffic_source",
                                         distinct("session_id", "sessions")),
        "events_by_device": tile("web", "device_category", f"{_ROWS} AS events"),
        "quotes_by_campaign": tile("web", "campaign", _QUO),
        "event_funnel": tile("web", "event_name", f"{_ROWS} AS events"),
        "sessions_by_place": tile("web", "country, territory",
                                  distinct("session_id", "sessions")),
    },
    "customer": {
        "customers": tile("customers_360", "", f"{_ROWS} AS customers"),
        "active_customers": tile("customers_360", "",
                                 big("count(*) FILTER (WHERE is_active)") + " AS customers"),
        "at_risk": tile("customers_360", "", big(
            "count(*) FILTER (WHERE coalesce(days_since_last_invoice, 1000) > 90)")
            + " AS customers"),
        "open_pipeline": tile("customers_360", "",
                              f"{dbl('sum(open_pipeline_usd)')} AS open_pipeline"),
        "credit_limit": tile("customers_360", "",
                             f"{dbl('sum(credit_limit_usd)')} AS credit_limit"),
        "avg_ltv": tile("customers_360", "",
                        f"{dbl('sum(lifetime_revenue_usd)')} / count(*) AS avg_ltv"),
        "ltv_by_segment_territory": tile(
            "customers_360", "customer_segment, territory",
            f"{dbl('sum(lifetime_revenue_usd)')} AS lifetime_revenue"),
        "pipeline_by_segment": tile("customers_360", "customer_segment",
                                    f"{dbl('sum(open_pipeline_usd)')} AS open_pipeline"),
        "ar_by_bucket_segment": tile("ar", "aging_bucket, customer_segment", _OUT),
        "customer_detail": f"""
SELECT customer_name, customer_segment, territory, country,
  {dbl('lifetime_revenue_usd')} AS lifetime_revenue_usd, lifetime_invoices,
  {dbl('open_pipeline_usd')} AS open_pipeline_usd, {dbl('credit_limit_usd')} AS credit_limit_usd,
  days_since_last_invoice
FROM c360""",
    },
}
for page, tiles in TILES.items():
    for name, sql in tiles.items():
        add(f"dash_{page}_{name}", sql)

# the example selections of the pages, as conditions
_SEGMENTS = "customer_segment IN ('HOMEOWNER', 'COMMERCIAL')"
SELECTED = {
    "executive": {
        "invoice_date": "invoice_date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31'",
        "territory": "territory IN ('US-East', 'Canada-West')",
        "product_line": "product_line IN ('Pavers', 'Slabs', 'Other')",
    },
    "sales": {
        "customer_segment": "customer_segment = 'CONTRACTOR'",
        "territory": "territory = 'US-West'",
        "lead_source": "lead_source IN ('Referral', 'Web Form')",
    },
    "finance": {
        "gl_year": "gl_year IN (1999, 2000)",
        "gl_category": "gl_category IN ('REVENUE', 'COGS')",
        "territory": "territory IN ('US-East', 'Canada-East')",
    },
    "marketing": {
        "session_date": "session_date >= DATE '2024-01-10'",
        "traffic_source": "traffic_source IN ('google', 'houzz', 'email')",
        "country": "country = 'Canada'",
    },
    "customer": {
        "territory": "(territory IN ('US-East') OR territory IS NULL)",
        "customer_segment": _SEGMENTS,
    },
}
CONTROLS = {
    "executive": {
        "invoice_date": ["invoices"],
        "territory": ["invoices", "ar", "customers_360", "crm"],
        "customer_segment": ["invoices", "ar", "customers_360"],
        "source_system": ["invoices"], "product_line": ["invoices"],
    },
    "sales": {
        "invoice_date": ["invoices"], "territory": ["invoices", "customers_360", "crm"],
        "customer_segment": ["invoices", "customers_360"], "product_line": ["invoices"],
        "lead_source": ["crm"],
    },
    "finance": {
        "transaction_date": ["gl"], "gl_year": ["gl"], "gl_category": ["gl"],
        "business_unit": ["gl"], "territory": ["gl", "ar"],
    },
    "marketing": {
        "session_date": ["web"], "traffic_source": ["web"], "traffic_medium": ["web"],
        "campaign": ["web"], "country": ["web"],
    },
    "customer": {
        "territory": ["customers_360", "ar"], "customer_segment": ["customers_360", "ar"],
        "country": ["customers_360", "ar"],
    },
}


def active(page: str, dataset: str, but: str | None = None) -> str:
    conditions = [
        sql for column, sql in SELECTED[page].items()
        if column != but and dataset in CONTROLS[page][column]
    ]
    return " AND ".join(conditions) or "true"


for page, controls in CONTROLS.items():
    for column, datasets in controls.items():
        add(f"flt_{page}_{column}", "\nUNION ALL\n".join(
            f"SELECT '{d}' AS dataset, CAST({column} AS VARCHAR) AS option, "
            f"{big(f'count(*) FILTER (WHERE {active(page, d, column)})')} AS associativity "
            f"FROM d_{d} GROUP BY {column}"
            for d in datasets))
add("flt_range_and_values", tile("invoices", "product_line, product_tier", _GMU,
                                 where=active("executive", "invoices")))
add("flt_values", tile("gl", "gl_month, gl_category", f"{_AMT} AS amount",
                       where=active("finance", "gl")))
add("flt_one_of_several_datasets", TILES["executive"]["open_pipeline"].replace(
    "WHERE true", f"WHERE {active('executive', 'crm')}"))
add("flt_with_null", tile("ar", "aging_bucket, customer_segment", _OUT,
                          where=active("customer", "ar")))
add("flt_open_range", tile("web", "event_name", f"{_ROWS} AS events",
                           where=active("marketing", "web")))

# whole pages and all their controls, in long form
for page, tiles in TILES.items():
    parts = []
    for name, sql in tiles.items():
        if name == "customer_detail":  # lists rows, has no measure
            continue
        held = sql.split("GROUP BY ")
        dims = held[1].split("ORDER BY")[0].strip() if len(held) > 1 else ""
        place = ", ".join(f"coalesce(CAST({d.strip()} AS VARCHAR), 'null')" for d in dims.split(",")) \
            if dims else "''"
        measure = re.findall(r" AS (\w+)", sql.split("GROUP BY")[0])[-1]  # each tile has one
        parts.append(
            f"SELECT '{name}' AS tile, concat_ws('|', {place}) AS place, '{measure}' AS measure, "
            f"CAST({measure} AS DOUBLE) AS value FROM ({sql})"
        )
    add(f"page_{page}", "\nUNION ALL\n".join(parts))
for page, controls in CONTROLS.items():
    add(f"facets_{page}", "\nUNION ALL\n".join(
        f"SELECT '{column}' AS control, '{d}' AS dataset, CAST({column} AS VARCHAR) AS option, "
        f"{big(f'count(*) FILTER (WHERE {active(page, d, column)})')} AS associativity "
        f"FROM d_{d} GROUP BY {column}"
        for column, datasets in controls.items() for d in datasets))

# a stored and reopened lakehouse, and its published tables under two personas
ORACLE["lake_reopened_summary"] = ORACLE["gold_sales_summary"]
ORACLE["lake_published_customers"] = "\nUNION ALL\n".join(
    f"SELECT '{p}' AS persona, customer_key, email, phone, territory FROM ({ORACLE[f'rls_{p.lower()}']})"
    for p in ("HR", "REGIONAL_MGR_US_EAST"))
