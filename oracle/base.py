"""The landed and conformed tables once more, as common table expressions over the raw views.

Money is DECIMAL until a result leaves as DOUBLE, as in the library.
"""

from __future__ import annotations

from lakehouse_kpis.sources import fixed


def text_key(prefix: str, number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest(length({digits}), {width}) AS INTEGER), '0')"


def choose(values: list[str], index: str) -> str:
    options = ", ".join(f"'{v}'" for v in values)
    return f"([{options}])[CAST({index} AS BIGINT) % {len(values)} + 1]"


def mapped(column: str, names: dict[str, str], default: str | None = None) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    other = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {column} {cases}{other} END"


def dec(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def cents(expression: str) -> str:
    """Exact DECIMAL rounded to whole cents, halves away from zero."""
    return f"CAST(round({expression}, 2) AS DECIMAL(18,2))"


GROUPS = {
    "STANDARD": "PAV", "SMALL": "SLB", "MEDIUM": "RTW", "LARGE": "PCP", "ECONOMY": "FIR",
}
SEGMENTS = {
    "MACHINERY": "CONTRACTOR", "AUTOMOBILE": "CONTRACTOR", "FURNITURE": "COMMERCIAL",
}
TERRITORY = "CASE n_regionkey " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(fixed.TERRITORIES)
) + " END"
UNIT_COST = cents("CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1))")
ACCOUNT_NAMES = {a: d for a, d, _ in fixed.GL_ACCOUNTS}
GL_ACCOUNT = f"""CASE category
    WHEN 'REVENUE' THEN {mapped('p_type', {'SMALL': '4020', 'MEDIUM': '4030', 'ECONOMY': '4040'}, '4010')}
    WHEN 'REVENUE_CONTRA' THEN '4101'
    WHEN 'COGS' THEN {choose(['5010', '5020', '5030'], 'l_linenumber')}
    WHEN 'OPEX' THEN {choose(['5210', '5220', '6010', '6020', '6030'], 'l_linenumber')}
    ELSE '7010' END"""
POSTING = "SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, p_type"
POSTING_FROM = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey"""
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"


def charge(code: str) -> str:
    return f"CAST(coalesce(sum(value) FILTER (WHERE code = '{code}'), 0) AS DECIMAL(18,2))"


LANDED = f"""
b_products AS (
  SELECT {text_key('ITM', 'p_partkey', 6)} AS item, p_name AS name,
    {mapped('p_type', GROUPS, 'XXX')} AS grp,
    CASE WHEN p_partkey % 7 = 0 THEN 'Premium' WHEN p_partkey % 3 = 0 THEN 'Standard'
      ELSE 'Core' END AS tier,
    {UNIT_COST} AS cost, {dec('p_retailprice')} AS price,
    CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS off,
    CAST(DATE '1994-01-01' + CAST(p_size * 30 AS INTEGER) AS TIMESTAMP) AS made
  FROM part),
b_customers AS (
  SELECT {text_key('CUST', 'c_custkey', 6)} AS account, c_name AS name,
    CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN 'unlisted'
      ELSE ' Buyer' || c_custkey || '@' ||
        {choose(['mail.example.com', 'post.example.com', 'pro.example.com'], 'c_custkey')}
      END AS email,
    regexp_replace(lpad(CAST(CAST(c_custkey AS BIGINT) * 6700417 % 10000000 AS VARCHAR), 7, '0'),
      '^(...)(....)$', '+1-555-\\1-\\2') AS phone,
    {choose(['Harbour', 'Lantern', 'Meadow', 'Quarry', 'Saddle', 'Tannery', 'Willow'], 'c_custkey')}
      || ' Lane ' || (c_custkey % 240 * 2 + 1) AS street,
    n_name AS city,
    CASE n_regionkey WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' WHEN 2 THEN 'QC' WHEN 3 THEN 'BC' END
      AS state,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
      AS zip,
    CASE WHEN n_regionkey < 2 THEN 'US' WHEN n_regionkey < 4 THEN 'CA' END AS country,
    {TERRITORY} AS territory,
    {mapped('c_mktsegment', SEGMENTS, 'HOMEOWNER')} AS segment,
    CASE WHEN {dec('c_acctbal')} < -990 THEN 1 ELSE 0 END AS blocked,
    {dec('c_acctbal')} AS credit,
    CAST(DATE '1994-12-31' - CAST(c_custkey % 1009 AS INTEGER) AS TIMESTAMP) AS created,
    CAST(DATE '2000-06-30' - CAST(c_custkey % 613 AS INTEGER) AS TIMESTAMP) AS modified
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
b_lines AS (
  SELECT {text_key('INV-D-', 'l_orderkey', 7)} AS invoice, CAST(l_linenumber AS INTEGER) AS num,
    {text_key('CUST', 'o_custkey', 6)} AS account, {text_key('ITM', 'l_partkey', 6)} AS item,
    CAST(o_orderdate AS DATE) + CAST(l_linenumber AS INTEGER) AS day,
    CAST(l_quantity AS INTEGER) AS qty,
    -- amount / quantity in whole cents, halves up, in integers
    CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
      // (CAST(l_quantity AS BIGINT) * 2) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
      AS DECIMAL(18,2)) AS price,
    {dec('l_extendedprice')} AS amount,
    {cents(f'{PRICE} * CAST(l_tax AS DECIMAL(4,2))')} AS tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
b_charged AS (
  SELECT {text_key('INV-D-', 'o_orderkey', 7)} AS invoice, o_orderdate AS posted,
    CAST(o_totalprice AS DECIMAL(14,2)) AS whole,
    CAST(left(o_orderpriority, 1) AS INTEGER) * 2 AS pct
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
b_markups AS (
  SELECT invoice, posted, 'FREIGHT' AS code,
    {cents('whole * CAST(0.02 AS DECIMAL(3,2))')} AS value FROM b_charged
  UNION ALL
  SELECT invoice, posted, 'DISCOUNT',
    -{cents('whole * CAST(pct AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2))')} FROM b_charged
  UNION ALL
  SELECT invoice, posted, 'PALLET', CAST(45.00 AS DECIMAL(18,2)) FROM b_charged),
b_headers AS (
  SELECT {text_key('INV-A-', 'o_orderkey', 7)} AS invoice,
    {text_key('CUST', 'o_custkey', 6)} AS account,
    {text_key('ITM', '(o_custkey * (o_orderkey % 2 + 1))', 6)} AS item,
    CAST(o_orderdate AS DATE) AS day, {dec('o_totalprice')} AS amount,
    {cents('CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.08 AS DECIMAL(3,2))')} AS tax,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS posted
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
b_postings AS (
  {POSTING}, 'REVENUE' AS category, -{dec('l_extendedprice')} AS amount {POSTING_FROM}
  UNION ALL
  {POSTING}, 'REVENUE_CONTRA', {cents(f'{PRICE} * CAST(l_discount AS DECIMAL(4,2))')}
  {POSTING_FROM}
  UNION ALL
  {POSTING}, 'COGS', CAST(CAST(l_quantity AS INTEGER) * CAST({UNIT_COST} AS DECIMAL(12,2))
    AS DECIMAL(18,2)) {POSTING_FROM}
  UNION ALL
  {POSTING}, 'OPEX', {cents(f'{PRICE} * CAST(l_tax AS DECIMAL(4,2))')} {POSTING_FROM}
  UNION ALL
  {POSTING}, 'CAPEX', {dec('l_extendedprice')} {POSTING_FROM}
  WHERE o_orderstatus = 'P' AND l_linenumber = 1),
b_gl AS (
  SELECT {text_key('VCH-', 'l_orderkey', 8)} AS voucher, CAST(o_orderdate AS DATE) AS day,
    {GL_ACCOUNT} AS account, category, amount,
    CASE WHEN l_orderkey % 18 < 8 THEN 'BU-RES' WHEN l_orderkey % 18 < 14 THEN 'BU-PRO'
      ELSE 'BU-COM' END AS unit,
    {choose(fixed.TERRITORIES, 'l_orderkey')} AS territory
  FROM b_postings),
b_employees AS (
  SELECT {text_key('EMP', 's_suppkey', 5)} AS employee, s_name AS name,
    regexp_replace(lpad(CAST(CAST(s_suppkey AS BIGINT) * 1299709 % 100000000 AS VARCHAR), 8, '0'),
      '^(..)(..)(....)$', '9\\1-\\2-\\3') AS ssn,
    DATE '1997-09-30' - CAST(s_suppkey % 2003 AS INTEGER) AS hired,
    CAST({dec('s_acctbal')} + 50000 AS DECIMAL(18,2)) AS salary,
    {choose([c for c, _ in fixed.DEPARTMENTS], 's_suppkey')} AS dept_code,
    {choose([n for _, n in fixed.DEPARTMENTS], 's_suppkey')} AS dept,
    'staff' || s_suppkey || '@example.com' AS email, {TERRITORY} AS territory,
    CASE WHEN {dec('s_acctbal')} < -900 THEN 'TERMINATED' ELSE 'ACTIVE' END AS status
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
b_deals AS (
  SELECT {text_key('HS-', 'o_orderkey', 7)} AS deal,
    'Deal - Project ' || o_orderkey AS name, {dec('o_totalprice')} AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'closedwon' WHEN 'P' THEN 'closedlost'
      ELSE {choose(fixed.OPEN_STAGES, 'o_orderkey')} END AS stage,
    {text_key('CUST', 'o_custkey', 6)} AS account, CAST(o_orderdate AS DATE) AS created,
    {choose(fixed.TERRITORIES, 'o_orderkey')} AS territory,
    {choose(fixed.LEAD_SOURCES, 'CAST(left(o_orderpriority, 1) AS INTEGER)')} AS lead
  FROM orders),
b_sessions AS (
  SELECT {text_key('SES-', 'event_id', 9)} AS session, {text_key('U-', 'user_id', 6)} AS visitor,
    CAST(ts AS DATE) AS day, {choose(fixed.TRAFFIC_SOURCES, 'event_id')} AS source,
    {choose(fixed.TRAFFIC_MEDIA, 'event_id')} AS medium,
    {choose(fixed.CAMPAIGNS, 'event_id')} AS campaign,
    {choose(fixed.DEVICES, 'event_id')} AS device,
    CASE WHEN user_id % 4 < 2 THEN 'United States' ELSE 'Canada' END AS country,
    {choose(fixed.TERRITORIES, 'user_id')} AS territory,
    {text_key('ITM', '(user_id * (event_id % 5 + 1))', 6)} AS item,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_inspiration'
      WHEN 'signup' THEN 'contact_form' WHEN 'error' THEN 'find_dealer'
      WHEN 'purchase' THEN 'request_quote' END AS event
  FROM events),
b_personas AS (
  SELECT 'user' || user_id || '@example.com' AS user_email,
    {choose([*fixed.PERSONAS, 'INTERN'], 'event_id')} AS persona, ts AS set_at
  FROM events)"""

CONFORMED = f"""
customers AS (
  SELECT account AS customer_key, name AS customer_name, lower(trim(email)) AS email, phone,
    street AS address_line1, city, state AS state_province, zip AS postal_code, country,
    territory, segment AS customer_segment, blocked = 0 AS is_active,
    credit AS credit_limit_usd, created AS created_at, modified AS modified_at
  FROM b_customers),
products AS (
  SELECT item AS product_key, name AS product_name, grp AS product_line_code,
    {mapped('grp', fixed.PRODUCT_LINES, 'Other')} AS product_line, tier AS product_tier,
    {mapped('grp', fixed.SALES_UNITS, 'each')} AS unit_of_measure, cost AS unit_cost_usd,
    price AS list_price_usd, off = 0 AS is_active, made AS created_at
  FROM b_products),
employees AS (
  SELECT employee AS employee_key, name AS full_name, ssn, salary AS annual_salary_usd,
    hired AS hire_date, dept_code AS department_code, dept AS department,
    email AS work_email, territory, status
  FROM b_employees),
pivot_charges AS (
  SELECT invoice, {charge('FREIGHT')} AS freight, {charge('DISCOUNT')} AS discount,
    {charge('PALLET')} AS pallet
  FROM b_markups GROUP BY invoice),
all_lines AS (
  SELECT invoice, num, day, account, item, qty, price, amount, tax, 'D365_FO' AS system
  FROM b_lines
  UNION ALL
  SELECT invoice, 1, day, account, item, 1, amount, amount, tax, 'AX_2012' FROM b_headers),
fact AS (
  SELECT invoice AS invoice_id, num AS line_num, day AS invoice_date,
    account AS customer_key, item AS product_key, qty AS quantity,
    price AS unit_sales_price, amount AS gross_line_amount,
    coalesce(freight, 0) AS freight_amount, coalesce(discount, 0) AS discount_amount,
    coalesce(pallet, 0) AS pallet_amount,
    amount + coalesce(freight, 0) + coalesce(discount, 0) + coalesce(pallet, 0)
      AS net_invoice_amount,
    tax AS tax_amount, 'USD' AS currency, system AS source_system
  FROM all_lines LEFT JOIN pivot_charges USING (invoice)),
gl AS (
  SELECT voucher AS voucher_id, day AS transaction_date, account AS gl_account,
    {mapped('account', ACCOUNT_NAMES)} AS gl_description, category AS gl_category,
    amount AS amount_usd, 'USD' AS currency, unit AS business_unit, territory
  FROM b_gl),
web AS (
  SELECT session AS session_id, visitor AS user_pseudo_id, day AS session_date,
    source AS traffic_source, medium AS traffic_medium, campaign, device AS device_category,
    country, territory, item AS product_key, event AS event_name,
    event IN ('contact_form', 'request_quote', 'find_dealer') AS is_lead_event
  FROM b_sessions),
deals AS (
  SELECT deal AS deal_id, name AS deal_name, amount AS amount_usd, stage AS deal_stage,
    CASE stage WHEN 'closedwon' THEN 'WON' WHEN 'closedlost' THEN 'LOST' ELSE 'OPEN' END
      AS deal_outcome,
    account AS customer_key, created AS created_at, territory, lead AS lead_source
  FROM b_deals)"""

AGE = "date_diff('day', invoice_date, DATE '2001-08-31')"
BUCKET = f"""CASE WHEN {AGE} <= 30 THEN '0-30' WHEN {AGE} <= 60 THEN '31-60'
    WHEN {AGE} <= 90 THEN '61-90' WHEN {AGE} <= 180 THEN '91-180'
    WHEN {AGE} <= 365 THEN '181-365' ELSE '365+' END"""

MARTS = f"""
aging AS (
  SELECT customer_key, {BUCKET} AS aging_bucket,
    {big('count(DISTINCT invoice_id)')} AS invoice_count,
    sum(net_invoice_amount) AS outstanding_usd
  FROM fact GROUP BY ALL),
per_customer AS (
  SELECT customer_key, count(DISTINCT invoice_id) AS n, sum(net_invoice_amount) AS revenue,
    max(invoice_date) AS last_day
  FROM fact GROUP BY customer_key),
per_account AS (
  SELECT customer_key, count(*) AS n,
    sum(CASE deal_outcome WHEN 'WON' THEN amount_usd ELSE 0 END) AS won,
    sum(CASE deal_outcome WHEN 'OPEN' THEN amount_usd ELSE 0 END) AS open
  FROM deals GROUP BY customer_key),
c360 AS (
  SELECT c.customer_key, customer_name, customer_segment, territory, country, is_active,
    credit_limit_usd, {big('coalesce(s.n, 0)')} AS lifetime_invoices,
    coalesce(revenue, 0) AS lifetime_revenue_usd, last_day AS last_invoice_date,
    {big('coalesce(d.n, 0)')} AS lifetime_deals, coalesce(won, 0) AS won_pipeline_usd,
    coalesce(open, 0) AS open_pipeline_usd,
    CAST(date_diff('day', last_day, DATE '2001-08-31') AS INTEGER) AS days_since_last_invoice
  FROM customers c LEFT JOIN per_customer s ON s.customer_key = c.customer_key
    LEFT JOIN per_account d ON d.customer_key = c.customer_key),
d_invoices AS (
  SELECT f.*, customer_name, customer_segment, territory, country, c.is_active,
    credit_limit_usd, product_line, product_tier, unit_cost_usd,
    CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
    CAST(date_trunc('quarter', invoice_date) AS DATE) AS invoice_quarter,
    CAST(year(invoice_date) AS INTEGER) AS invoice_year,
    quantity * CAST(unit_cost_usd AS DECIMAL(12,2)) AS estimated_cogs_usd,
    net_invoice_amount - quantity * CAST(unit_cost_usd AS DECIMAL(12,2))
      AS estimated_gross_margin_usd
  FROM fact f JOIN customers c ON c.customer_key = f.customer_key
    JOIN products p ON p.product_key = f.product_key),
d_gl AS (
  SELECT *, CAST(date_trunc('month', transaction_date) AS DATE) AS gl_month,
    CAST(date_trunc('quarter', transaction_date) AS DATE) AS gl_quarter,
    CAST(year(transaction_date) AS INTEGER) AS gl_year,
    CASE gl_category WHEN 'REVENUE' THEN -amount_usd ELSE amount_usd END AS amount_usd_signed,
    amount_usd AS amount_usd_raw
  FROM gl),
d_web AS (SELECT *, CAST(date_trunc('month', session_date) AS DATE) AS session_month FROM web),
d_crm AS (SELECT *, CAST(date_trunc('month', created_at) AS DATE) AS deal_month FROM deals),
d_customers_360 AS (SELECT * FROM c360),
d_ar AS (
  SELECT a.*, territory, customer_segment, country
  FROM aging a JOIN customers c ON c.customer_key = a.customer_key),
wide AS (
  SELECT f.*, c.territory, c.country, c.customer_segment, p.product_line, p.product_tier,
    quantity * CAST(unit_cost_usd AS DECIMAL(12,2)) AS cogs,
    CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
    CAST(year(invoice_date) AS INTEGER) AS invoice_year,
    year(invoice_date) || '-Q' || quarter(invoice_date) AS invoice_quarter
  FROM fact f LEFT JOIN customers c ON c.customer_key = f.customer_key
    LEFT JOIN products p ON p.product_key = f.product_key),
metric AS (SELECT * FROM wide WHERE invoice_date >= DATE '1995-01-01'),
metric_floor AS (SELECT * FROM wide WHERE invoice_date >= DATE '1997-01-01')"""

PRELUDE = f"WITH {LANDED.strip()},{CONFORMED},{MARTS}\n"
