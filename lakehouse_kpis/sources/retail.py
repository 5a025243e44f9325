"""Landed tables bound to the retail star schema (region, nation, customer, part, ...).

Orders before the cutover play the legacy ERP (headers only), orders from the cutover on
play the current ERP (lines and charges). Everything else follows FIXTURES.md. Values are
key arithmetic on the given rows: every row of every used table takes part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import money
from lakehouse_kpis.functions.text import business_key, decode, pick
from lakehouse_kpis.sources import fixed
from lakehouse_kpis.sources.inline import inline
from lakehouse_kpis.sources.shapes import SHAPES, conform

CUTOVER = dt.date(1999, 1, 1)

ITEM_GROUPS = {
    "STANDARD": "PAV", "SMALL": "SLB", "MEDIUM": "RTW", "LARGE": "PCP", "ECONOMY": "FIR",
    "PROMO": "XXX",
}
SEGMENTS = {
    "BUILDING": "HOMEOWNER", "HOUSEHOLD": "HOMEOWNER", "MACHINERY": "CONTRACTOR",
    "AUTOMOBILE": "CONTRACTOR", "FURNITURE": "COMMERCIAL",
}
STATES = ["NY", "CA", "QC", "BC"]
EVENTS = {
    "view": "page_view", "click": "add_to_inspiration", "signup": "contact_form",
    "error": "find_dealer", "purchase": "request_quote",
}
DOMAINS = ["mail.example.com", "post.example.com", "pro.example.com"]
STREETS = ["Harbour", "Lantern", "Meadow", "Quarry", "Saddle", "Tannery", "Willow"]
SOMEBODY = "INTERN"  # a persona outside the domain, so that the domain check finds rows
GROUPS = [
    "hr", "finance", "sales_leader", "global_leadership", "us_east", "us_west",
    "canada_east", "canada_west", "visitors",
]


def item_key(number: Column) -> Column:
    return business_key("ITM", number, 6)


def account_key(number: Column) -> Column:
    return business_key("CUST", number, 6)


def user_key(number: Column) -> Column:
    return F.concat(F.lit("user"), number.cast("string"), F.lit("@example.com"))


def legacy_product_key() -> Column:
    """Product of a header-only invoice, from its account and invoice numbers.

    Doubling the number on every other invoice runs past the last product, so some
    legacy invoices have no product, at any scale.
    """
    account = F.substring("INVOICEACCOUNT", 5, 20).cast("bigint")
    invoice = F.substring("INVOICEID", 7, 20).cast("bigint")
    return item_key(account * (F.pmod(invoice, F.lit(2)) + 1))


def _territory(region: Column) -> Column:
    """NULL for the regions past the fourth."""
    return F.get(F.array(*[F.lit(t) for t in fixed.TERRITORIES]), region)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


class RetailTables:
    def __init__(self, spark: SparkSession, path: str, cutover: dt.date = CUTOVER):
        self.spark, self.path, self.cutover = spark, path.rstrip("/"), cutover
        self._frames: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        if name not in SHAPES:
            raise KeyError(f"unknown landed table {name!r}")
        return conform(getattr(self, f"_{name}")(), name)

    def memberships(self) -> DataFrame:
        """(user_email, group_name) pairs, one per event; groups repeat per user."""
        return self.raw("events").select(
            user_key(F.col("user_id")).alias("user_email"),
            pick(GROUPS, F.col("user_id") + F.floor(F.col("value"))).alias("group_name"),
        )

    def _orders(self, current: bool) -> DataFrame:
        # compared as timestamps so that the filter reaches the parquet scan
        start = F.lit(self.cutover.isoformat()).cast("timestamp_ntz")
        placed = F.col("o_orderdate")
        return self.raw("orders").filter(placed >= start if current else placed < start)

    def _places(self, df: DataFrame, nation_key: str) -> DataFrame:
        nation = self.raw("nation")
        return df.join(nation, df[nation_key] == nation["n_nationkey"], "left")

    def _products(self) -> DataFrame:
        key, group = F.col("p_partkey"), decode(F.col("p_type"), ITEM_GROUPS, "XXX")
        price = money("p_retailprice")
        return self.raw("part").select(
            item_key(key).alias("ITEMID"),
            F.col("p_name").alias("ITEMNAME"),
            group.alias("ITEMGROUPID"),
            F.when(key % 7 == 0, "Premium").when(key % 3 == 0, "Standard").otherwise("Core")
            .alias("PRODUCTSUBTYPE"),
            decode(group, fixed.SALES_UNITS, fixed.OTHER_UNIT).alias("SALESUNIT"),
            _unit_cost().alias("UNITCOST_USD"),
            price.alias("LISTPRICE_USD"),
            _flag(key % 11 == 0).alias("DISCONTINUED"),
            F.date_add(F.lit(dt.date(1994, 1, 1)), F.col("p_size") * 30).alias("CREATEDDATETIME"),
            F.lit("USMF").alias("DATAAREAID"),
        )

    def _customers(self) -> DataFrame:
        key, region = F.col("c_custkey"), F.col("n_regionkey")
        number = key.cast("string")
        email = F.concat(F.lit(" Buyer"), number, F.lit("@"), pick(DOMAINS, key))
        digits = F.lpad((key * 6_700_417 % 10_000_000).cast("string"), 7, "0")
        phone = F.concat(
            F.lit("+1-555-"), F.left(digits, F.lit(3)), F.lit("-"), F.right(digits, F.lit(4))
        )
        street = F.concat(pick(STREETS, key), F.lit(" Lane "), (key % 240 * 2 + 1).cast("string"))
        zone = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
        return self._places(self.raw("customer"), "c_nationkey").select(
            account_key(key).alias("ACCOUNTNUM"),
            F.concat(F.col("c_name"), F.lit(" ")).alias("NAME"),
            F.when(key % 97 == 0, None).when(key % 89 == 0, "unlisted").otherwise(email)
            .alias("EMAIL"),
            phone.alias("PHONE"),
            street.alias("ADDRESS_LINE1"),
            F.col("n_name").alias("CITY"),
            F.get(F.array(*[F.lit(s) for s in STATES]), region).alias("STATE_PROVINCE"),
            F.concat(zone, F.lpad((key % 1000).cast("string"), 3, "0")).alias("POSTAL_CODE"),
            F.when(region < 2, "US").when(region < 4, "CA").alias("COUNTRY"),
            _territory(region).alias("TERRITORY"),
            decode(F.col("c_mktsegment"), SEGMENTS, "HOMEOWNER").alias("CUSTGROUP"),
            _flag(money("c_acctbal") < -990).alias("BLOCKED"),
            money("c_acctbal").alias("CREDITLIMIT_USD"),
            F.date_sub(F.lit(dt.date(1994, 12, 31)), (key % 1009).cast("int"))
            .alias("CREATEDDATETIME"),
            F.date_sub(F.lit(dt.date(2000, 6, 30)), (key % 613).cast("int"))
            .alias("MODIFIEDDATETIME"),
            F.lit("USMF").alias("DATAAREAID"),
        )

    def _invoice_lines(self) -> DataFrame:
        lines = self.raw("lineitem").join(
            self._orders(current=True), F.col("l_orderkey") == F.col("o_orderkey")
        )
        invoice = business_key("INV-D-", F.col("l_orderkey"), 7)
        number = F.col("l_linenumber").cast("int")
        day = F.date_add(F.col("o_orderdate").cast("date"), number)
        quantity, amount = F.col("l_quantity").cast("int"), money("l_extendedprice")
        return lines.select(
            invoice.alias("INVOICEID"),
            number.alias("LINENUM"),
            account_key(F.col("o_custkey")).alias("INVOICEACCOUNT"),
            item_key(F.col("l_partkey")).alias("ITEMID"),
            day.alias("INVOICEDATE"),
            quantity.alias("QTY"),
            F.round(amount / quantity, 2).alias("SALESPRICE"),
            amount.alias("LINEAMOUNT"),
            F.round(amount * money("l_tax"), 2).alias("TAXAMOUNT"),
            F.lit("USD").alias("CURRENCYCODE"),
            F.lit("USMF").alias("DATAAREAID"),
            day.alias("POSTEDDATETIME"),
            F.concat(F.lit("SR"), F.sha1(F.concat(invoice, number.cast("string"))))
            .alias("_SYSROWID"),
            day.alias("_SINKMODIFIEDTIME"),
        )

    def _markups(self) -> DataFrame:
        """Three charges per order."""
        total = money("o_totalprice")
        percent = F.left("o_orderpriority", F.lit(1)).cast("int") * F.lit(2)
        invoice = business_key("INV-D-", F.col("o_orderkey"), 7)
        charges = (
            self._orders(current=True)
            .select(
                invoice.alias("INVOICEID"),
                F.col("o_orderdate").alias("TRANSDATE"),
                F.round(total * F.lit("0.02").cast("decimal(3,2)"), 2).cast("decimal(18,2)")
                .alias("FREIGHT"),
                (-F.round(total * percent * F.lit("0.01").cast("decimal(3,2)"), 2))
                .cast("decimal(18,2)").alias("DISCOUNT"),
                F.lit("45.00").cast("decimal(18,2)").alias("PALLET"),
            )
            .unpivot(
                ["INVOICEID", "TRANSDATE"], ["FREIGHT", "DISCOUNT", "PALLET"],
                "MARKUPCODE", "VALUE",
            )
        )
        return charges.select(
            F.concat(F.lit("MK-"), F.sha1("INVOICEID"), F.lit("-"), F.col("MARKUPCODE"))
            .alias("RECID"),
            "INVOICEID", "MARKUPCODE", "VALUE",
            decode(F.col("MARKUPCODE"), fixed.CHARGE_ACCOUNTS).alias("MARKUPACCOUNT"),
            "TRANSDATE",
            F.lit("USMF").alias("DATAAREAID"),
        )

    def _dimension_values(self) -> DataFrame:
        return inline(self.spark, fixed.DIMENSION_VALUES, list(SHAPES["dimension_values"]))

    def _legacy_headers(self) -> DataFrame:
        amount = money("o_totalprice")
        return self._orders(current=False).select(
            business_key("INV-A-", F.col("o_orderkey"), 7).alias("INVOICEID"),
            account_key(F.col("o_custkey")).alias("INVOICEACCOUNT"),
            F.col("o_orderdate").cast("date").alias("INVOICEDATE"),
            amount.alias("INVOICEAMOUNT"),
            F.round(amount * F.lit("0.08").cast("decimal(3,2)"), 2).alias("SALESTAXAMOUNT"),
            F.lit("USD").alias("CURRENCYCODE"),
            _flag(F.col("o_orderstatus") == "F").alias("POSTED"),
            F.lit("LEG").alias("DATAAREAID"),
        )

    def _gl(self) -> DataFrame:
        """Five ledger postings per order line (capital spend only on the first line of
        a partly shipped order). What the postings share is made before the fan-out."""
        price, number = money("l_extendedprice"), F.col("l_linenumber")
        unit = F.col("l_orderkey") % 18
        revenue = {"STANDARD": "4010", "SMALL": "4020", "MEDIUM": "4030", "ECONOMY": "4040"}
        shared = {
            "VOUCHER": business_key("VCH-", F.col("l_orderkey"), 8),
            "TRANSDATE": F.col("o_orderdate").cast("date"),
            "DIM_BUSINESS_UNIT": F.when(unit < 8, "BU-RES").when(unit < 14, "BU-PRO")
            .otherwise("BU-COM"),
            "DIM_TERRITORY": pick(fixed.TERRITORIES, F.col("l_orderkey")),
            "revenue_account": decode(F.col("p_type"), revenue, "4010"),
            "cogs_account": pick(["5010", "5020", "5030"], number),
            "opex_account": pick(["5210", "5220", "6010", "6020", "6030"], number),
        }
        amounts = {
            "REVENUE": money(-price),
            "REVENUE_CONTRA": money(F.round(price * money("l_discount"), 2)),
            "COGS": money(F.col("l_quantity").cast("int") * _unit_cost()),
            "OPEX": money(F.round(price * money("l_tax"), 2)),
            "CAPEX": F.when((F.col("o_orderstatus") == "P") & (number == 1), price),
        }
        category = F.col("GL_CATEGORY")
        account = (
            F.when(category == "REVENUE", F.col("revenue_account"))
            .when(category == "REVENUE_CONTRA", "4101")
            .when(category == "COGS", F.col("cogs_account"))
            .when(category == "OPEX", F.col("opex_account"))
            .otherwise("7010")
        )
        chart = inline(
            self.spark, [(code, name) for code, name, _ in fixed.GL_ACCOUNTS],
            ["ACCOUNTNUM", "GL_DESCRIPTION"],
        )
        return (
            self.raw("lineitem")
            .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(*[c.alias(n) for n, c in {**shared, **amounts}.items()])
            .unpivot(list(shared), list(amounts), "GL_CATEGORY", "AMOUNTMST")
            .filter("AMOUNTMST IS NOT NULL")
            .withColumn("ACCOUNTNUM", account)
            .join(chart, "ACCOUNTNUM", "left")
            .withColumns({"CURRENCYCODE": F.lit("USD"), "DATAAREAID": F.lit("LEG")})
        )

    def _employees(self) -> DataFrame:
        key = F.col("s_suppkey")
        # numbers from 900 on are never given out
        digits = F.lpad((key * 1_299_709 % 100_000_000).cast("string"), 8, "0")
        ssn = F.concat(
            F.lit("9"), F.left(digits, F.lit(2)), F.lit("-"), F.substring(digits, 3, 2),
            F.lit("-"), F.right(digits, F.lit(4)),
        )
        return self._places(self.raw("supplier"), "s_nationkey").select(
            business_key("EMP", key, 5).alias("EMPLOYEE_ID"),
            F.col("s_name").alias("FULL_NAME"),
            ssn.alias("SSN"),
            F.date_sub(F.lit(dt.date(1997, 9, 30)), (key % 2003).cast("int")).alias("HIRE_DATE"),
            (money("s_acctbal") + F.lit(50000)).alias("ANNUAL_SALARY"),
            pick([code for code, _ in fixed.DEPARTMENTS], key).alias("DEPARTMENT_CODE"),
            pick([name for _, name in fixed.DEPARTMENTS], key).alias("DEPARTMENT"),
            F.concat(F.lit("staff"), key.cast("string"), F.lit("@example.com"))
            .alias("WORK_EMAIL"),
            _territory(F.col("n_regionkey")).alias("TERRITORY"),
            F.when(money("s_acctbal") < -900, "TERMINATED").otherwise("ACTIVE").alias("STATUS"),
        )

    def _deals(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        stage = (
            F.when(status == "F", fixed.WON_STAGE)
            .when(status == "P", fixed.LOST_STAGE)
            .otherwise(pick(fixed.OPEN_STAGES, key))
        )
        return self.raw("orders").select(
            business_key("HS-", key, 7).alias("DEAL_ID"),
            F.concat(F.lit("Deal - Project "), key.cast("string")).alias("DEAL_NAME"),
            money("o_totalprice").alias("AMOUNT_USD"),
            stage.alias("DEALSTAGE"),
            account_key(F.col("o_custkey")).alias("ASSOCIATED_ACCOUNTNUM"),
            F.col("o_orderdate").cast("date").alias("CREATED_AT"),
            pick(fixed.TERRITORIES, key).alias("TERRITORY"),
            pick(fixed.LEAD_SOURCES, F.left("o_orderpriority", F.lit(1)).cast("int"))
            .alias("LEAD_SOURCE"),
        )

    def _sessions(self) -> DataFrame:
        key, user = F.col("event_id"), F.col("user_id")
        return self.raw("events").select(
            business_key("SES-", key, 9).alias("SESSION_ID"),
            business_key("U-", user, 6).alias("USER_PSEUDO_ID"),
            F.col("ts").cast("date").alias("SESSION_DATE"),
            pick(fixed.TRAFFIC_SOURCES, key).alias("SOURCE"),
            pick(fixed.TRAFFIC_MEDIA, key).alias("MEDIUM"),
            pick(fixed.CAMPAIGNS, key).alias("CAMPAIGN"),
            pick(fixed.DEVICES, key).alias("DEVICE_CATEGORY"),
            pick(["United States", "United States", "Canada", "Canada"], user).alias("COUNTRY"),
            pick(fixed.TERRITORIES, user).alias("TERRITORY"),
            item_key(user * (key % 5 + 1)).alias("PRODUCT_VIEWED"),
            decode(F.col("event_type"), EVENTS).alias("EVENT_NAME"),
        )

    def _personas(self) -> DataFrame:
        """A persona change per event: many rows per user, the newest one counts."""
        return self.raw("events").select(
            user_key(F.col("user_id")).alias("user_email"),
            pick([*fixed.PERSONAS, SOMEBODY], F.col("event_id")).alias("persona"),
            F.col("ts").alias("set_at"),
        )


def _unit_cost() -> Column:
    return money(F.round(money("p_retailprice") * F.lit("0.6").cast("decimal(2,1)"), 2))
