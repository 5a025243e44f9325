"""Conformed facts (silver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.functions.money import MONEY, money, price, zero_unless
from lakehouse_kpis.operators.dims import stamped
from lakehouse_kpis.operators.numbering import numbered
from lakehouse_kpis.sources import fixed

CHARGES = {
    "freight_amount": "FREIGHT",
    "discount_amount": "DISCOUNT",
    "pallet_amount": "PALLET",
}

# Copies of the per-invoice charges that the lines of one invoice are spread over.
SPREAD = 4
# Line numbers that are ranked together where charges are divided over lines.
BLOCK = 100_000


def markup_pivot(markups: DataFrame) -> DataFrame:
    """Charges per invoice, one column per charge code."""
    def total(code: str) -> Column:
        return F.sum(zero_unless(F.col("MARKUPCODE") == code, money("VALUE"))).cast(MONEY)

    return markups.groupBy("INVOICEID").agg(
        *[total(code).alias(name) for name, code in CHARGES.items()]
    )


def current_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("INVOICEID").alias("invoice_id"),
        F.col("LINENUM").alias("line_num"),
        F.col("INVOICEDATE").alias("invoice_date"),
        F.col("INVOICEACCOUNT").alias("customer_key"),
        F.col("ITEMID").alias("product_key"),
        F.col("QTY").alias("quantity"),
        price("SALESPRICE").alias("unit_sales_price"),
        money("LINEAMOUNT").alias("gross_line_amount"),
        money("TAXAMOUNT").alias("tax_amount"),
        F.col("CURRENCYCODE").alias("currency"),
        F.lit(fixed.CURRENT_ERP).alias("source_system"),
    )


def hashed_product_key(products: int) -> Column:
    """A stand-in product for a header-only invoice: its id hashed onto ITM00001..n."""
    slot = F.pmod(F.hash("INVOICEID"), F.lit(products)) + 1
    digits = slot.cast("string")
    return F.concat(
        F.lit("ITM"), F.lpad(digits, F.greatest(F.length(digits), F.lit(5)), F.lit("0"))
    )


def key_range(products: DataFrame) -> Column | None:
    """A stand-in product out of the table without a join, where its keys are one prefix and all numbers
    of a range in one width; None where they are not. Reads one row."""
    parts = products.select(
        "ITEMID", F.regexp_extract("ITEMID", "^(.*?)[0-9]*$", 1).alias("prefix"),
        F.regexp_extract("ITEMID", "([0-9]{1,18})$", 1).alias("digits"),
    ).where("ITEMID IS NOT NULL").withColumn("number", F.expr("try_cast(digits AS BIGINT)"))
    r = parts.agg(
        F.min("prefix").alias("prefix"), F.max("prefix").alias("prefix_to"),
        F.min(F.length("ITEMID")).alias("width"), F.max(F.length("ITEMID")).alias("width_to"),
        F.min("number").alias("low"), F.max("number").alias("high"),
        F.count_distinct("ITEMID").alias("keys"),
    ).first()
    if r.low is None or r.prefix != r.prefix_to or r.width != r.width_to:
        return None
    if r.high - r.low + 1 != r["keys"]:
        return None
    number = F.pmod(F.xxhash64("INVOICEID"), F.lit(r["keys"])) + F.lit(r.low)
    digits = F.lpad(number.cast("string"), r.width - len(r.prefix), "0")
    return F.concat(F.lit(r.prefix), digits)


def with_product(headers: DataFrame, products: DataFrame) -> DataFrame:
    """Headers with `_product`: the invoice id hashed onto the products of the table, so that a stand-in
    always exists; null without products. Keys without gaps are computed (`key_range`); others are
    numbered and joined."""
    key = key_range(products)
    if key is not None:
        return headers.withColumn("_product", key)
    items = products.select("ITEMID").where("ITEMID IS NOT NULL").distinct()
    items = numbered(items, ["ITEMID"], "_at", start=0).withColumnRenamed("ITEMID", "_product")
    # the numbered products are a written table; their count is read once
    placed = headers.withColumn("_at", F.pmod(F.xxhash64("INVOICEID"), F.lit(max(items.count(), 1))))
    return placed.join(items, "_at", "left").drop("_at")


def header_as_line(headers: DataFrame, product_key: Column | None = None) -> DataFrame:
    """A legacy invoice header as its only line: line 1, quantity 1, price = amount."""
    amount = money("INVOICEAMOUNT")
    return headers.select(
        F.col("INVOICEID").alias("invoice_id"),
        F.lit(1).alias("line_num"),
        F.col("INVOICEDATE").alias("invoice_date"),
        F.col("INVOICEACCOUNT").alias("customer_key"),
        (hashed_product_key(192) if product_key is None else product_key).alias("product_key"),
        F.lit(1).alias("quantity"),
        price(amount).alias("unit_sales_price"),
        amount.alias("gross_line_amount"),
        money("SALESTAXAMOUNT").alias("tax_amount"),
        F.col("CURRENCYCODE").alias("currency"),
        F.lit(fixed.LEGACY_ERP).alias("source_system"),
    )


def fact_invoice_lines(
    lines: DataFrame,
    markups: DataFrame,
    headers: DataFrame,
    allocation: str = "repeat",
    product_key: Column | None = None,
    spread: int = SPREAD,
    products: DataFrame | None = None,
) -> DataFrame:
    """Lines of both invoice systems with the charges of their invoice.

    A legacy header takes its product from `product_key`, else a stand-in out of `products`
    (`with_product`), else one by the fixed rule of `hashed_product_key`.

    allocation="repeat" puts the whole charge on every line of the invoice, "equal"
    divides it over the lines: see `_divided`.

    With "repeat" the join key is (invoice, slot): each line takes one of `spread` slots and the charges,
    one narrow row per invoice, are copied to every slot. The lines of one huge invoice so
    go to several tasks; and as the charges are not already partitioned by that key, the
    join gets shuffles of its own, which AQE can split further. spread=1 joins by invoice
    alone, which lets tables bucketed by invoice be joined without a shuffle.
    """
    if allocation not in ("repeat", "equal"):
        raise ValueError(f"allocation must be 'repeat' or 'equal', not {allocation!r}")
    if product_key is None and products is not None:
        headers, product_key = with_product(headers, products), F.col("_product")
    unified = current_lines(lines).unionByName(header_as_line(headers, product_key))
    charges = markup_pivot(markups).withColumnRenamed("INVOICEID", "invoice_id")
    if allocation == "equal":
        return _with_net(_divided(unified, charges))
    on = ["invoice_id"]
    if spread > 1:
        on = ["invoice_id", "_slot"]
        slots = F.array(*[F.lit(i) for i in range(spread)])
        charges = charges.withColumn("_slot", F.explode(slots))
        # by the line's own values, so that a retried task puts it in the same slot
        own = F.xxhash64("invoice_id", "line_num", "product_key", "gross_line_amount")
        unified = unified.withColumn("_slot", F.pmod(own, F.lit(spread)).cast("int"))
    return _with_net(unified.join(charges, on, "left"))


def _divided(lines: DataFrame, charges: DataFrame) -> DataFrame:
    """Lines with their shares of the charges, in whole cents that add up to the charge.

    What does not divide goes cent by cent to the first lines in the order of their numbers.
    Lines are ranked within blocks of line numbers, and a block starts where the counts of the
    blocks before it end, so an invoice of any length is ranked in many tasks.
    """
    # lines without a number are a block of their own, the first
    block = F.expr(f"coalesce(line_num div {BLOCK}, {-(1 << 62)})")
    sizes = lines.groupBy("invoice_id", block.alias("_block")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("invoice_id")
    sizes = sizes.select(
        "invoice_id", "_block", F.sum("_n").over(whole).alias("_lines"),
        (F.sum("_n").over(whole.orderBy("_block")) - F.col("_n")).alias("_before"),
    ).join(charges, "invoice_id")
    # lines that share a number are told apart by their other values, the same way in a retry
    order = ["line_num", *[c for c in lines.columns if c not in ("invoice_id", "line_num")]]
    place = F.row_number().over(Window.partitionBy("invoice_id", "_block").orderBy(*order))
    placed = lines.withColumn("_block", block).withColumn("_place", place)

    def share(charge: str) -> Column:
        cents = f"abs(CAST({charge} * 100 AS BIGINT))"
        extra = f"IF(_before + _place <= {cents} % _lines, 1, 0)"
        own = f"IF({charge} < 0, -1, 1) * ({cents} div _lines + {extra})"
        return F.expr(f"CAST({own} AS DECIMAL(18,0)) * 0.01BD").cast(MONEY)

    joined = placed.join(sizes, ["invoice_id", "_block"], "left")
    return joined.withColumns({c: share(c) for c in CHARGES})


def _with_net(joined: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c), F.lit(0).cast(MONEY)) for c in CHARGES]
    net = sum(parts, F.col("gross_line_amount")).cast(MONEY)
    return stamped(joined.select(
        "invoice_id", "line_num", "invoice_date", "customer_key", "product_key", "quantity",
        "unit_sales_price", "gross_line_amount",
        *[part.alias(name) for part, name in zip(parts, CHARGES)],
        net.alias("net_invoice_amount"),
        "tax_amount", "currency", "source_system",
    ))


def fact_gl_transactions(gl: DataFrame) -> DataFrame:
    return stamped(gl.select(
        F.col("VOUCHER").alias("voucher_id"),
        F.col("TRANSDATE").alias("transaction_date"),
        F.col("ACCOUNTNUM").alias("gl_account"),
        F.col("GL_DESCRIPTION").alias("gl_description"),
        F.col("GL_CATEGORY").alias("gl_category"),
        money("AMOUNTMST").alias("amount_usd"),
        F.col("CURRENCYCODE").alias("currency"),
        F.col("DIM_BUSINESS_UNIT").alias("business_unit"),
        F.col("DIM_TERRITORY").alias("territory"),
    ))


def fact_web_engagement(sessions: DataFrame) -> DataFrame:
    return stamped(sessions.select(
        F.col("SESSION_ID").alias("session_id"),
        F.col("USER_PSEUDO_ID").alias("user_pseudo_id"),
        F.col("SESSION_DATE").alias("session_date"),
        F.col("SOURCE").alias("traffic_source"),
        F.col("MEDIUM").alias("traffic_medium"),
        F.col("CAMPAIGN").alias("campaign"),
        F.col("DEVICE_CATEGORY").alias("device_category"),
        F.col("COUNTRY").alias("country"),
        F.col("TERRITORY").alias("territory"),
        F.col("PRODUCT_VIEWED").alias("product_key"),
        F.col("EVENT_NAME").alias("event_name"),
        F.coalesce(F.col("EVENT_NAME").isin(fixed.LEAD_EVENTS), F.lit(False))
        .alias("is_lead_event"),
    ))


def fact_crm_deals(deals: DataFrame) -> DataFrame:
    stage = F.col("DEALSTAGE")
    outcome = (
        F.when(stage == fixed.WON_STAGE, "WON").when(stage == fixed.LOST_STAGE, "LOST")
        .otherwise("OPEN")
    )
    return stamped(deals.select(
        F.col("DEAL_ID").alias("deal_id"),
        F.col("DEAL_NAME").alias("deal_name"),
        money("AMOUNT_USD").alias("amount_usd"),
        stage.alias("deal_stage"),
        outcome.alias("deal_outcome"),
        F.col("ASSOCIATED_ACCOUNTNUM").alias("customer_key"),
        F.col("CREATED_AT").alias("created_at"),
        F.col("TERRITORY").alias("territory"),
        F.col("LEAD_SOURCE").alias("lead_source"),
    ))
