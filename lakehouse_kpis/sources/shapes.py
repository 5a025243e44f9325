"""Shapes of the landed (bronze) tables: column names and types.

Money may land as DOUBLE or DECIMAL; the conforming step casts it to exact money.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_M = "decimal(18,2)"
_P = "decimal(22,6)"  # of one unit

SHAPES: dict[str, dict[str, str]] = {
    "products": {
        "ITEMID": "string", "ITEMNAME": "string", "ITEMGROUPID": "string",
        "PRODUCTSUBTYPE": "string", "SALESUNIT": "string", "UNITCOST_USD": _P,
        "LISTPRICE_USD": _P, "DISCONTINUED": "int", "CREATEDDATETIME": "timestamp_ntz",
        "DATAAREAID": "string",
    },
    "customers": {
        "ACCOUNTNUM": "string", "NAME": "string", "EMAIL": "string", "PHONE": "string",
        "ADDRESS_LINE1": "string", "CITY": "string", "STATE_PROVINCE": "string",
        "POSTAL_CODE": "string", "COUNTRY": "string", "TERRITORY": "string",
        "CUSTGROUP": "string", "BLOCKED": "int", "CREDITLIMIT_USD": _M,
        "CREATEDDATETIME": "timestamp_ntz", "MODIFIEDDATETIME": "timestamp_ntz",
        "DATAAREAID": "string",
    },
    "invoice_lines": {
        "INVOICEID": "string", "LINENUM": "int", "INVOICEACCOUNT": "string",
        "ITEMID": "string", "INVOICEDATE": "date", "QTY": "int", "SALESPRICE": _P,
        "LINEAMOUNT": _M, "TAXAMOUNT": _M, "CURRENCYCODE": "string", "DATAAREAID": "string",
        "POSTEDDATETIME": "timestamp_ntz", "_SYSROWID": "string",
        "_SINKMODIFIEDTIME": "timestamp_ntz",
    },
    "markups": {
        "RECID": "string", "INVOICEID": "string", "MARKUPCODE": "string", "VALUE": _M,
        "MARKUPACCOUNT": "string", "TRANSDATE": "timestamp_ntz", "DATAAREAID": "string",
    },
    "dimension_values": {
        "BU_CODE": "string", "BU_NAME": "string", "CHANNEL_CODE": "string",
        "CHANNEL_NAME": "string",
    },
    "legacy_headers": {
        "INVOICEID": "string", "INVOICEACCOUNT": "string", "INVOICEDATE": "date",
        "INVOICEAMOUNT": _M, "SALESTAXAMOUNT": _M, "CURRENCYCODE": "string",
        "POSTED": "int", "DATAAREAID": "string",
    },
    "gl": {
        "VOUCHER": "string", "TRANSDATE": "date", "ACCOUNTNUM": "string",
        "GL_DESCRIPTION": "string", "GL_CATEGORY": "string", "AMOUNTMST": _M,
        "CURRENCYCODE": "string", "DIM_BUSINESS_UNIT": "string", "DIM_TERRITORY": "string",
        "DATAAREAID": "string",
    },
    "employees": {
        "EMPLOYEE_ID": "string", "FULL_NAME": "string", "SSN": "string", "HIRE_DATE": "date",
        "ANNUAL_SALARY": _M, "DEPARTMENT_CODE": "string", "DEPARTMENT": "string",
        "WORK_EMAIL": "string", "TERRITORY": "string", "STATUS": "string",
    },
    "deals": {
        "DEAL_ID": "string", "DEAL_NAME": "string", "AMOUNT_USD": _M, "DEALSTAGE": "string",
        "ASSOCIATED_ACCOUNTNUM": "string", "CREATED_AT": "date", "TERRITORY": "string",
        "LEAD_SOURCE": "string",
    },
    "sessions": {
        "SESSION_ID": "string", "USER_PSEUDO_ID": "string", "SESSION_DATE": "date",
        "SOURCE": "string", "MEDIUM": "string", "CAMPAIGN": "string",
        "DEVICE_CATEGORY": "string", "COUNTRY": "string", "TERRITORY": "string",
        "PRODUCT_VIEWED": "string", "EVENT_NAME": "string",
    },
    "personas": {"user_email": "string", "persona": "string", "set_at": "timestamp_ntz"},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast a landed frame to its shape; casts to the same type vanish."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in SHAPES[table].items()])
