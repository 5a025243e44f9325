"""Column masks: what a reader without the privilege sees.

Pure column expressions, so masking stays inside generated code. A privileged reader
gets the column untouched and no mask appears in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email(col: Column) -> Column:
    """Only the domain is shown; text without a domain is hidden whole."""
    domain = F.get(F.split(col, "@"), 1)
    hidden = F.coalesce(F.concat(F.lit("***@"), domain), F.lit("***"))
    return F.when(col.isNotNull(), hidden)


def phone(col: Column) -> Column:
    """Only the last four characters are shown."""
    return F.concat(F.lit("***-***-"), F.right(col, F.lit(4)))


def address(col: Column) -> Column:
    return F.when(col.isNotNull(), F.lit("[REDACTED]"))


def ssn(col: Column) -> Column:
    return F.when(col.isNotNull(), F.lit("XXX-XX-XXXX"))


def salary(col: Column) -> Column:
    """NULL of the column's own type."""
    return F.when(F.lit(False), col)


MASKS = {"email": email, "phone": phone, "address": address, "ssn": ssn, "salary": salary}
