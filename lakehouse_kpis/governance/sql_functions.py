"""The masks and the row filter as SQL functions, for queries written in SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakehouse_kpis.functions.text import quoted
from lakehouse_kpis.governance.policy import ALL_ROWS, Identity, Policy

# what a reader without the privilege gets of the value {v}
HIDDEN = {
    "email": "coalesce('***@' || get(split({v}, '@'), 1), if({v} IS NULL, NULL, '***'))",
    "phone": "'***-***-' || right({v}, 4)",
    "address": "if({v} IS NULL, NULL, '[REDACTED]')",
    "ssn": "if({v} IS NULL, NULL, 'XXX-XX-XXXX')",
    "salary": "if(false, {v}, NULL)",
}
_TYPES = {"salary": "DOUBLE"}


def register(spark: SparkSession, policy: Policy, who: Identity) -> None:
    """Define mask_<name>(v) and row_filter_territory(territory) for this reader.

    Each body is already decided, so a call is inlined into the plan as a plain expression.
    """
    held = policy.privileges(who)
    for mask, hidden in HIDDEN.items():
        kind = _TYPES.get(mask, "STRING")
        body = "v" if f"see:{mask}" in held else hidden.format(v="v")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION mask_{mask}(v {kind}) "
                  f"RETURNS {kind} RETURN {body}")
    own = sorted(p.removeprefix("rows:") for p in held if p.startswith("rows:"))
    if ALL_ROWS in held:
        seen = "true"
    elif own:
        names = ", ".join(map(quoted, own))
        seen = f"coalesce(territory IN ({names}), false)"
    else:
        seen = "false"
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION row_filter_territory(territory STRING) "
              f"RETURNS BOOLEAN RETURN {seen}")


def register_active_persona(spark: SparkSession, personas: str, user: str | None = None) -> None:
    """Define active_persona(): the newest persona of the user in the table or view named
    `personas`, NULL without a row. The user defaults to whoever runs the query."""
    who = "current_user()" if user is None else quoted(user)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION active_persona() RETURNS STRING RETURN "
              f"(SELECT max_by(persona, struct(set_at, persona)) FROM {personas} "
              f"WHERE user_email = {who})")
