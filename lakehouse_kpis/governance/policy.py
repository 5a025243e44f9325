"""Who may see what: grants to personas and groups, and how tables apply them.

A privilege is "see:<mask>" (the column is shown unmasked), "rows:*" (all rows) or
"rows:<territory>" (the rows of one territory). Whoever holds no row privilege sees no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehouse_kpis.functions.masks import MASKS
from lakehouse_kpis.sources.inline import inline

ALL_ROWS = "rows:*"


@dataclass(frozen=True)
class Identity:
    """The reader: an optional active persona and the groups they belong to."""

    user: str
    persona: str | None = None
    groups: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Policy:
    personas: Mapping[str, frozenset[str]] = field(default_factory=dict)
    groups: Mapping[str, frozenset[str]] = field(default_factory=dict)

    def privileges(self, who: Identity) -> frozenset[str]:
        """Everything the persona or any of the groups grants."""
        held = set(self.personas.get(who.persona, ()))
        for group in who.groups:
            held |= self.groups.get(group, frozenset())
        return frozenset(held)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The grants as rows (kind, principal, privilege)."""
        rows = [
            (kind, principal, privilege)
            for kind, table in (("persona", self.personas), ("group", self.groups))
            for principal, privileges in table.items()
            for privilege in sorted(privileges)
        ]
        return inline(spark, rows, ["kind", "principal", "privilege"])


def _grants(*privileges: str) -> frozenset[str]:
    return frozenset(privileges)


_CONTACT = ("see:email", "see:phone", "see:address")
_TERRITORY_GROUPS = {
    "us_east": _grants("rows:US-East"),
    "us_west": _grants("rows:US-West"),
    "canada_east": _grants("rows:Canada-East"),
    "canada_west": _grants("rows:Canada-West"),
}
_GROUPS = {
    "hr": _grants(*_CONTACT, "see:ssn", "see:salary"),
    "finance": _grants("see:email", "see:address", "see:salary"),
    "sales_leader": _grants("see:phone"),
    "global_leadership": _grants(ALL_ROWS),
    **_TERRITORY_GROUPS,
}

# The policy in force: the active persona counts, and the groups beside it.
PERSONA_POLICY = Policy(
    personas={
        "HR": _grants(*_CONTACT, "see:ssn", "see:salary", ALL_ROWS),
        "FINANCE": _grants("see:email", "see:address", "see:salary", ALL_ROWS),
        "GLOBAL_LEADERSHIP": _grants(*_CONTACT, ALL_ROWS),
        "SALES_LEADER": _grants("see:phone", ALL_ROWS),
        "SALES_REP": _grants(),
        "REGIONAL_MGR_US_EAST": _grants("rows:US-East"),
        "REGIONAL_MGR_US_WEST": _grants("rows:US-West"),
        "REGIONAL_MGR_CA_EAST": _grants("rows:Canada-East"),
        "REGIONAL_MGR_CA_WEST": _grants("rows:Canada-West"),
    },
    groups=_GROUPS,
)

# The earlier policy: groups only, and administrators see everything.
GROUP_POLICY = Policy(
    groups={**_GROUPS, "admins": _grants(*_CONTACT, "see:ssn", "see:salary", ALL_ROWS)}
)


@dataclass(frozen=True)
class Protection:
    """What a table hides: column -> mask, and the column its rows are filtered by."""

    masks: Mapping[str, str] = field(default_factory=dict)
    rows_by: str | None = None


PROTECTED = {
    "dim_customer": Protection(
        masks={"email": "email", "phone": "phone", "address_line1": "address"},
        rows_by="territory",
    ),
    "dim_employee": Protection(masks={"ssn": "ssn", "annual_salary_usd": "salary"}),
    "fact_gl_transactions": Protection(rows_by="territory"),
}


def visible_rows(df: DataFrame, privileges: Iterable[str], column: str = "territory") -> DataFrame:
    """The rows the privileges open. A NULL territory belongs to nobody's territory."""
    held = set(privileges)
    if ALL_ROWS in held:
        return df
    territories = sorted(p.removeprefix("rows:") for p in held if p.startswith("rows:"))
    return df.filter(F.col(column).isin(territories) if territories else F.lit(False))


def secure(df: DataFrame, table: str, privileges: Iterable[str]) -> DataFrame:
    """The table as a reader with these privileges sees it.

    Rows are filtered on raw values first, then columns are masked, so that whatever the
    reader computes, filters too, works on masked values. Privileges are resolved before,
    so a privileged read has no mask or filter left in its plan.
    """
    rule = PROTECTED.get(table)
    if rule is None:
        return df
    held = set(privileges)
    if rule.rows_by:
        df = visible_rows(df, held, rule.rows_by)
    hidden = {c: MASKS[m](F.col(c)) for c, m in rule.masks.items() if f"see:{m}" not in held}
    return df.withColumns(hidden) if hidden else df


def groups_of(memberships: DataFrame, policy: Policy, user: str) -> frozenset[str]:
    """The groups of one user that the policy knows: no more rows than it has groups."""
    known = sorted(policy.groups)
    rows = memberships.filter((F.col("user_email") == user) & F.col("group_name").isin(known))
    return frozenset(r[0] for r in rows.select("group_name").distinct().collect())


def user_privileges(memberships: DataFrame, policy: Policy) -> DataFrame:
    """(user_email, privilege) of every user in a group directory."""
    grants = policy.frame(memberships.sparkSession).filter("kind = 'group'")
    return (
        memberships.select("user_email", "group_name").distinct()
        .join(grants, F.col("group_name") == F.col("principal"))
        .select("user_email", "privilege").distinct()
    )


def persona_matrix(
    spark: SparkSession, policy: Policy, personas: Iterable[str],
    tables: Mapping[str, DataFrame],
) -> DataFrame:
    """How many rows, and how many values of each masked column, every persona sees.

    Each protected table is read once for all personas: one conditional count per persona
    and column, then one row per persona.
    """
    personas = list(personas)
    result = inline(spark, [(p,) for p in personas], ["persona"])
    for table, rule in PROTECTED.items():
        counts, labels = [], ["rows", *rule.masks]
        for persona in personas:
            held = policy.privileges(Identity("", persona))
            seen = F.lit(True)
            if rule.rows_by and ALL_ROWS not in held:
                own = [p.removeprefix("rows:") for p in held if p.startswith("rows:")]
                seen = F.col(rule.rows_by).isin(own) if own else F.lit(False)
            counts.append([F.count_if(seen)] + [
                F.count_if(seen & F.col(c).isNotNull()) if f"see:{m}" in held
                else F.count_if(F.lit(False))
                for c, m in rule.masks.items()
            ])
        flat = [c.alias(f"c{i}_{j}") for i, row in enumerate(counts) for j, c in enumerate(row)]
        rows = F.array(*[
            F.struct(F.lit(persona).alias("persona"), *[
                F.col(f"c{i}_{j}").alias(f"{table}_{label}") for j, label in enumerate(labels)
            ])
            for i, persona in enumerate(personas)
        ])
        seen_here = tables[table].agg(*flat).select(F.inline(rows))
        result = result.join(seen_here, "persona")
    return result
