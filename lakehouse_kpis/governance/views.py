"""Governance of published tables: views that find the reader's privileges when they are read.

The persona log and the grants are tables of the governance layer. `my_privileges` is one row for
whoever runs the query, and the published names of protected tables are views over the stored tables
that ask it. Putting on another persona is one row more in the log, and shows with the next query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from lakehouse_kpis.catalog import Catalog, Files
from lakehouse_kpis.functions.text import quoted
from lakehouse_kpis.governance.persona import SCHEMA, invalid_rows
from lakehouse_kpis.governance.policy import PROTECTED, Policy
from lakehouse_kpis.governance.sql_functions import HIDDEN
from lakehouse_kpis.sources.fixed import PERSONAS
from lakehouse_kpis.sources.inline import inline

MEMBERS = "user_email string, group_name string"


class Governance:
    """The governance layer of a catalog: personas, group members, grants, and who reads."""

    def __init__(self, catalog: Catalog, user: str | None = None):
        """user: a SQL expression for the reader, current_user() by default."""
        self.catalog, self.spark, self.user = catalog, catalog.spark, user or "current_user()"
        self.layer = f"{catalog.prefix}governance"

    def _place(self, table: str) -> str:
        """The folder of a table: the last compacted one, if there is one."""
        whole = Files(self.spark, self.catalog.builds).found(f"governance/{table}-*/_SUCCESS")
        return f"{self.catalog.builds}/governance/{max(whole).split('/')[1] if whole else table}"

    def ensure(self, policy: Policy) -> None:
        """The layer's tables and views; personas and members that are there stay."""
        self.catalog.ensure_layers()
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}" + (
                f" COMMENT {quoted(f.metadata['comment'])}" if "comment" in f.metadata else "")
            for f in SCHEMA
        )
        for table, shape in (("personas", columns), ("members", MEMBERS)):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.layer}.{table} ({shape}) "
                           f"USING parquet LOCATION {quoted(self._place(table))}")
        grants = ", ".join(
            f"({quoted(kind)}, {quoted(principal)}, {quoted(privilege)})"
            for kind, held in (("persona", policy.personas), ("group", policy.groups))
            for principal, privileges in held.items() for privilege in sorted(privileges)
        )
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.layer}.grants AS "
                       f"SELECT * FROM VALUES {grants} AS t(kind, principal, privilege)")
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self.layer}.active_personas AS
            SELECT user_email, max_by(persona, struct(set_at, persona)) AS persona, max(set_at) AS set_at
            FROM {self.layer}.personas GROUP BY user_email""")
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self.layer}.my_privileges AS
            SELECT collect_set(g.privilege) AS privileges FROM {self.layer}.grants g JOIN (
              SELECT 'persona' AS kind, persona AS principal FROM {self.layer}.active_personas
              WHERE user_email = {self.user}
              UNION ALL
              SELECT 'group', group_name FROM {self.layer}.members WHERE user_email = {self.user}
            ) p ON g.kind = p.kind AND g.principal = p.principal""")

    def set_persona(self, user: str, persona: str, at: dt.datetime) -> None:
        """One small file more; the newest row of a user counts."""
        if persona not in PERSONAS:
            raise ValueError(f"unknown persona {persona!r}")
        self.change(inline(
            self.spark, [(user, persona, at.isoformat(sep=" "))], ["user_email", "persona", "set_at"]
        ))

    def change(self, changes: DataFrame) -> None:
        """Many users at once; none if a persona is unknown. An append: a write that breaks off leaves
        no row, and two at once both count."""
        changes = changes.select("user_email", "persona", changes["set_at"].cast("timestamp_ntz"))
        unknown = invalid_rows(changes).first()
        if unknown:
            raise ValueError(f"unknown persona {unknown['persona']!r}")
        changes.coalesce(1).write.insertInto(f"{self.layer}.personas")

    def add_members(self, members: DataFrame) -> None:
        members.select("user_email", "group_name").write.insertInto(f"{self.layer}.members")

    def compact(self) -> None:
        """The log as one row per user, in a folder of its own that the table is pointed at then. What
        is appended meanwhile is not in it, so compact while nobody changes a persona."""
        rows = self.spark.table(f"{self.layer}.active_personas").select(*[f.name for f in SCHEMA])
        place = f"{self.catalog.builds}/governance/personas-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
        rows.write.parquet(place)
        self.spark.sql(f"ALTER TABLE {self.layer}.personas SET LOCATION {quoted(place)}")

    def secured(self, table: str, columns: list[str]) -> str:
        """The SELECT that shows a frame with the rules of a protected table, {table} being the
        stored frame's name. A frame without the column that rows are kept by cannot be shown so.

        Rows are kept by the stored value of the territory; a null one is nobody's, and without a
        privilege no row is left.
        """
        rule = PROTECTED[table]
        if rule.rows_by and rule.rows_by not in columns:
            raise ValueError(f"rows of {table} are kept by {rule.rows_by!r}")
        held = f"(SELECT privileges FROM {self.layer}.my_privileges)"
        shown = []
        for column in columns:
            mask = rule.masks.get(column)
            if mask is None:
                shown.append(f"t.`{column}`")
                continue
            hidden = HIDDEN[mask].format(v=f"t.`{column}`")
            shown.append(f"IF(array_contains({held}, 'see:{mask}'), t.`{column}`, {hidden}) AS `{column}`")
        query = f"SELECT {', '.join(shown)} FROM {{table}} t"
        if rule.rows_by:
            own = f"concat('rows:', t.`{rule.rows_by}`)"
            query += f" WHERE array_contains({held}, 'rows:*') OR array_contains({held}, {own})"
        return query
