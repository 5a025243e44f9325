"""Materialized views: a month-partitioned copy of a query that finds the months to rebuild."""

from __future__ import annotations

import datetime as dt
import functools
import json
import operator
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakehouse_kpis.catalog import Files
from lakehouse_kpis.functions.dates import month_of, month_start
from lakehouse_kpis.operators.ranges import between

NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a month
WHOLE = "*"                              # a source that has no date is one piece
KEPT = 2                                 # states of the view that stay readable

Sources = Mapping[str, tuple[DataFrame, str | None]]


def in_months(df: DataFrame, date: str, months: Sequence[dt.date]) -> DataFrame:
    """The rows of the given months, by ranges that a scan can use."""
    spans = [between(date, m, month_start(m, 1), df.columns) for m in months]
    return df.filter(functools.reduce(operator.or_, spans))


def signature(df: DataFrame, date: str | None) -> dict[str, list[str]]:
    """For each month of a source (all of it as one, without a date) its number of rows and two sums
    of hashes of whole rows, in which the order of rows plays no part.

    One row per month comes to the driver. Nulls are hashed by their place, too.
    """
    values = [F.col(f"`{c}`") for c in df.columns]
    place = F.array(*[v.isNull() for v in values])
    exact = DecimalType(38, 0)
    month = F.lit(WHOLE) if date is None else F.coalesce(
        month_of(date).cast("string"), F.lit(NO_MONTH)
    )
    found = df.groupBy(month.alias("month")).agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*values, place).cast(exact)).alias("a"),
        F.sum(F.xxhash64(place, *reversed(values)).cast(exact)).alias("b"),
    )
    return by_month(found, "n", "a", "b")


def by_month(found: DataFrame, *columns: str) -> dict[str, list[str]]:
    """month -> the columns as text. One row per month comes to the driver."""
    return {r["month"]: [str(r[c]) for c in columns] for r in found.collect()}


class MaterializedView:
    """`define(months)` gives the rows of those months, of all months for None.

    The definition must group by the month, so that a month of the view depends on that
    month of the source only; then rebuilding the changed months gives the same view as
    rebuilding all.

    `sources` gives what the definition reads: name -> (rows, the date column by whose month the view
    is grouped, or None for a dimension). With it, `refresh()` rebuilds the months whose rows have
    changed since the last refresh, and all of them if a dimension has; without it, all.

    Each refresh writes into a folder of its own; one small file, written under another name and
    renamed, then says which refresh each month is read from. Readers see the old state or the new
    one, and one that is running keeps the state it began with until KEPT more refreshes. A refresh
    that breaks off changes nothing. Of two refreshes at once, the one that ends later fails.
    """

    def __init__(
        self, spark: SparkSession, path: str,
        define: Callable[[Sequence[dt.date] | None], DataFrame],
        month: str = "invoice_month", sources: Callable[[], Sources] | None = None,
    ):
        self.spark, self.path, self.define, self.month = spark, path.rstrip("/"), define, month
        self.sources = sources
        self._files = Files(spark, self.path)

    def refresh(self, months: Sequence[dt.date] | None = None) -> list[str] | None:
        """Rebuild the given months, or those that have changed.

        Returns the months that were rebuilt, as text; None if all were.
        """
        if months is not None and any(m.day != 1 for m in months):
            raise ValueError("months are given by their first day")
        number, state = self._state()
        # taken before the rows are read: what changes in between is found by the next refresh
        now = self._signatures()
        if months is None:
            months = self._changed(state, now)
        if months is not None and not months:
            return []
        named = None if months is None else [m.isoformat() for m in months]
        refresh = self._write(self.define(months))
        held = {m: refresh for m in self._months_of(refresh)}
        if named is not None:
            kept = {m: r for m, r in state["months"].items() if m not in named}
            held = kept | {m: r for m, r in held.items() if m in named}
            now = self._merged(state["signatures"], now, named)
        self._switch(number + 1, {"months": held, "signatures": now})
        return named

    def read(self) -> DataFrame:
        """The view as the last refresh left it."""
        shape = self.define(None).schema
        months = self._state()[1]["months"]
        paths = [f"{self.path}/data/refresh={r}/{self.month}={m}" for m, r in sorted(months.items())]
        if not paths:
            return self.spark.createDataFrame([], shape)
        rows = self.spark.read.schema(shape).option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*[f"`{c}`" for c in shape.names])

    def _numbers(self) -> list[int]:
        found = self._files.found("states/*.json")
        return sorted(int(name.split("/")[-1].removesuffix(".json")) for name in found)

    def _state(self) -> tuple[int, dict]:
        """The last state and its number."""
        number = max(self._numbers(), default=0)
        return number, self._stored(number) if number else {"months": {}, "signatures": {}}

    def _stored(self, number: int) -> dict:
        return json.loads(self._files.read(f"states/{number}.json"))

    def _signatures(self) -> dict[str, dict[str, list[str]]]:
        if self.sources is None:
            return {}
        return {name: signature(df, date) for name, (df, date) in self.sources().items()}

    def _changed(self, state: dict, now: dict) -> list[dt.date] | None:
        """The months to rebuild, None for all."""
        before = state["signatures"]
        if not now or before.keys() != now.keys():
            return None
        changed = {
            month for name in now for month in before[name].keys() | now[name].keys()
            if before[name].get(month) != now[name].get(month)
        }
        if changed & {WHOLE, NO_MONTH}:
            return None
        return [dt.date.fromisoformat(m) for m in sorted(changed)]

    @staticmethod
    def _merged(before: dict, now: dict, months: Sequence[str]) -> dict:
        """The signatures after some months were rebuilt: theirs are new, the others stay."""
        def of(name: str) -> dict:
            kept = {m: s for m, s in before.get(name, {}).items() if m not in months}
            return kept | {m: s for m, s in now[name].items() if m in months}

        return {name: of(name) for name in now}

    def _write(self, df: DataFrame) -> str:
        """Rebalanced: files near the target size, a month that is too large for one is split."""
        refresh = uuid.uuid4().hex
        df.hint("rebalance", self.month).write.partitionBy(self.month).parquet(
            f"{self.path}/data/refresh={refresh}"
        )
        return refresh

    def _months_of(self, refresh: str) -> list[str]:
        folders = self._files.found(f"data/refresh={refresh}/{self.month}=*")
        return [f.split("=")[-1] for f in folders]

    def _switch(self, number: int, state: dict) -> None:
        """Make the state the last one, and drop what only older ones than the last KEPT read."""
        if not self._files.claim(f"claims/{number}"):
            raise FileExistsError(f"another refresh of {self.path} ended first")
        self._files.write(f"states/{number}.json", json.dumps(state))
        old = [n for n in self._numbers() if n <= number - KEPT]
        read = {
            at for n in range(number - KEPT + 1, number + 1) if n > 0 and n not in old
            for at in (state if n == number else self._stored(n))["months"].items()
        }
        for n in old:
            for month, refresh in self._stored(n)["months"].items():
                if (month, refresh) not in read:
                    self._files.delete(f"data/refresh={refresh}/{self.month}={month}")
            self._files.delete(f"states/{n}.json")
