"""Small constant relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakehouse_kpis.functions.text import quoted


def inline(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Rows of strings and numbers as a VALUES relation.

    Its exact size is known to the optimizer, so joins broadcast it without a hint.
    """
    def literal(value) -> str:
        if value is None:
            return "NULL"
        return quoted(value) if isinstance(value, str) else repr(value)

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
