"""Landed tables read back from files, one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakehouse_kpis.sources.shapes import SHAPES, conform


class LandedTables:
    """Reader for landed tables at `<path>/<table>` in any batch file format."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def table(self, name: str) -> DataFrame:
        if name not in SHAPES:
            raise KeyError(f"unknown landed table {name!r}")
        return conform(self.spark.read.format(self.fmt).load(f"{self.path}/{name}"), name)
