"""Layers as databases, and builds of them: written beside each other, published by one switch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehouse_kpis.functions.text import quoted
from lakehouse_kpis.operators.ranges import partition_of

LAYERS = {
    "bronze": "raw landed data of the source systems",
    "silver": "conformed dimensions and facts",
    "gold": "published marts and metric views",
    "governance": "personas and policies",
}
BEGUN, DONE = "_begun", "_build.json"


class Files:
    """Small files of a folder that all machines reach, through the cluster's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(conf)

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def found(self, pattern: str) -> list[str]:
        """Paths below the root, in the pattern's depth."""
        depth = pattern.count("/") + 1
        paths = [f.getPath().toString() for f in self._files.globStatus(self._at(pattern)) or []]
        return ["/".join(p.split("/")[-depth:]) for p in paths]

    def claim(self, name: str) -> bool:
        """Create an empty file, unless there is one."""
        if self._files.exists(self._at(name)):
            return False
        self._files.create(self._at(name), False).close()
        return True

    def write(self, name: str, text: str) -> None:
        """Write a file under another name and rename it, so that it is there whole or not at all."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._files.rename(draft, self._at(name)):
            raise FileExistsError(name)

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        size = self._files.getFileStatus(self._at(name)).getLen()
        text = stream.readNBytes(int(size))
        stream.close()
        return bytes(text).decode()

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


class Catalog:
    """Tables named <prefix><layer>.<name>, as the last finished build left them.

    A build writes into a folder and databases of its own, <prefix><layer>__<version>. Nothing of it
    is seen until `commit` writes the one file that ends it; the published names are views, which are
    pointed at the build then. A build that is broken off leaves the published tables as they were,
    and its number is not used again. `builds` is the folder, the warehouse by default; whoever opens
    it in another application gets the tables of the last build, from their files.
    """

    def __init__(
        self, spark: SparkSession, prefix: str = "", builds: str | None = None,
        version: int | None = None,
    ):
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        self.spark, self.prefix, self.version = spark, prefix, version
        self.builds = builds or f"{warehouse.rstrip('/')}/{prefix}builds"
        self._files = Files(spark, self.builds)
        self._published: dict[tuple[str, str], dict] = {}

    def ensure_layers(self) -> None:
        for layer, comment in LAYERS.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} "
                           f"COMMENT {quoted(comment)}")
            if self.version is not None:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self._database(layer)} "
                               f"COMMENT {quoted(f'{comment}, build {self.version}')}")

    def _database(self, layer: str) -> str:
        return f"{self.prefix}{layer}" + ("" if self.version is None else f"__{self.version}")

    def name(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise KeyError(f"unknown layer {layer!r}")
        return f"{self._database(layer)}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    # --- builds -----------------------------------------------------------------------------

    def _versions(self, held: str) -> list[int]:
        return sorted(int(p.split("/")[0]) for p in self._files.found(f"*/{held}"))

    def current(self) -> int | None:
        """The number of the last finished build."""
        return max(self._versions(DONE), default=None)

    def begin(self) -> Catalog:
        """The catalog of a new build; two that begin at once get different numbers."""
        version = max(self._versions(BEGUN), default=0) + 1
        while not self._files.claim(f"{version}/{BEGUN}"):
            version += 1
        build = Catalog(self.spark, self.prefix, self.builds, version)
        build.ensure_layers()
        return build

    def publish(
        self, df: DataFrame, layer: str, table: str, comment: str = "",
        properties: Mapping[str, str] | None = None,
        partition_by: Mapping[str, Column] | None = None,
        bucket_by: tuple[int, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Create or replace a table from a frame.

        partition_by: new column -> expression (the month of a date, say). bucket_by: number
        and columns; tables bucketed alike on a join key are joined without a shuffle.
        """
        name = self.name(layer, table)
        if partition_by:
            df = df.withColumns(dict(partition_by))
        if bucket_by:
            buckets, columns = bucket_by
            df = df.repartition(buckets, *columns)
        elif partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by or layer == "bronze":
            # what is large; dimensions keep the session's codec, as their size decides on broadcasts
            writer = writer.option("compression", "zstd")
        if self.version is not None:
            writer = writer.option("path", f"{self.builds}/{self.version}/{layer}/{table}")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
        writer.saveAsTable(name)
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
        if properties:
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_pairs(properties)})")
        self._published[layer, table] = {
            "layer": layer, "table": table, "comment": comment, "properties": dict(properties or {}),
            "partitioned": bool(partition_by), "columns": df.columns,
        }
        return self.read(layer, table)

    def commit(self, settings: Mapping[str, str], secured: Mapping[str, str] | None = None) -> None:
        """End the build and point the published names at it.

        settings are kept for whoever opens the build. secured: table -> the SELECT list and the
        condition under which readers see it, with {table} for its name.
        """
        tables = []
        for (layer, table), held in self._published.items():
            made = self.spark.sql(f"SHOW CREATE TABLE {self.name(layer, table)}").first()[0]
            tables.append({**held, "ddl": made, "secured": (secured or {}).get(table)})
        build = {"settings": dict(settings), "tables": tables}
        self._files.write(f"{self.version}/{DONE}", json.dumps(build))
        self._switch(build)

    def _build(self) -> dict:
        return json.loads(self._files.read(f"{self.version}/{DONE}"))

    def _switch(self, build: dict) -> None:
        for held in build["tables"]:
            view = f"{self.prefix}{held['layer']}.{held['table']}"
            source = self.name(held["layer"], held["table"])
            body = (held["secured"] or "SELECT * FROM {table}").replace("{table}", source)
            comment = f" COMMENT {quoted(held['comment'])}" if held["comment"] else ""
            shown = f" TBLPROPERTIES ({_pairs(held['properties'])})" if held["properties"] else ""
            self.spark.sql(f"CREATE OR REPLACE VIEW {view}{comment}{shown} AS {body}")

    def open(self) -> tuple[Catalog, dict[str, str]]:
        """The catalog of the last finished build, and its settings.

        Tables that this application does not know are made from their files. The catalog stays with
        its build, so whoever reads on sees one state while later builds are published.
        """
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no finished build in {self.builds}")
        opened = Catalog(self.spark, self.prefix, self.builds, version)
        opened.ensure_layers()
        build = opened._build()
        for held in build["tables"]:
            name = opened.name(held["layer"], held["table"])
            if not self.spark.catalog.tableExists(name):
                self.spark.sql(held["ddl"])
                if held["partitioned"]:
                    self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            opened._published[held["layer"], held["table"]] = held
        opened._switch(build)
        return opened, build["settings"]

    def tables(self, layer: str) -> list[str]:
        """The tables of a layer of this build."""
        return [table for held, table in self._published if held == layer]

    def drop_old(self, keep: int = 1) -> list[int]:
        """Drop the builds before the last finished one but `keep` of the finished ones, for readers
        that are still at them; returns what was dropped. Later builds may be running and stay."""
        done = self._versions(DONE)
        kept = set(done[-1 - keep:])
        old = [v for v in self._versions(BEGUN) if done and v < done[-1] and v not in kept]
        for version in old:
            for layer in LAYERS:
                database = Catalog(self.spark, self.prefix, self.builds, version)._database(layer)
                self.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
            # the file that ends the build goes first: a folder that is half gone is no build
            self._files.delete(f"{version}/{DONE}")
            self._files.delete(str(version))
        return old

    def view(self, name: str, df: DataFrame) -> None:
        """A late-bound view of this session: its plan runs when it is read."""
        df.createOrReplaceTempView(name)


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())


def month_partition(date: str) -> dict[str, Column]:
    """The month partition of a fact that is filtered by date."""
    return {partition_of(date): F.trunc(date, "MONTH")}
