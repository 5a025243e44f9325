"""The persona table: which persona a user has put on, newest row first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from lakehouse_kpis.governance.policy import Identity
from lakehouse_kpis.sources.fixed import PERSONAS
from lakehouse_kpis.sources.inline import inline

SCHEMA = StructType([
    StructField("user_email", StringType(), False),
    StructField("persona", StringType(), False,
                {"comment": "One of: " + ", ".join(PERSONAS)}),
    StructField("set_at", TimestampNTZType(), True),
])


def active(personas: DataFrame) -> DataFrame:
    """The persona of each user: the one set last, the greater name if set at once.

    An aggregate, so a user with very many rows is reduced before the shuffle.
    """
    newest = F.struct("set_at", "persona")
    return personas.groupBy("user_email").agg(
        F.max_by("persona", newest).alias("persona"), F.max("set_at").alias("set_at")
    )


def identify(personas: DataFrame, user: str, groups: frozenset[str] = frozenset()) -> Identity:
    """The identity of one user, read once per session: at most one row comes back."""
    row = active(personas.filter(F.col("user_email") == user)).first()
    return Identity(user, row["persona"] if row else None, frozenset(groups))


def upsert(personas: DataFrame, changes: DataFrame) -> DataFrame:
    """All rows of the changed users replaced by the changes, one row per user."""
    newest = active(changes)
    kept = personas.join(newest.select("user_email"), "user_email", "left_anti")
    return kept.select("user_email", "persona", "set_at").unionByName(newest)


def set_persona(personas: DataFrame, user: str, persona: str, at: dt.datetime) -> DataFrame:
    if persona not in PERSONAS:
        raise ValueError(f"unknown persona {persona!r}")
    change = inline(
        personas.sparkSession, [(user, persona, at.isoformat(sep=" "))],
        ["user_email", "persona", "set_at"],
    ).withColumn("set_at", F.col("set_at").cast("timestamp_ntz"))
    return upsert(personas, change)


def invalid_rows(personas: DataFrame) -> DataFrame:
    """Rows whose persona is not one of the nine."""
    domain = inline(personas.sparkSession, [(p,) for p in PERSONAS], ["persona"])
    return personas.join(domain, "persona", "left_anti").select(personas.columns)


class PersonaTable:
    """The persona table in files, a folder per version.

    A parquet table cannot be overwritten while it is read, so each change writes the next
    version, and readers take the newest one that was written to its end. The number of a write
    that was broken off is not used again. Two changes at once go for the same version: the
    second one fails and can be tried again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        version = self._newest()
        if version is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self._folder(version))

    def set(self, user: str, persona: str, at: dt.datetime) -> None:
        self._write(set_persona(self.read(), user, persona, at))

    def change(self, changes: DataFrame) -> None:
        """Many users at once; none if a persona is unknown."""
        unknown = invalid_rows(changes).first()
        if unknown:
            raise ValueError(f"unknown persona {unknown['persona']!r}")
        self._write(upsert(self.read(), changes))

    def _write(self, df: DataFrame) -> None:
        df.write.mode("errorifexists").parquet(self._folder((self._last("") or 0) + 1))

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:09d}"

    def _newest(self) -> int | None:
        return self._last("/_SUCCESS")

    def _last(self, held: str) -> int | None:
        """The highest number of a version that holds the file, of any version for ""."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        done = hadoop.Path(f"{self.path}/version=*{held}")
        files = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = files.globStatus(done) or []
        paths = [f.getPath().getParent() if held else f.getPath() for f in found]
        names = [p.getName() for p in paths]
        return max((int(n.removeprefix("version=")) for n in names), default=None)
