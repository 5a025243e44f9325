"""Session defaults and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the transforms are written for. AQE picks broadcast joins from
# measured sizes and splits skewed shuffle partitions; "force" lets it split one even
# when an aggregation further up had hoped to reuse that partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session; all of them are runtime settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "lakehouse-kpis", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only in local mode, where there is one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = tempfile.mkdtemp(prefix="lakehouse-")
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


# Whether a query's shuffle files go when it has ended, rather than when the driver next collects
# garbage. A frame that is run again makes them anew, so this is set for writes only.
DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are run within leave no shuffle files behind."""
    before = spark.conf.get(DROPPED, "false")
    spark.conf.set(DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(DROPPED, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new folder of the shared place and read back, so that several readers
    share one run of its plan, and a lost executor costs none of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
