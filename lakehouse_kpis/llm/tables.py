"""Reading inputs and writing intermediate tables.

Intermediate tables go to the folder in `spark.checkpoint.dir`, which every executor reaches, so a
lost executor costs at most the tasks that were running on it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakehouse_kpis.session import shared_dir

# Rows of one Arrow batch. Texts are long, and a Python worker holds one batch at a time.
BATCH_ROWS = 256


def text_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Let the Python workers of this session take small batches, as texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return text_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new folder of the shared place and read it back: the lineage ends here.

    The folders lie under one folder per application, to be dropped once it has ended.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/llm/{app}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
