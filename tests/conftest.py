import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakehouse_kpis.session import SETTINGS

    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    import __spark_entry__ as entry

    return entry.lakehouse(spark, SMALL)


def listed(df, *columns):
    """Rows as sorted tuples."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def final_plan(df) -> str:
    """The plan as it ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def first_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
