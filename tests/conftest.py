import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def value(spark):
    """The value of a column expression over one row."""

    def run(expression, **columns):
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField(k, T.StringType()) for k in columns]) if columns else T.StructType([T.StructField("x", T.StringType())])
        return spark.createDataFrame([tuple(columns.values()) or ("",)], schema).select(expression).first()[0]

    return run
