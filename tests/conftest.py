import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


META = "struct<category string, year int, featured boolean, priority int, title string>"
DOC_SCHEMA = f"id string, namespace string, text string, embedding array<float>, metadata {META}, tenant string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Small corpus with missing metadata fields and equal vectors."""
    rows = [
        ("a", "t1", "alpha", [1.0, 0.0, 0.0], ("news", 2025, True, 1, "Ocean 100%"), "x"),
        ("b", "t1", "beta", [1.0, 0.0, 0.0], ("news", 2024, None, 2, "ocean"), "x"),
        ("c", "t2", "gamma", [0.0, 1.0, 0.0], ("blog", None, False, 3, None), "y"),
        ("d", "t2", "delta", [0.6, 0.8, 0.0], (None, 2025, True, None, "Sky"), "y"),
        ("e", "t2", None, [0.0, 0.0, 1.0], None, None),
        ("f", None, "zeta", [-1.0, 0.0, 0.0], ("blog", 2023, False, 5, "a.b"), "z"),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def plan_of():
    def text(df):
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
