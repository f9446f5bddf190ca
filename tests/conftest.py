import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("MARQUEE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def interpreted(spark):
    """Hand-written cases are a few rows each: compiling their plans would take longer than running them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield spark
    spark.conf.unset("spark.sql.codegen.wholeStage")
