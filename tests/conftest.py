"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "2")
               .config("spark.default.parallelism", "2").config("spark.sql.codegen.methodSplitThreshold", "512")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Force groups to be cut and lookups to be salted."""
    spark.conf.set("spark.motionloom.rowsPerTask", "4")
    spark.conf.set("spark.motionloom.broadcastRows", "1")
    yield spark
    spark.conf.unset("spark.motionloom.rowsPerTask")
    spark.conf.unset("spark.motionloom.broadcastRows")
