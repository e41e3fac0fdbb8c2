from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Started here so that test modules can name columns while they are collected.
SESSION = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "8g")
    .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return SESSION
