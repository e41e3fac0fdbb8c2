"""The shared folder for tables that cut a plan in two, and what writes leave behind."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session or its context names it.

    There is no folder of our own choice: a machine-local one would be invisible to
    the other machines of a cluster.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession, open_files: int = 0) -> Iterator[None]:
    """Have each write made meanwhile remove its shuffle files when it ends.

    Else they stay until the driver happens to collect its garbage, so a run holds those of all
    its steps at once. For writes only: a write plans its rows anew, so nothing else reads its shuffles.
    With ``open_files`` a task keeps so many files of a partitioned write open and sorts its rows only
    if they are of more partitions.
    """
    wanted = {_CLEANUP: "true", **({_OPEN_FILES: str(open_files)} if open_files else {})}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Used where one intermediate result feeds several branches that must agree
    (or would repeat an expensive scan); it survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
