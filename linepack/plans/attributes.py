"""Keeping the history of location attributes."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators import meta_changes
from ..operators.metadata import current_meta
from ..schemas import texts
from ..sources import read_meta, stored_meta


def stored_attributes(spark: SparkSession, path: str) -> DataFrame | None:
    """All attribute rows stored so far, ``None`` if there are none."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def update_attributes(
    spark: SparkSession, landing: str | list[str], path: str, run_date: date, parent: str
) -> None:
    """Append the posted attribute rows that are new or have changed.

    What was appended is stored, so running it again appends nothing.
    """
    posted = read_meta(spark, landing)
    if posted is None:
        return
    stored = stored_attributes(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], texts(current_meta(posted, parent).columns))
    changes = meta_changes(posted, stored_meta(stored), run_date, parent)
    changes.write.mode("append").parquet(path)
