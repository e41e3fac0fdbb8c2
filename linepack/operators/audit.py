"""Audit tables: counts, new locations, run totals, failures, missing, changes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import seconds_between, strip


def file_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Records per data file: the long form of a list of paths with their sizes."""
    return df.groupBy(*keys).agg(F.count("*").alias("records"))


def raw_counts(raw: DataFrame, dataset: str) -> DataFrame:
    """Parsed rows and postings per pipe; rows are added up per posting first."""
    return counts_of_files(file_counts(raw, "PipeCode", "PostingFile"), dataset)


def counts_of_files(files: DataFrame, dataset: str) -> DataFrame:
    """``raw_counts`` from the ``file_counts`` of each pipe and posting."""
    return files.groupBy(
        F.lit(dataset).alias("dataset_type"), F.col("PipeCode").alias("pipe_code")
    ).agg(F.sum("records").alias("raw_records"), F.count("*").alias("raw_files"))


def silver_counts(silver: DataFrame) -> DataFrame:
    """Rows and files per dataset of a written silver table."""
    per_file = silver.groupBy("Dataset", F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("records")
    )
    return per_file.groupBy(F.col("Dataset").alias("dataset_type")).agg(
        F.sum("records").alias("silver_records"), F.count("*").alias("silver_files")
    )


def new_location_counts(found: dict[str, DataFrame]) -> DataFrame:
    """How many new locations each dataset brought, 0 included."""
    parts = [
        rows.agg(F.count("*").alias("new_locations")).select(
            F.lit(dataset).alias("dataset_type"), "new_locations"
        )
        for dataset, rows in found.items()
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def dataset_detail(raw: DataFrame, silver: DataFrame, new_locations: DataFrame) -> DataFrame:
    """One line per dataset and pipe; figures of the whole dataset on its first pipe only."""
    firsts = raw.groupBy("dataset_type").agg(F.min("pipe_code").alias("_first"))
    first = F.col("pipe_code") == F.col("_first")

    def once(name: str) -> Column:
        return F.when(first, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).alias(name)

    return (
        raw.join(firsts, "dataset_type")
        .join(silver, "dataset_type", "left")
        .join(new_locations, "dataset_type", "left")
        .select(
            "dataset_type", "pipe_code", "raw_records", "raw_files",
            once("silver_records"), once("silver_files"), once("new_locations"),
        )
    )


def run_summary(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Totals per run and, marked by ``is_total``, over all runs."""
    counted = results.groupBy("pipeline").agg(
        F.count("*").alias("total"), F.count_if("success").alias("succeeded")
    )
    per_run = runs.join(counted, "pipeline", "left").select(
        "pipeline",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("succeeded", F.lit(0)).alias("succeeded"),
        seconds_between(F.col("start_time"), F.col("end_time")).alias("seconds"),
    )
    rate = F.try_divide(F.col("succeeded") * 100.0, F.col("total"))
    return (
        per_run.rollup("pipeline")
        .agg(
            (F.grouping("pipeline") == 1).alias("is_total"),
            F.sum("total").alias("total"),
            F.sum("succeeded").alias("succeeded"),
            F.sum("seconds").cast("double").alias("duration_s"),
        )
        .withColumn("failed", F.col("total") - F.col("succeeded"))
        .withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))
        .select("pipeline", "is_total", "total", "succeeded", "failed", "duration_s", "success_rate")
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success")).select(
        "pipe_code", "dataset_type", F.col("date").cast("date").alias("date"), "duration_s",
        F.coalesce(F.nullif("error", F.lit("")), F.lit("Unknown")).alias("error"),
    )


def pipe_changes(live: DataFrame, configured: DataFrame) -> DataFrame:
    """New, removed and renamed pipes; ``live`` has name and code, codes compare in upper case."""
    seen = live.select(F.upper("code").alias("pipe_code"), F.col("name").alias("live_name"))
    known = configured.select(
        F.upper("PipeCode").alias("pipe_code"), F.col("PipeName").alias("config_name")
    )
    latest = seen.groupBy("pipe_code").agg(F.max("live_name").alias("live_name"))
    stored = known.groupBy("pipe_code").agg(F.max("config_name").alias("config_name"))
    change = (
        F.when(F.col("config_name").isNull(), "new")
        .when(F.col("live_name").isNull(), "removed")
        .when(strip(F.col("live_name")) != strip(F.col("config_name")), "renamed")
    )
    return (
        latest.join(stored, "pipe_code", "full_outer")
        .withColumn("change_type", change)
        .where(F.col("change_type").isNotNull())
        .select("change_type", "pipe_code", "live_name", "config_name")
    )


def offered_units(availability: DataFrame) -> DataFrame:
    """One row per pipe and dataset that the pipe offers."""
    flags = {fixed.OA: "has_OA", fixed.SG: "has_SG", fixed.NN: "has_NN", fixed.META: "has_MetaData"}
    offered = F.array(*[
        F.when(F.col(flag), F.lit(dataset)) for dataset, flag in flags.items()
    ])
    return availability.select(
        F.col("pipe.code").alias("pipe_code"),
        F.explode(F.array_compact(offered)).alias("dataset_type"),
    )


def missing_downloads(availability: DataFrame, delivered: DataFrame) -> DataFrame:
    """Datasets a pipe offers that no posting was delivered for."""
    units = delivered.select("pipe_code", "dataset_type").distinct()
    return offered_units(availability).join(units, ["pipe_code", "dataset_type"], "left_anti")


class Reports(NamedTuple):
    """The five tables of an audit report."""

    summary: DataFrame
    failures: DataFrame
    details: DataFrame
    missing: DataFrame
    changes: DataFrame


def reports(
    results: DataFrame,
    runs: DataFrame,
    details: DataFrame,
    availability: DataFrame,
    live: DataFrame,
    configured: DataFrame,
) -> Reports:
    """Run summary, failures, details per dataset, missing deliveries and pipe changes.

    A unit counts as delivered when ``details`` has rows of it.
    """
    return Reports(
        summary=run_summary(results, runs),
        failures=failures(results),
        details=details,
        missing=missing_downloads(availability, details.where(F.col("raw_records") > 0)),
        changes=pipe_changes(live, configured),
    )
