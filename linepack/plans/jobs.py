"""Whole runs: landing to bronze, silver, locations, gold, rejects and audit.

A run over many days is one job with the day as a column, not a loop of jobs.
Inputs are never deleted, errors stop the run, and repeating a run replaces
what it wrote.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import (
    conform,
    counts_of_files,
    cycle_counts,
    daily_range,
    dataset_detail,
    file_counts,
    gold_nn,
    gold_oa,
    gold_sg,
    historic_range,
    keyed,
    latest_cycle,
    meta_enrichment,
    missing_downloads,
    new_location_counts,
    new_point_locations,
    new_segment_locations,
    of_files,
    point_rejects,
    point_silver,
    segment_rejects,
    segment_silver,
    silver_counts,
    silver_rejects,
    union_by_name,
    unmatched_stations,
    upsert_by_key,
)
from ..functions import gas_month
from ..operators.cycles import CYCLE_COLUMN
from ..operators.silver import LOCATION_COLUMN
from ..schemas import REJECTS, STORED_LOCATIONS
from ..shared import materialise, shuffles_removed
from ..sinks import (
    any_entered,
    current_files,
    enter_days,
    enter_files,
    left_days,
    merge_slices,
    new_files,
    posting_days,
    read_bronze,
    read_bronze_run,
    read_bronze_runs,
    read_silver,
    read_version,
    write_bronze,
    write_silver,
    write_version,
)
from ..sources import (
    append_failures,
    inspect_segments,
    literal_path,
    posted_files,
    read_points,
    read_segments,
    unreadable_segments,
)

@dataclass(frozen=True)
class Tables:
    """Where the tables of one installation are, below one root folder, and what its gold holds.

    With ``latest_cycle`` gold has only the latest cycle that each figure was posted for, in
    every run, replay and stream of the installation; without, all cycles.
    """

    root: str
    latest_cycle: bool = False

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def postings(self) -> str:
        return f"{self.root}/postings"

    @property
    def waiting(self) -> str:
        return f"{self.root}/waiting"

    @property
    def rebuilt(self) -> str:
        return f"{self.root}/rebuilt"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def gold_runs(self) -> str:
        return f"{self.root}/gold_runs"

    @property
    def locations(self) -> str:
        return f"{self.root}/locations"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"


#: Columns in front of the slice in the gold table of an installation.
GOLD_EXTRA = ("ParentPipe",)


def run_name(run_ts: datetime, parent: str) -> str:
    """Time and parent of a run: two parents can run at the same time."""
    return f"{run_ts:%Y%m%d%H%M%S}-{re.sub('[^A-Za-z0-9]+', '-', parent)}"


def land(
    spark: SparkSession, landing: dict[str, str | list[str]], tables: Tables, run: str,
    files: dict[str, DataFrame] | None = None,
) -> None:
    """Read the posted files that no other run has landed, and write their rows to bronze.

    ``files`` (path, length, modificationTime) are taken in place of a listing. What was
    landed is entered last: files in the ledger, and the gas days of each posting in an
    index that later runs find current postings and touched slices by. Segment files that
    cannot be read are listed in the audit tables. To the driver come the names of new
    files, and none at all while the ledger is empty.
    """
    for dataset, where in landing.items():
        listed = posted_files(spark, where) if files is None else files[dataset]
        fresh = materialise(new_files(listed, tables.ledger, dataset, run), "new-files")
        if fresh.isEmpty():
            continue
        if files is None and not any_entered(spark, tables.ledger, dataset, run):
            paths = where
        else:
            paths = [literal_path(row.path) for row in fresh.where("length > 0").select("path").collect()]
        if paths:
            _land_files(spark, dataset, paths, tables, run)
        enter_files(fresh, tables.ledger, dataset, run)


def _land_files(spark: SparkSession, dataset: str, paths: str | list[str], tables: Tables, run: str) -> None:
    if dataset == fixed.SG:
        files = inspect_segments(spark, paths)
        raw = read_segments(spark, paths, files)
        write_run(unreadable_segments(spark, paths, files), f"{tables.audit}/unreadable", run)
    else:
        raw = read_points(spark, paths)
    if raw is None:
        return
    write_bronze(raw, tables.bronze, dataset, run)
    rows = read_bronze_run(spark, tables.bronze, dataset, run)
    if rows is not None:
        enter_days(rows, tables.postings, dataset, run)


def current_rows(spark: SparkSession, tables: Tables, dataset: str, days: DataFrame | None = None, run: str | None = None) -> DataFrame:
    """Rows of the current postings: of ``days``, and without a day if ``run`` landed them; else all.

    Which postings are current is decided over all that was ever landed, before days are
    chosen. Only runs that brought current rows of the days are opened, and of them only
    files whose statistics reach the days, so reading does not grow with the history.
    ``days`` is a written table that Spark knows to be small.
    """
    index = posting_days(spark, tables.postings, dataset)
    files = materialise(current_files(index), "current-postings")
    wanted = of_files(index, files)
    own = F.col("GasDay").isNull() & (F.col("run") == F.lit(run))
    if days is not None:
        dated = wanted.join(days, "GasDay", "left_semi").select("run")
        wanted = dated if run is None else dated.unionByName(wanted.where(own).select("run"))
    runs = sorted(row.run for row in wanted.select("run").distinct().collect())
    if not runs:
        return read_bronze(spark, tables.bronze, dataset).where("false").drop("run")
    rows = read_bronze_runs(spark, tables.bronze, dataset, runs)
    if days is not None:
        span = days.agg(F.min("GasDay").alias("first"), F.max("GasDay").alias("last")).first()
        dated = rows.where(F.col("GasDay").between(F.lit(span["first"]), F.lit(span["last"]))).join(days, "GasDay", "left_semi")
        rows = dated if run is None else dated.unionByName(rows.where(own))
    return of_files(rows, files).drop("run")


def to_silver(raw: DataFrame, pipes: DataFrame, dataset: str, repeats: bool = False) -> DataFrame:
    rows = raw.drop("GasDay")
    if dataset == fixed.SG:
        return segment_silver(rows, pipes, repeats)
    return point_silver(rows, pipes, LOCATION_COLUMN[dataset], repeats)


def to_gold(
    silver: dict[str, DataFrame], locations: DataFrame, run_ts: datetime, parent: str, latest: bool = False
) -> DataFrame:
    """Stamped facts of all datasets, or of their latest cycles; ``merge_slices`` makes them distinct while it writes."""
    if latest:
        silver = {dataset: latest_cycle(rows, dataset) for dataset, rows in silver.items()}
    facts = []
    if fixed.OA in silver:
        facts.append(gold_oa(silver[fixed.OA]))
    if fixed.NN in silver:
        facts.append(gold_nn(silver[fixed.NN]))
    if fixed.SG in silver:
        facts.append(gold_sg(silver[fixed.SG], locations))
    return union_by_name(*facts).withColumns({
        "Timestamp": F.lit(run_ts).cast("timestamp_ntz"), "ParentPipe": F.lit(parent),
    })


def posted_slices(days: dict[str, DataFrame], parent: str) -> DataFrame:
    """The slices of the gas days of each dataset."""
    parts = [
        rows.select(
            gas_month(F.col("GasDay")).alias("GasMonth"), F.lit(dataset).alias("Dataset"), "GasDay",
            F.lit(parent).alias("ParentPipe"),
        ).where(F.col("GasDay").isNotNull()).distinct()
        for dataset, rows in days.items()
    ]
    return union_by_name(*parts)


def current_locations(spark: SparkSession, tables: Tables) -> DataFrame:
    stored = read_version(spark, tables.locations)
    return spark.createDataFrame([], STORED_LOCATIONS) if stored is None else stored


def discover_locations(
    silver: dict[str, DataFrame],
    meta: DataFrame | None,
    pipes: DataFrame,
    tables: Tables,
    parent: str,
    run_ts: datetime,
) -> dict[str, DataFrame]:
    """Find new locations per dataset and make the table that holds them current."""
    spark = pipes.sparkSession
    known = current_locations(spark, tables)
    found = {}
    for dataset, rows in silver.items():
        if dataset == fixed.SG:
            fresh = new_segment_locations(rows, known, pipes, run_ts)
        else:
            fresh = new_point_locations(rows, known, meta, run_ts)
        found[dataset] = materialise(fresh, "locations")
    fresh = union_by_name(*found.values())
    if not fresh.isEmpty():
        write_version(upsert_by_key(known, keyed(fresh, parent)), tables.locations)
    return found


def run_rejects(
    raw: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    pipes: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Everything a run left out of gold or took in without a figure."""
    parts = []
    for dataset, rows in raw.items():
        if dataset == fixed.SG:
            parts.append(segment_rejects(rows, pipes))
            parts.append(unmatched_stations(silver[dataset], locations))
        else:
            parts.append(point_rejects(rows, pipes, dataset))
        parts.append(silver_rejects(silver[dataset], dataset))
    return conform(union_by_name(*parts), REJECTS)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Replace the whole folder of a run, also by nothing."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(f"{path}/run={run}")


def days_of(dataset: str, start: date, end: date, as_of: date) -> tuple[date, date]:
    """The gas days [start, end] as a dataset posts them: no-notice figures lag behind the run."""
    if dataset != fixed.NN:
        return start, end
    latest = as_of - timedelta(days=fixed.NN_LAG_DAYS)
    return min(start, latest), min(end, latest)


def run_range(
    spark: SparkSession,
    landing: dict[str, str | list[str]],
    pipes: DataFrame,
    tables: Tables,
    start: date,
    end: date,
    run_ts: datetime,
    parent: str,
    availability: DataFrame | None = None,
    target_day: date | None = None,
    keep_run_gold: bool = False,
    failure_log: str | None = None,
) -> None:
    """Process the posted files of the gas days [start, end] and replace their slices.

    ``landing`` names the folder (or files) of each dataset. No-notice postings are
    taken for the days they can be there for, four days before the run at the latest.
    Files that another run has landed are not read again. Of postings of one unit only the
    newest ever landed counts; the days that an older one held are built anew too. Rows of
    other days wait for their own run. Rows without a readable day are rejected by
    name in the run that landed them. ``keep_run_gold`` also keeps the run's gold rows as a table of
    their own. With ``availability`` the datasets that were not delivered are listed,
    and of a run over one day also added to ``failure_log``.
    """
    if end > run_ts.date():
        raise ValueError(f"{end} is in the future of the run at {run_ts}")

    def chosen(dataset: str, rows: DataFrame) -> DataFrame:
        first, last = days_of(dataset, start, end, run_ts.date())
        return rows.where(F.col("GasDay").between(F.lit(first), F.lit(last)))

    run_days(spark, landing, pipes, tables, chosen, run_ts, parent, availability, target_day,
             keep_run_gold, failure_log)


def run_days(
    spark: SparkSession,
    landing: dict[str, str | list[str]],
    pipes: DataFrame,
    tables: Tables,
    chosen: Callable[[str, DataFrame], DataFrame],
    run_ts: datetime,
    parent: str,
    availability: DataFrame | None = None,
    target_day: date | None = None,
    keep_run_gold: bool = False,
    failure_log: str | None = None,
) -> None:
    """Land what is new and build the slices of the gas days that ``chosen`` takes.

    ``chosen`` is given a dataset and rows with a ``GasDay`` and returns those to run. Added to them
    are the days that postings held which this run's have replaced: each slice is
    built anew from all current postings, or emptied if none is left.
    """
    run = run_name(run_ts, parent)
    of_parent = pipes.where(F.col("ParentPipe") == parent)
    land(spark, landing, tables, run)
    raw, days = {}, {}
    for dataset in [d for d in landing if d != fixed.META]:
        index = posting_days(spark, tables.postings, dataset)
        if index.isEmpty():
            continue
        files = materialise(current_files(index), "current-postings")
        taken = chosen(dataset, index).where("GasDay IS NOT NULL").select("GasDay")
        days[dataset] = materialise(taken.unionByName(left_days(index, files, run)).distinct(), "days")
        raw[dataset] = current_rows(spark, tables, dataset, days[dataset], run)
    if not raw:
        raise ValueError("nothing was posted")
    meta_raw = None
    if fixed.META in landing and not posting_days(spark, tables.postings, fixed.META).isEmpty():
        meta_raw = current_rows(spark, tables, fixed.META)

    silver = {}
    for dataset, rows in raw.items():
        write_silver(to_silver(rows, of_parent, dataset), tables.silver, dataset, run, target_day)
        silver[dataset] = read_silver(spark, tables.silver, dataset, run)

    meta = None if meta_raw is None else meta_enrichment(meta_raw, pipes, parent)
    found = discover_locations(silver, meta, of_parent, tables, parent, run_ts)
    locations = current_locations(spark, tables)

    gold = to_gold(silver, locations, run_ts, parent, tables.latest_cycle)
    if keep_run_gold:
        where = f"{tables.gold_runs}/run={run}"
        with shuffles_removed(spark):
            gold.distinct().write.mode("overwrite").parquet(where)
        gold = spark.read.schema(gold.schema).parquet(where)
    # The facts are views of the written silver, but for the latest cycle, which has to be found.
    merge_slices(
        gold, tables.gold, GOLD_EXTRA, posted=posted_slices(days, parent),
        aside=tables.latest_cycle and not keep_run_gold,
    )

    write_run(run_rejects(raw, silver, of_parent, locations), tables.rejects, run)
    posted = write_audit(raw, silver, found, tables, run, meta_raw)
    if availability is not None:
        missing = missing_downloads(availability, posted)
        write_run(missing, f"{tables.audit}/missing", run)
        if failure_log is not None and target_day is not None:
            append_failures(
                missing.select(
                    F.col("pipe_code").alias("pipecode"),
                    F.col("dataset_type").alias("type"),
                    F.lit(target_day).alias("scrape_date"),
                ),
                failure_log,
            )


def write_audit(
    raw: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    found: dict[str, DataFrame],
    tables: Tables,
    run: str,
    meta: DataFrame | None = None,
) -> DataFrame:
    """Write the audit tables of a run; returns its counts per dataset and pipe, attributes included."""
    raw = raw if meta is None else {**raw, fixed.META: meta}
    files = [
        file_counts(rows, "PipeCode", "PostingFile").withColumn("Dataset", F.lit(dataset))
        for dataset, rows in raw.items()
    ]
    # The rows of bronze are counted once; all that follows is from a row per posting.
    counted = materialise(union_by_name(*files), "file-counts")
    write_run(counted, f"{tables.audit}/raw_files", run)
    posted = union_by_name(*[
        counts_of_files(counted.where(F.col("Dataset") == dataset), dataset) for dataset in raw
    ])
    written = union_by_name(*[
        silver_counts(rows.withColumn("Dataset", F.lit(dataset)))
        for dataset, rows in silver.items()
    ])
    detail = dataset_detail(posted, written, new_location_counts(found))
    write_run(detail, f"{tables.audit}/dataset_detail", run)
    cycles = [cycle_counts(rows, dataset) for dataset, rows in silver.items() if dataset in CYCLE_COLUMN]
    if tables.latest_cycle and cycles:
        write_run(union_by_name(*cycles), f"{tables.audit}/cycles", run)
    return posted


def run_day(
    spark: SparkSession,
    landing: dict[str, str | list[str]],
    pipes: DataFrame,
    tables: Tables,
    day: date,
    run_ts: datetime,
    parent: str,
    **options,
) -> None:
    """``run_range`` over one day, which also names the day in silver."""
    run_range(
        spark, landing, pipes, tables, day, day, run_ts, parent, target_day=day, **options
    )


def run_daily(
    spark: SparkSession,
    landing: dict[str, str | list[str]],
    pipes: DataFrame,
    tables: Tables,
    run_ts: datetime,
    parent: str,
    **options,
) -> None:
    """``run_range`` over yesterday and the run's own day."""
    run_range(spark, landing, pipes, tables, *daily_range(run_ts.date()), run_ts, parent, **options)


def run_historic(
    spark: SparkSession,
    landing: dict[str, str | list[str]],
    pipes: DataFrame,
    tables: Tables,
    run_ts: datetime,
    parent: str,
    **options,
) -> None:
    """``run_range`` over the year whose postings have become final, as one job."""
    run_range(
        spark, landing, pipes, tables, *historic_range(run_ts.date()), run_ts, parent, **options
    )


def rebuild_slices(
    spark: SparkSession,
    touched: dict[str, DataFrame],
    pipes: DataFrame,
    tables: Tables,
    run_ts: datetime,
    parent: str,
) -> None:
    """Build slices anew from all their current bronze rows and replace them.

    ``touched`` holds the gas days per dataset; see ``current_rows`` for what is read.
    """
    locations = current_locations(spark, tables)
    silver, days = {}, {}
    for dataset, some_days in touched.items():
        distinct = materialise(some_days.select("GasDay").distinct(), "days")
        if not distinct.isEmpty():
            days[dataset] = distinct
            # ``merge_slices`` makes the facts distinct.
            silver[dataset] = to_silver(current_rows(spark, tables, dataset, distinct), pipes, dataset, repeats=True)
    if silver:
        gold = to_gold(silver, locations, run_ts, parent, tables.latest_cycle)
        merge_slices(gold, tables.gold, GOLD_EXTRA, posted=posted_slices(days, parent), aside=tables.latest_cycle)
