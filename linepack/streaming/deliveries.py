"""Deliveries that are late, told once by a stream and withdrawn when they come.

A unit is a (pipe, dataset, gas day). Announced units carry a deadline; landed postings
say when a unit came. Both are streams, and the state of each unit is kept between calls
with a timer at its deadline, so neither history is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import fixed
from ..functions import pipe_of_posting
from ..operators.audit import offered_units
from ..plans.jobs import Tables

UNIT = ["pipe_code", "dataset_type", "gas_day"]
EXPECTED = "pipe_code string, dataset_type string, gas_day date, deadline timestamp, clock timestamp"
EVENTS = "pipe_code string, dataset_type string, gas_day date, state string, at timestamp"

_POSTED = "PostingFile string, GasDay date, Dataset string, run string"
_OUTPUT = "pipe_code string, dataset_type string, gas_day date, state string, at_ms long"
_DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What has been told about a unit.
_NOTHING, _LATE, _SETTLED = 0, 1, 2


class Punctuality(StatefulProcessor):
    """Tells ``late`` once for a unit that has not come by its deadline, and ``came`` when it does.

    A unit that came in time, or was never announced, gives no row. Of several deadlines the
    latest counts, of several deliveries the first. What is known of a unit is forgotten
    ``keep_days`` after its deadline (or, unannounced, after it came).
    """

    def __init__(self, keep_days: int) -> None:
        self.keep_ms = keep_days * _DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.unit = handle.getValueState("unit", "deadline_ms long, came_ms long, told int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        deadline, came, told = self.unit.get() if self.unit.exists() else (None, None, _NOTHING)
        deadlines = [] if deadline is None else [deadline]
        arrivals = [] if came is None else [came]
        for row in rows:
            if row.deadline_ms is not None:
                deadlines.append(row.deadline_ms)
            if row.came_ms is not None:
                arrivals.append(row.came_ms)
        if not deadlines and not arrivals:
            return
        known, deadline = deadline, max(deadlines, default=None)
        came = min(arrivals, default=None)
        if deadline is not None and came is not None and told != _SETTLED:
            if told == _NOTHING and came > deadline:
                yield self._row(key, "late", deadline)
                told = _LATE
            if told == _LATE:
                yield self._row(key, "came", came)
            told = _SETTLED
        self.unit.update((deadline, came, told))
        if deadline is None:
            self.handle.registerTimer(came + self.keep_ms)
        elif deadline != known:
            if came is None:
                self.handle.registerTimer(deadline)
            self.handle.registerTimer(deadline + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.unit.exists():
            return
        deadline, came, told = self.unit.get()
        now = expiredTimerInfo.getExpiryTimeInMs()
        if now >= (came if deadline is None else deadline) + self.keep_ms:
            self.unit.clear()
        elif deadline is not None and now >= deadline and came is None and told == _NOTHING:
            yield self._row(key, "late", deadline)
            self.unit.update((deadline, came, _LATE))

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, state: str, at_ms: int) -> Row:
        pipe_code, dataset_type, gas_day = key
        return Row(pipe_code=pipe_code, dataset_type=dataset_type, gas_day=gas_day, state=state, at_ms=at_ms)


def expected_units(availability: DataFrame, start: date, end: date, after: timedelta) -> DataFrame:
    """The units that the pipes offer for the gas days [start, end], each with its deadline.

    The deadline is the start of the gas day plus ``after``; no-notice figures have their
    lag of days on top. Attributes have no gas day and are not expected.
    """
    days = F.sequence(F.lit(start), F.lit(end))
    lag = F.when(F.col("dataset_type") == fixed.NN, fixed.NN_LAG_DAYS).otherwise(0)
    units = offered_units(availability).where(F.col("dataset_type") != fixed.META)
    return units.withColumn("gas_day", F.explode(days)).withColumn(
        "deadline", F.date_add("gas_day", lag).cast("timestamp") + F.lit(after)
    )


def expect(units: DataFrame, path: str, run: str) -> None:
    """Announce units; a run that is repeated announces the same again, which changes nothing."""
    units.select(*UNIT, "deadline", F.lit(None).cast("timestamp").alias("clock")).write.mode("overwrite").parquet(
        f"{path}/run={run}"
    )


def landed_units(spark: SparkSession, tables: Tables) -> DataFrame:
    """A stream of the units that postings brought, and when: the index that runs write as they land."""
    return (
        spark.readStream.schema(_POSTED)
        .option("ignoreMissingFiles", True)  # a run that is repeated replaces its part of the index
        .parquet(tables.postings)
        .where("GasDay IS NOT NULL")
        .select(
            pipe_of_posting(F.col("PostingFile")).alias("pipe_code"),
            F.col("Dataset").alias("dataset_type"),
            F.col("GasDay").alias("gas_day"),
            F.col("_metadata.file_modification_time").alias("at"),
        )
    )


def watch_deliveries(
    spark: SparkSession,
    expected: str,
    delivered: DataFrame,
    events: str,
    checkpoint: str,
    now: datetime,
    keep_days: int = 60,
    state_partitions: int = 4,
) -> None:
    """Take in what was announced and delivered since the last call, and tell what is late at ``now``.

    ``expected`` is the folder that ``expect`` writes; ``delivered`` a stream with the columns of
    a unit and ``at``. New rows of ``EVENTS`` are appended to the table ``events``, once each: the
    sink and the checkpoint agree on what was written, so a call that broke off is repeated by the next.

    Time is that of the calls, not of the rows: however old a delivery is when it is first
    seen, it is not dropped as late. Each call enters its own time with the announcements, so that
    deadlines pass also when nothing comes; a call whose clock is behind counts at the time of
    the call before. Deadlines within the last second are told by the next call.

    State has a row per unit of the last ``keep_days``, few beside the rows of the postings;
    ``state_partitions`` says how many tasks share it and stays as the first call set it.
    """
    now = max(now, _last_clock(spark, expected) or now)
    clock = spark.createDataFrame([(None, None, None, None, now)], EXPECTED)
    clock.coalesce(1).write.mode("append").parquet(f"{expected}/run=clock")
    announced = (
        spark.readStream.schema(f"{EXPECTED}, run string")
        .option("ignoreMissingFiles", True)
        .parquet(expected)
        .select(*UNIT, F.unix_millis("deadline").alias("deadline_ms"), F.lit(None).cast("long").alias("came_ms"))
    )
    came = delivered.select(
        *UNIT, F.lit(None).cast("long").alias("deadline_ms"), F.unix_millis(F.col("at").cast("timestamp")).alias("came_ms")
    )
    told = (
        announced.unionByName(came)
        .withColumn("seen", F.lit(now).cast("timestamp"))
        .withWatermark("seen", "1 second")
        .groupBy(*UNIT)
        .transformWithState(Punctuality(keep_days), _OUTPUT, "Append", "EventTime")
        .select(*UNIT, "state", F.timestamp_millis("at_ms").alias("at"))
    )
    # A query keeps the settings it started with: the store that timers need, and its partitions.
    settings = {_PROVIDER: _ROCKSDB, _PARTITIONS: str(state_partitions)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        query = (
            told.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .format("parquet")
            .start(events)
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    query.awaitTermination()


def _last_clock(spark: SparkSession, expected: str) -> datetime | None:
    try:
        rows = spark.read.schema(EXPECTED).parquet(f"{expected}/run=clock")
        return rows.agg(F.max("clock")).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def late_units(events: DataFrame) -> DataFrame:
    """Units that were told late and have not come since, with their deadline."""
    return (
        events.groupBy(*UNIT)
        .agg(F.min(F.when(F.col("state") == "late", F.col("at"))).alias("deadline"), F.bool_or(F.col("state") == "came").alias("came"))
        .where("NOT came")
        .drop("came")
    )
