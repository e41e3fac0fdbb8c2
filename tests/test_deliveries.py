"""Late deliveries: told once at the deadline, withdrawn when they come."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linepack import streaming
from linepack.plans import Tables
from linepack.shared import new_folder
from linepack.sinks import enter_days
from linepack.streaming.deliveries import EXPECTED, UNIT

DAY = date(2026, 1, 5)
_DELIVERED = "pipe_code string, dataset_type string, gas_day date, at timestamp"


class Watch:
    """One installation's folders, with short ways to announce, deliver and look."""

    def __init__(self, spark):
        self.spark = spark
        self.expected, self.landed = new_folder(spark, "expected"), new_folder(spark, "landed")
        self.events, self.checkpoint = new_folder(spark, "events"), new_folder(spark, "watch")
        spark.createDataFrame([], _DELIVERED).write.parquet(self.landed)

    def expect(self, run, *units):
        rows = [(pipe, "OA", DAY, datetime(2026, 1, 5, hour), None) for pipe, hour in units]
        streaming.expect(self.spark.createDataFrame(rows, EXPECTED), self.expected, run)

    def deliver(self, pipe, at):
        rows = self.spark.createDataFrame([(pipe, "OA", DAY, at)], _DELIVERED)
        rows.write.mode("append").parquet(self.landed)

    def look(self, now, keep_days=60):
        delivered = self.spark.readStream.schema(_DELIVERED).parquet(self.landed)
        streaming.watch_deliveries(
            self.spark, self.expected, delivered, self.events, self.checkpoint, now, keep_days
        )
        rows = self.spark.read.parquet(self.events)
        return sorted(((r.pipe_code, r.state, r.at.hour) for r in rows.collect()), key=str)

    def late(self):
        return sorted(r.pipe_code for r in streaming.late_units(self.spark.read.parquet(self.events)).collect())


@pytest.fixture
def watch(spark):
    return Watch(spark)


def at(hour, day=5):
    return datetime(2026, 1, day, hour)


def test_late_is_told_once_and_withdrawn(watch):
    watch.expect("r1", ("early", 12), ("late", 12), ("never", 12), ("open", 20))
    watch.deliver("early", at(9))
    assert watch.look(at(11)) == []
    told = [("late", "late", 12), ("never", "late", 12)]
    assert watch.look(at(13)) == told and watch.late() == ["late", "never"]
    assert watch.look(at(14)) == told
    watch.deliver("late", at(15))
    watch.deliver("late", at(16))
    told = [("late", "came", 15), *told]
    assert watch.look(at(17)) == told and watch.late() == ["never"]
    watch.expect("r1", ("early", 12), ("late", 12), ("never", 12), ("open", 20))  # the run is repeated
    watch.deliver("early", at(18))
    assert watch.look(at(19)) == told
    assert watch.look(at(21)) == [*told, ("open", "late", 20)]


def test_deliveries_that_are_first_seen_behind_their_deadline(watch):
    watch.expect("r1", ("intime", 12), ("behind", 12))
    watch.deliver("intime", at(12))
    watch.deliver("behind", at(13))
    assert watch.look(at(0, 6)) == [("behind", "came", 13), ("behind", "late", 12)] and watch.late() == []
    watch.expect("r2", ("old", 3))
    watch.deliver("old", at(2))  # older than all that was seen, and not dropped
    assert watch.look(at(1, 6)) == [("behind", "came", 13), ("behind", "late", 12)]


def test_deadlines_move_and_clocks_go_back(watch):
    watch.deliver("unasked", at(1))
    watch.expect("r1", ("moved", 10), (None, 10))
    watch.expect("r2", ("moved", 14), ("unasked", 10))
    nameless = (None, "late", 10)
    assert watch.look(at(12)) == [nameless]
    watch.expect("r3", ("behind", 11))
    assert watch.look(at(8)) == [("behind", "late", 11), nameless]  # counts at 12, the time of the call before
    assert watch.look(at(15)) == [("behind", "late", 11), ("moved", "late", 14), nameless]


def test_nothing_announced_and_nothing_delivered(watch):
    assert watch.look(at(9)) == []
    assert watch.late() == []


def test_units_are_forgotten(watch):
    watch.expect("r1", ("p", 12))
    assert watch.look(at(13), keep_days=1) == [("p", "late", 12)]
    watch.expect("r2", ("q", 12))
    watch.deliver("q", at(11))
    assert watch.look(at(13, 8), keep_days=1) == [("p", "late", 12)]
    watch.deliver("p", at(14, 8))
    assert watch.look(at(15, 8), keep_days=1) == [("p", "late", 12)]


def test_expected_units_of_the_calendar(spark):
    rows = [(("A (P1)", "A", "P1"), True, None, True, True), (("B (P2)", "B", "P2"), False, True, False, None)]
    availability = spark.createDataFrame(
        rows, "pipe struct<label string, name string, code string>, has_OA boolean, has_SG boolean, has_NN boolean, has_MetaData boolean"
    )
    units = streaming.expected_units(availability, DAY, DAY + timedelta(days=1), timedelta(hours=30))
    got = sorted((r.pipe_code, r.dataset_type, r.gas_day.day, r.deadline.day, r.deadline.hour) for r in units.collect())
    assert got == [
        ("P1", "NN", 5, 10, 6), ("P1", "NN", 6, 11, 6), ("P1", "OA", 5, 6, 6), ("P1", "OA", 6, 7, 6),
        ("P2", "SG", 5, 6, 6), ("P2", "SG", 6, 7, 6),
    ]


def test_landed_postings_are_deliveries(spark, watch):
    tables = Tables(new_folder(spark, "installation"))
    landed = spark.createDataFrame(
        [("P1_OA_20260105_INTRDY_2026-01-05_0800.csv", DAY), ("P1_OA_20260105_INTRDY_2026-01-05_0800.csv", None)],
        "PostingFile string, GasDay date",
    )
    enter_days(landed, tables.postings, "OA", "run1")
    units = spark.createDataFrame(
        [("P1", "OA", DAY, datetime(2100, 1, 1)), ("P1", "SG", DAY, datetime(2100, 1, 1))], _DELIVERED
    ).withColumnRenamed("at", "deadline")
    streaming.expect(units, watch.expected, "r1")
    for now in (datetime(2100, 1, 2), datetime(2100, 1, 3)):
        streaming.watch_deliveries(
            spark, watch.expected, streaming.landed_units(spark, tables), watch.events, watch.checkpoint, now
        )
    rows = spark.read.parquet(watch.events)
    assert [tuple(r) for r in rows.select(*UNIT, "state").collect()] == [("P1", "SG", DAY, "late")]
    assert rows.where(F.col("at") == F.lit("2100-01-01").cast("timestamp")).count() == 1
