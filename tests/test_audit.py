"""Audit tables, record checks and calendars."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from linepack import operators as O


def test_summary_of_no_results_is_zero(spark):
    runs = spark.createDataFrame(
        [("a", datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 1)), ("b", datetime(2026, 1, 1), None)],
        "pipeline string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    results = spark.createDataFrame([("a", True), ("a", False)], "pipeline string, success boolean")
    got = {r.pipeline: tuple(r)[1:] for r in O.run_summary(results, runs).collect()}
    assert got == {
        "a": (False, 2, 1, 1, 60.0, 50.0), "b": (False, 0, 0, 0, 0.0, 0.0), None: (True, 2, 1, 1, 60.0, 50.0),
    }
    nameless = runs.withColumn("pipeline", F.lit(None).cast("string"))
    assert sorted(r.is_total for r in O.run_summary(results, nameless).collect()) == [False, True]


def test_failures_name_an_unknown_error(spark):
    results = spark.createDataFrame(
        [("P1", "OA", datetime(2026, 1, 1, 5), False, 1.0, None), ("P1", "OA", datetime(2026, 1, 1), True, 1.0, None)],
        "pipe_code string, dataset_type string, date timestamp_ntz, success boolean, duration_s double, error string",
    )
    assert [tuple(r) for r in O.failures(results).collect()] == [("P1", "OA", date(2026, 1, 1), 1.0, "Unknown")]


def test_pipe_changes(spark):
    live = spark.createDataFrame([("Same ", "a1"), ("Renamed", "B1"), ("New", "C1")], "name string, code string")
    stored = spark.createDataFrame([("A1", "Same"), ("b1", "Old"), ("D1", "Gone")], "PipeCode string, PipeName string")
    assert sorted(map(tuple, O.pipe_changes(live, stored).select("change_type", "pipe_code").collect())) == [
        ("new", "C1"), ("removed", "D1"), ("renamed", "B1"),
    ]


def test_dataset_figures_on_the_first_pipe_only(spark):
    raw = spark.createDataFrame([("OA", "P2", 5, 1), ("OA", "P1", 4, 2)],
                                "dataset_type string, pipe_code string, raw_records long, raw_files long")
    silver = spark.createDataFrame([("OA", 8, 1)], "dataset_type string, silver_records long, silver_files long")
    new = O.new_location_counts({"OA": spark.range(3), "SG": spark.range(0)})
    assert {r.dataset_type: r.new_locations for r in new.collect()} == {"OA": 3, "SG": 0}
    rows = O.dataset_detail(raw, silver, new).orderBy("pipe_code").collect()
    assert [(r.pipe_code, r.silver_records, r.new_locations) for r in rows] == [("P1", 8, 3), ("P2", 0, 0)]


def test_record_checks(spark):
    pipes = spark.createDataFrame(
        [("ab1", "Parent", "Name", "1"), ("x", "P", "N", "1000"), (None, None, None, None)],
        "PipeCode string, ParentPipe string, PipeName string, GFPipeID string",
    )
    checked = O.validate_pipes(pipes)
    assert [r.PipeCode for r in O.valid(checked).collect()] == ["AB1"]
    every = "code length; parent length; name length; id is not three digits"
    assert [r.Reason for r in O.rejected(checked).collect()] == [every, every]
    results = spark.createDataFrame(
        [("P1", "OA", True, 0.0, None), ("P1", "XX", True, -1.0, "e"), ("P1", "SG", False, 1.0, "e")],
        "pipe_code string, dataset_type string, success boolean, duration_s double, error string",
    )
    assert [r.Reason for r in O.validate_results(results).collect()] == [
        None, "unknown dataset; negative duration; error on success", None,
    ]


def test_days(spark):
    spans = spark.createDataFrame([(date(2026, 1, 12), date(2026, 1, 20))], "a date, b date")
    days = O.expand_days(spans, "a", "b", F.lit(date(2026, 1, 14))).select("day", "nn_day").collect()
    assert [(r.day.day, r.nn_day.day) for r in days] == [(12, 10), (13, 10), (14, 10)]
    assert O.expand_days(spans, "a", "b", F.lit(date(2026, 1, 1))).count() == 0
    assert O.daily_range(date(2026, 1, 1)) == (date(2025, 12, 31), date(2026, 1, 1))
    start, end = O.historic_range(date(2026, 2, 15))
    assert end == date(2026, 1, 1) and (end - start).days == 365
