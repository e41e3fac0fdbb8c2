"""New locations, numbering, enrichment, upsert and attribute changes."""

from __future__ import annotations

from datetime import date, datetime

from linepack import operators as O
from linepack import sinks
from linepack.fixed import LOCATION_COLUMNS
from linepack.schemas import SG_SILVER, texts
from linepack.shared import new_folder

RUN_TS = datetime(2026, 1, 15, 6, 30)
PIPES = texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"])


def pipes(spark):
    return spark.createDataFrame(
        [("Parent", "One", "001", "P1"), ("Parent", "Two", "002", "P2"), ("Other", "Three", "003", "P3")], PIPES
    )


def stations(spark, *pairs):
    return spark.createDataFrame(
        [(name, 1.0, 1.0, None, date(2026, 1, 5), "T", pipe) for pipe, name in pairs], SG_SILVER
    )


def known(spark, *rows):
    return spark.createDataFrame(
        list(rows), "GFPipeID string, LocID string, GFLocID string, LocName string, Loc string"
    )


def test_new_stations_are_numbered_per_pipe_by_name(spark):
    silver = stations(spark, ("001", "b"), ("001", "a"), ("001", "a"), ("001", None), ("002", "b"),
                      ("002", "a"), ("002", "old"), ("002", None))
    locations = known(spark, ("002", "GF00001", "002GF00001", "old", ""),
                      ("002", "GF00002", "002GF00002", "older", None), ("002", "0000007", "0020000007", "x", "7"))
    new = O.new_segment_locations(silver, locations, pipes(spark), RUN_TS)
    assert new.columns == LOCATION_COLUMNS
    got = sorted((r.GFLocID, r.LocName, r.PipeName, r.UpdatedTime, r.Loc) for r in new.collect())
    assert got == [
        ("001GF00001", "a", "One", RUN_TS, ""), ("001GF00002", "b", "One", RUN_TS, ""),
        ("002GF00003", "a", "Two", RUN_TS, ""), ("002GF00004", "b", "Two", RUN_TS, ""),
    ]


def test_numbering_again_finds_nothing_new(spark):
    silver = stations(spark, ("001", "b"), ("001", "a"))
    empty = known(spark, ("009", "x", "x", "x", "x"))
    first = O.new_segment_locations(silver, empty, pipes(spark), RUN_TS)
    table = O.upsert_by_key(O.keyed(empty, "Parent"), O.keyed(first, "Parent"))
    assert O.new_segment_locations(silver, table, pipes(spark), RUN_TS).count() == 0


def test_numbering_after_the_highest_number(spark):
    locations = known(spark, ("001", "GF00009", "001GF00009", "old", ""))
    new = O.new_segment_locations(stations(spark, ("001", "a")), locations, pipes(spark), RUN_TS, after_max=True)
    assert new.first().LocID == "GF00010"


def test_running_number_over_a_hot_group(spark):
    """Most rows in one group: numbers are dense, unique and in order."""
    rows = spark.range(5000).selectExpr(
        "if(id % 10 < 7, 'hot', concat('g', id % 10)) AS grp", "lpad(CAST(id * 7919 % 5000 AS string), 6, '0') AS name"
    )
    numbered = O.running_number(rows, "grp", "name", "n").toPandas()
    for _, part in numbered.groupby("grp"):
        part = part.sort_values("name")
        assert list(part.n) == list(range(1, len(part) + 1))


def test_new_points(spark):
    silver = spark.createDataFrame(
        [("7", "B ", "0010000007", "One"), ("7", "A", "0010000007", "One"), ("8", "C", "0010000008", "One"),
         (None, "D", None, "One"), ("9", None, "0010000009", "One")],
        "Loc string, Loc_Name string, GFLocID string, PipeName string",
    )
    meta = O.meta_enrichment(
        spark.createDataFrame(
            [("7", "A", "TX", None, "Z1", "D", "T", "P1"), (" 7", "A", "TX", None, "Z1", "R", "T", "P1"),
             ("7", "A", "TX", None, "Z1", "R", "T", "P3")],
            "Loc string, `Loc Name` string, `Loc St Abbrev` string, `Loc Cnty` string, `Loc Zone` string, "
            "`Dir Flo` string, `Loc Type Ind` string, PipeCode string",
        ), pipes(spark), "Parent",
    )
    assert [(r.GFLocID, r["Dir Flo"], r.County) for r in meta.collect()] == [("0010000007", "D", "")]
    new = O.new_point_locations(silver, known(spark, ("001", "x", "0010000008", "x", "8")), meta, RUN_TS)
    assert new.columns == LOCATION_COLUMNS
    got = sorted((r.GFLocID, r.LocName, r.LocID, r.GFPipeID, r.State, r.LocSegment) for r in new.collect())
    assert got == [("0010000007", "A", "0000007", "001", "TX", ""), ("0010000009", None, "0000009", "001", None, "")]


def test_upsert_merges_by_key(spark):
    stored = spark.createDataFrame([("k1", "a", "x"), ("k2", "b", None)], "RowKey string, v string, keep string")
    rows = spark.createDataFrame([("k2", "c", 1), ("k3", None, 2)], "RowKey string, v string, extra int")
    got = sorted(tuple(r) for r in O.upsert_by_key(stored, rows).select("RowKey", "v", "keep", "extra").collect())
    assert got == [("k1", "a", "x", ""), ("k2", "c", "", "1"), ("k3", "", "", "2")]


def test_upsert_of_a_repeated_key_is_repeatable(spark):
    stored = spark.createDataFrame([], "RowKey string, v string, UpdatedTime string")
    rows = spark.createDataFrame([("k", "z", "1"), ("k", "a", "2")], stored.schema)
    assert [tuple(r) for r in O.upsert_by_key(stored, rows).collect()] == [("k", "a", "2")]


def test_meta_changes(spark):
    header = "Loc string, `Loc Name` string, `Loc Zone` string, PipeCode string"
    posted = spark.createDataFrame(
        [("1", "same", "Z1", "P1"), ("1", "same ", "Z1", "P1"), ("2", "zone", "Z2", "P1"),
         ("3", "new", None, "P1")], header,
    )
    stored = spark.createDataFrame(
        [("1", "same", "Z1", "P1", "Parent", "k", "d"), ("2", "zone", "Z1", "P1", "Parent", "k", "d")],
        "Loc string, LocName string, LocZone string, PipeCode string, PartitionKey string, RowKey string, ChangedOn string",
    )
    got = sorted((r.Loc, r.LocZone, r.RowKey, r.ChangedOn)
                 for r in O.meta_changes(posted, stored, date(2026, 1, 15), "Parent").collect())
    assert got == [("2", "Z2", "20260115ParentP12", "20260115"), ("3", "", "20260115ParentP13", "20260115")]


def test_versions(spark):
    path = new_folder(spark, "versions")
    assert sinks.read_version(spark, path) is None
    for n in (1, 2):
        sinks.write_version(spark.createDataFrame([(n,)], "n int"), path)
        assert [r.n for r in sinks.read_version(spark, path).collect()] == [n]
