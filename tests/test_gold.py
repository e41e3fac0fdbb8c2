"""Segment directions, gold transforms, silver and rejects on edge rows."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from linepack import fixed
from linepack import operators as O
from linepack.schemas import FACT, NN_SILVER, OA_SILVER, SG_SILVER, texts

RUN_TS = datetime(2026, 1, 15, 6, 30)
DAY = date(2026, 1, 5)


def sg(spark, *rows):
    return spark.createDataFrame(
        [(name, cap, nom, cap2, DAY, "Timely", "001") for name, cap, nom, cap2 in rows], SG_SILVER
    )


@pytest.mark.parametrize("row, want", [
    ((10.0, -3.0, None), [(10.0, 3.0, "TD2")]),
    ((-10.0, 3.0, None), [(10.0, 3.0, "TD1")]),
    ((10.0, 0.0, None), [(10.0, 0.0, "TD1")]),
    ((10.0, -3.0, 8.0), [(10.0, 0.0, "TD1"), (8.0, 3.0, "TD2")]),
    ((10.0, 3.0, -8.0), [(8.0, 0.0, "TD2"), (10.0, 3.0, "TD1")]),
    ((10.0, 0.0, 8.0), [(8.0, 0.0, "TD2"), (10.0, 0.0, "TD1")]),
    ((10.0, None, 8.0), []),
    ((10.0, None, None), []),
    ((None, 3.0, None), [(None, 3.0, "TD1")]),
])
def test_direction_table(spark, row, want):
    got = O.sg_directions(sg(spark, ("A", *row))).select("OpCap", "Nom", "FlowInd").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_segment_gold_joins_by_exact_name_and_fans_out(spark):
    silver = sg(spark, ("A", 10.0, -3.0, 8.0), ("a", 1.0, 1.0, None), (None, 1.0, 1.0, None),
                (None, None, None, None), ("B", None, None, None))
    locations = spark.createDataFrame(
        [("001", "A", "001GF00001"), ("001", "A", "0010000007"), ("002", "A", "002GF00001"),
         ("001", "B", "001GF00002")],
        "GFPipeID string, LocName string, GFLocID string",
    )
    rows = O.gold_sg(silver, locations).select(
        "GFLocID", "OperatingCapacity", "TotalScheduledQuantity", "OperationallyAvailableCapacity",
        "FlowDirection", "GasMonth", "IT", "DesignCapacity",
    ).collect()
    assert sorted(map(tuple, rows)) == [
        ("0010000007", 8.0, 3.0, 5.0, "B", 202601, None, None),
        ("0010000007", 10.0, 0.0, 10.0, "F", 202601, None, None),
        ("001GF00001", 8.0, 3.0, 5.0, "B", 202601, None, None),
        ("001GF00001", 10.0, 0.0, 10.0, "F", 202601, None, None),
    ]


def test_every_segment_row_is_in_gold_or_in_rejects(spark):
    silver = sg(spark, ("A", 10.0, -3.0, 8.0), (None, 1.0, 1.0, None), (None, None, None, None),
                ("B", 1.0, None, None), ("C", 1.0, 1.0, None))
    locations = spark.createDataFrame([("001", "A", "x")], "GFPipeID string, LocName string, GFLocID string")
    reasons = O.silver_rejects(silver, fixed.SG).unionByName(O.unmatched_stations(silver, locations))
    assert sorted((r.Location or "", r.Reason, r.Dropped) for r in reasons.collect()) == [
        ("", "no figures and no name", True), ("", "no station name", True),
        ("B", "no nomination", True), ("B", "station without location", True),
        ("C", "station without location", True),
    ]


def _oa(spark, **changes):
    base = dict.fromkeys(OA_SILVER.names)
    base.update(
        Cycle_Desc="Timely", Eff_Gas_Day="01-05-2026", Loc="123", Loc_Name=" Point ", Flow_Ind_Desc="Receipt",
        IT="Y", Total_Design_Capacity="1,000", Operating_Capacity="900.5", Total_Scheduled_Quantity="0",
        Operationally_Available_Capacity="-1", PipeName="Pipe", GFLocID="0010000123",
    )
    return {**base, **changes}


def test_oa_gold(spark):
    silver = spark.createDataFrame([_oa(spark)], OA_SILVER)
    gold = O.gold_oa(silver)
    assert gold.schema.names == FACT.names
    assert [f.dataType for f in gold.schema] == [f.dataType for f in FACT]
    assert tuple(gold.first()) == (
        202601, DAY, "OA", "0010000123", "Point", 1000.0, 900.5, 0.0, -1.0, "Y", "R", None,
    )


def test_bad_days_and_figures_are_rejected_row_by_row(spark):
    silver = spark.createDataFrame(
        [_oa(spark), _oa(spark, Eff_Gas_Day="2026-01-05"), _oa(spark, Eff_Gas_Day=None),
         _oa(spark, Operating_Capacity="abc")], OA_SILVER,
    )
    assert O.gold_oa(silver).count() == 2
    found = O.silver_rejects(silver, fixed.OA).collect()
    assert sorted((r.Reason, r.Dropped) for r in found) == [
        ("Operating_Capacity is not a quantity", False), ("no gas day", True), ("no gas day", True),
    ]
    with pytest.raises(Exception, match="unreadable gas day"):
        O.gold_oa(silver, strict=True).collect()


def test_cycles_of_a_day_collapse_only_when_equal(spark):
    silver = spark.createDataFrame(
        [_oa(spark), _oa(spark, Cycle_Desc="Evening"),
         _oa(spark, Cycle_Desc="Late", Operating_Capacity="1")], OA_SILVER,
    )
    gold = O.merge_gold(O.gold_oa(silver), run_ts=RUN_TS)
    assert gold.count() == 2
    assert {row.Timestamp for row in gold.collect()} == {RUN_TS}


def test_nn_gold(spark):
    silver = spark.createDataFrame(
        [("1/5/2026 9:00", "7", "Point ", "1,234.50", " B", "A", "Pipe", "0010000007")], NN_SILVER
    )
    assert tuple(O.gold_nn(silver).first()) == (
        202601, DAY, "NN", "0010000007", "Point", None, None, 1234.5, None, None, "N", None,
    )


PIPES = [("Parent", "Pipe", "001", "P1"), ("Other", "Else", "002", "P2")]


def test_point_silver_keys_strips_and_dedups(spark):
    pipes = spark.createDataFrame(PIPES, texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"]))
    raw = spark.createDataFrame(
        [(" 123\t", "a", "P1", "f"), ("123", "a", "P1", "g"), ("12345678", "b", "P1", "f"),
         (None, "c", "P2", "f"), ("-12", "d", "P1", "f"), ("9", "e", "P9", "f")],
        "Loc string, Loc_Name string, PipeCode string, PostingFile string",
    )
    silver = O.point_silver(raw, pipes, "Loc")
    assert sorted(silver.columns) == ["GFLocID", "Loc", "Loc_Name", "PipeName"]
    got = sorted((tuple(r) for r in silver.select("GFLocID", "Loc", "Loc_Name", "PipeName").collect()), key=str)
    assert got == [
        ("0010000123", "123", "a", "Pipe"), ("00112345678", "12345678", "b", "Pipe"), (None, None, "c", "Else"),
    ]
    found = sorted((r.Location or "", r.Reason, r.Dropped) for r in O.point_rejects(raw, pipes, fixed.OA).collect())
    assert found == [
        ("", "no location", False), ("-12", "location starts with a sign", True), ("9", "unknown pipe", True),
    ]


def test_segment_silver_reads_text_and_lists_bad_numbers(spark):
    pipes = spark.createDataFrame(PIPES, texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"]))
    raw = spark.createDataFrame(
        [("A", "1.5", "-2", None, DAY, "T", "P1"), ("B", "x", "1", None, DAY, "T", "P1")],
        "`Station Name` string, Cap string, Nom string, Cap2 string, EffGasDate date, CycleDesc string, PipeCode string",
    )
    silver = O.segment_silver(raw, pipes)
    assert silver.schema["Cap"].dataType.typeName() == "double"
    assert sorted(tuple(r) for r in silver.select("`Station Name`", "Cap", "Nom", "GFPipeID").collect()) == [
        ("A", 1.5, -2.0, "001"), ("B", None, 1.0, "001"),
    ]
    found = O.segment_rejects(raw, pipes).collect()
    assert [(r.Location, r.Reason) for r in found] == [("B", "Cap is not a number")]


def test_drop_all_null_and_conform(spark):
    df = spark.createDataFrame([(None, None, 1), ("x", None, 2)], "a string, b string, c int")
    assert [r.c for r in O.drop_all_null(df, ["a", "b"]).collect()] == [2]
    fact = O.conform(spark.createDataFrame([(DAY,)], "GasDay date"), FACT)
    assert fact.schema.names == FACT.names and fact.first().GasDay == DAY


def test_directions_against_brute_force(spark):
    """Random rows, each compared with the direction table worked out row by row."""
    draw = random.Random(7)
    figures = [None, -3.5, -1.0, 0.0, 1.0, 2.5]
    rows = [(f"S{n}", draw.choice(figures), draw.choice(figures), draw.choice(figures)) for n in range(600)]

    def expected(name, cap, nom, cap2):
        if nom is None:
            return []
        size = lambda x: None if x is None else abs(x)
        if cap2 is None:
            return [(name, size(cap), abs(nom), "TD2" if nom < 0 else "TD1")]
        forward, backward = (0.0, abs(nom)) if nom < 0 else (abs(nom), 0.0)
        return [(name, size(cap), forward, "TD1"), (name, abs(cap2), backward, "TD2")]

    want = sorted((out for row in rows for out in expected(*row)), key=str)
    got = O.sg_directions(sg(spark, *rows)).select("`Station Name`", "OpCap", "Nom", "FlowInd").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert all((r.OpCap or 0) >= 0 and r.Nom >= 0 for r in got)


def test_latest_cycle_of_each_figure(spark):
    def oa(cycle, cap, **changes):
        return _oa(spark, Cycle_Desc=cycle, Operating_Capacity=cap, **changes)

    rows = spark.createDataFrame([
        oa("Timely", "1"), oa("ID 2", "2"), oa("Intraday 1", "3"), oa("INTRADAY-2", "4"), oa(None, "5"), oa("odd", "6"),
        oa("Timely", "7", Loc_Name="Elsewhere", GFLocID="0010000009"), oa("Evening", "8", Eff_Gas_Day="1-5-2026"),
        oa("Evening", "9", Flow_Ind_Desc="Delivery"), oa(None, "10", Eff_Gas_Day=None), oa("odd", "11", Eff_Gas_Day="soon"),
        oa("Timely", "12", IT="I"),
    ], OA_SILVER)
    kept = O.latest_cycle(rows, "OA")
    assert sorted(int(r.Operating_Capacity) for r in kept.collect()) == [2, 4, 7, 9, 10, 11, 12]
    assert kept.schema == rows.schema
    assert O.latest_cycle(rows.limit(0), "OA").count() == 0
    counted = {r.cycle: (r.silver_records, r.known) for r in O.cycle_counts(rows, "OA").collect()}
    assert counted["Timely"] == (3, True) and counted["odd"] == (2, False) and counted[None] == (2, False)
    sg = spark.createDataFrame(
        [("A", 1.0, "Timely"), ("A", 2.0, "Final"), ("A", 3.0, "Final"), (None, 4.0, "Timely"), (None, 5.0, "Evening")],
        "`Station Name` string, Cap double, CycleDesc string",
    ).withColumns({"GFPipeID": F.lit("001"), "EffGasDate": F.lit(date(2026, 1, 5))})
    assert sorted(r.Cap for r in O.latest_cycle(sg, "SG").collect()) == [2.0, 3.0, 5.0]
    nn = spark.range(3)
    assert O.latest_cycle(nn, "NN") is nn
