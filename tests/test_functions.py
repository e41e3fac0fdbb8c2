"""Column rules on hand-made edge values."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from linepack import fixed
from linepack import functions as L


def values(spark, items, kind, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    got = [list(row)[1:] for row in rows]
    return [row[0] for row in got] if len(columns) == 1 else got


X = F.col("x")


def test_strip_takes_every_kind_of_white_space(spark):
    texts = [" 123\t", " a b　", "\r\n\x0b\x0cx\x85", "", "\u2003", None]
    want = [None if s is None else s.strip() for s in texts]
    assert values(spark, texts, "string", L.strip(X)) == want
    assert all(c.isspace() for c in fixed.WHITE_SPACE)


def test_zfill_pads_and_never_cuts(spark):
    got = values(spark, ["123", "1234567", "12345678", "", None], "string", L.zfill(X, 7))
    assert got == ["0000123", "1234567", "12345678", "0000000", None]


def test_point_keys(spark):
    key = L.gf_loc_id(L.pipe_id(F.lit(7)), L.strip(X))
    got = values(spark, [" 123\t", "12345678", None], "string", key, L.pipe_of_gf_loc_id(key))
    assert got == [["0070000123", "007"], ["00712345678", "007"], [None, None]]


def test_gf_numbers(spark):
    assert values(spark, [1, 42, 99999, 100000], "int", L.gf_number(X)) == [
        "GF00001", "GF00042", "GF99999", "GF100000",
    ]


def test_quantities(spark):
    texts = ["1,234.50", "-5", "", "abc", "1.005", None, " 12 "]
    assert values(spark, texts, "string", L.quantity(X)) == [1234.5, -5.0, None, None, 1.01, None, 12.0]


def test_plain_numbers_only(spark):
    texts = ["1.5", "-3", " 7 ", "1e3", "1d", "NaN", "Infinity", "1,000", ".5", "5.", None]
    assert values(spark, texts, "string", L.number(X)) == [
        1.5, -3.0, 7.0, 1000.0, None, None, None, None, 0.5, 5.0, None,
    ]


def test_oa_days(spark):
    texts = ["01-05-2026", "1-5-2026", "2026-01-05", "13-45-2026", None]
    day = date(2026, 1, 5)
    assert values(spark, texts, "string", L.oa_day(X)) == [day, day, None, None, None]


def test_nn_days_and_months(spark):
    got = values(
        spark, ["12/31/2025 09:00", "1/5/2026 9:00", "bad", None], "string",
        L.nn_day(X), L.gas_month(L.nn_day(X)),
    )
    assert got == [[date(2025, 12, 31), 202512], [date(2026, 1, 5), 202601], [None, None], [None, None]]


def test_flows(spark):
    oa = ["Delivery ", "Receipt", "Storage Injection", "Storage Withdrawal", "Other", None]
    assert values(spark, oa, "string", L.oa_flow(X)) == ["D", "R", "D", "R", "Z", "Z"]
    nn = ["D", "R", "B", "X", " B ", None]
    assert values(spark, nn, "string", L.nn_flow(X)) == ["D", "R", "N", "X", "N", None]
    assert values(spark, ["TD1", "TD2", "?", None], "string", L.sg_flow(X)) == ["F", "B", "N", "N"]
    assert values(spark, ["B", "nope", None], "string", L.mapped(X, fixed.NN_FLOW)) == ["N", "D", "D"]


def test_null_marks(spark):
    marks = ["NA", "null", "None", "N/A", "", "x", "none", None]
    assert values(spark, marks, "string", L.without_null_marks(X)) == [
        None, None, None, None, None, "x", "none", None,
    ]


def test_signs(spark):
    assert values(spark, ["-12", " +3", "12", None], "string", L.signed(X)) == [True, True, False, None]


@pytest.mark.parametrize("path, name, pipe, day", [
    ("file:/l/P1_OA_20260105_INTRDY_2026-01-05_0800.csv",
     "P1_OA_20260105_INTRDY_2026-01-05_0800.csv", "P1", "20260105"),
    ("s://b/posting=P2_SG_Line_1_20260105_x.csv/part-0-a.c000.txt", "P2_SG_Line_1_20260105_x.csv", "P2", "20260105"),
    ("file:/l/P2_AllPoints.csv/part-00000-x.csv", "P2_AllPoints.csv", "P2", None),
    ("file:/l/P1_NN_20260105.csv", "P1_NN_20260105.csv", "P1", "20260105"),
    ("file:/l/readme.txt", "", "", None),
])
def test_posting_names(spark, path, name, pipe, day):
    posting = L.posting_name(X)
    assert values(
        spark, [path], "string", posting, L.pipe_of_posting(posting), L.date_of_posting(posting)
    ) == [[name, pipe, day]]


def test_pipe_labels(spark):
    labels = ["Northern Line (NL)", "No bracket", " A (B) (C)) ", "(X)"]
    got = values(spark, labels, "string", L.pipe_label(X))
    assert [None if g is None else tuple(g) for g in got] == [
        ("Northern Line", "NL"), None, ("A", "B) (C))"), ("", "X"),
    ]


def test_file_safe_and_last_part(spark):
    got = values(spark, ["A/B Line 1"], "string", L.file_safe(X), L.last_part(X))
    assert got == [["AB_Line_1", "B Line 1"]]


def test_seconds_between_ignores_time_zones(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(datetime(2026, 3, 8, 1, 0), datetime(2026, 3, 9, 1, 0, 0, 500000)),
             (datetime(2026, 3, 8, 1, 0), None)], "a timestamp_ntz, b timestamp_ntz",
        )
        rows = df.select(L.seconds_between(F.col("a"), F.col("b")).cast("double")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(row[0] for row in rows) == [0.0, 86400.5]


def test_nn_posting_day(spark):
    got = values(
        spark, [date(2026, 1, 3), date(2026, 1, 14)], "date",
        L.nn_posting_day(X, F.lit(date(2026, 1, 15))),
    )
    assert got == [date(2026, 1, 3), date(2026, 1, 11)]


def test_user_function_sees_none(spark):
    double = L.batch(lambda v: -1.0 if v is None else v * 2, "double")
    assert values(spark, [1.5, None], "double", double(X)) == [3.0, -1.0]
