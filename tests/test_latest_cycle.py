"""The latest cycle of rows with repeats, found with one exchange of the rows."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from linepack import operators as O
from linepack.operators import cycles
from linepack.schemas import OA_SILVER, SG_SILVER, texts
from linepack.shared import materialise


def oa_rows(spark):
    keys = ["Cycle_Desc", "Loc_Name", "GFLocID", "Eff_Gas_Day", "Flow_Ind_Desc", "IT"]
    rows = [(cycle, name, "0010000001", day, flow, it)
            for cycle in ("Timely", "ID 2", "INTRADAY-2", None, "odd") for name in ("a", "b", None)
            for day in ("1-5-2026", "01-05-2026", "soon", None) for flow in ("Receipt", None) for it in ("F", None, "F")]
    rows += [("Timely", "only", "0010000002", "1-5-2026", None, None)] * 3 + [(None, None, None, None, None, None)] * 2
    return O.conform(spark.createDataFrame(rows, texts(keys)), OA_SILVER)


def counted(df):
    return sorted(df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count().collect(), key=str)


@pytest.mark.parametrize("rows_per_part", [1_000_000, 5])
def test_the_latest_cycle_of_rows_with_repeats(spark, rows_per_part):
    for dataset, rows in (
        ("OA", oa_rows(spark)),
        ("SG", spark.createDataFrame(
            [(name, cap, 1.0, None, day, cycle, "001") for name in ("A", None) for cap in (1.0, None, 1.0)
             for day in (date(2026, 1, 5), None) for cycle in ("Timely", "Final", None)], SG_SILVER)),
        ("NN", spark.createDataFrame([(1,), (1,)], "a int")),
    ):
        want = O.latest_cycle(rows.distinct(), dataset)
        got = cycles._distinct_latest(rows, dataset, rows_per_part)
        assert counted(got) == counted(want) and got.columns == rows.columns
    assert counted(O.latest_cycle(oa_rows(spark), "OA", repeats=True)) == counted(O.latest_cycle(oa_rows(spark).distinct(), "OA"))
    assert O.latest_cycle(oa_rows(spark).limit(0), "OA", repeats=True).count() == 0


def test_rows_cross_the_network_once_for_the_latest_cycle(spark):
    rows = materialise(oa_rows(spark), "oa")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = O.latest_cycle(rows, "OA", repeats=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The table of large figures is so small that it is sent to the rows; without that its join is one exchange more.
    assert len(re.findall(r"Exchange hashpartitioning\(_figure#\d+, _cycle#\d+L?, _part#\d+L?", plan)) == 2
    assert len(re.findall("Exchange hashpartitioning", plan)) == 4 and "cast(_figure" not in plan
