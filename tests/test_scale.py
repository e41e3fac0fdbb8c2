"""What runs leave on disk, and what crosses the network, on small hand-made rows."""

from __future__ import annotations

import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from catalogue import testbed as t
from linepack import operators as O
from linepack import plans, sinks, sources
from linepack.schemas import FACT, texts
from linepack.shared import materialise, new_folder, shared_folder, shuffles_removed

SETTINGS = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")


def shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(d.getPath()) for d in manager.localDirs()]
    return {name for d in folders for _, _, names in os.walk(d) for name in names if name.startswith("shuffle_")}


def test_a_write_takes_its_shuffle_files_away(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    there = shuffle_files(spark)
    rows = materialise(spark.range(1000).repartition(7, "id"), "shuffled")
    until = time.time() + 20
    while shuffle_files(spark) - there and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) - there == set()
    assert rows.count() == 1000
    assert {name: spark.conf.get(name, None) for name in SETTINGS} == before


def test_settings_come_back_also_after_an_error(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark, open_files=3):
        assert spark.conf.get(SETTINGS[1]) == "3"
        raise ZeroDivisionError
    assert {name: spark.conf.get(name, None) for name in SETTINGS} == before


def test_rows_go_to_bronze_without_a_shuffle(spark):
    path = new_folder(spark, "bronze")
    rows = spark.range(0, 90, 1, 3).select(
        F.format_string("P1_OA_2026%02d01.csv", F.col("id") % 2 + 1).alias("PostingFile"), F.lit("01-05-2026").alias("Eff_Gas_Day"),
        F.col("id").cast("string").alias("Loc"),
    )
    sinks.write_bronze(rows, path, "OA", "r1")
    written = spark.read.parquet(f"{path}/Dataset=OA")
    assert written.count() == 90 and written.select("Loc").distinct().count() == 90
    files = written.groupBy("period", F.col("_metadata.file_path").alias("file")).count().collect()
    assert sorted(str(r.period) for r in files) == ["202601"] * 3 + ["202602"] * 3


def test_facts_of_written_tables_are_not_written_aside(spark):
    rows = [(202601, date(2026, 1, d), "OA", str(k % 3)) for d in (1, 2) for k in range(6)]
    facts = O.conform(spark.createDataFrame(rows, "GasMonth long, GasDay date, Dataset string, GFLocID string"), FACT)
    posted = spark.createDataFrame([(202601, date(2026, 1, d), "OA") for d in (2, 3, 3)], "GasMonth long, GasDay date, Dataset string")
    found = []
    for aside in (True, False):
        path = new_folder(spark, "gold")
        sinks.merge_slices(facts.withColumn("GasDay", F.date_add("GasDay", 2)), path)
        sinks.merge_slices(facts, path, rows_per_part=2, posted=posted, aside=aside)
        found.append(sorted((r.GasDay.day, r.GFLocID) for r in sinks.read_gold(spark, path).collect()))
    assert found[0] == found[1] == sorted((d, str(k)) for d in (1, 2, 4) for k in range(3))


def test_a_run_leaves_no_copy_of_its_facts(spark, tmp_path):
    folder = tmp_path / "OA" / "P1_OA_20260105_INTRDY_2026-01-05_0800.csv"
    folder.parent.mkdir()
    folder.write_text("Cycle_Desc,Eff_Gas_Day,Loc,Loc_Name,Flow_Ind_Desc,Operating_Capacity\nTimely,01-05-2026,7,A,Receipt,\"1,000.00\"\n")
    pipes = spark.createDataFrame([("North", "One", "001", "P1")], texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"]))
    tables = plans.Tables(new_folder(spark, "tables"))
    root = shared_folder(spark).removeprefix("file:")
    there = set(os.listdir(root))
    plans.run_day(spark, {"OA": str(folder.parent)}, pipes, tables, date(2026, 1, 5), datetime(2026, 1, 15, 6, 30), "North")
    assert not [name for name in set(os.listdir(root)) - there if name.startswith("facts-")]
    assert [(r.GFLocID, r.OperatingCapacity) for r in sinks.read_gold(spark, tables.gold).collect()] == [("0010000007", 1000.0)]


def counted(df):
    return sorted(df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count().collect(), key=str)


def test_packed_postings_are_read_like_plain_ones(spark):
    path = new_folder(spark, "landing")
    rows = spark.createDataFrame(
        [("P1", "01-05-1996", f"{k}", 'a "b", c') for k in range(50)] + [("P2", "01-05-2000", "7", None)],
        texts(["PipeCode", "Post_Date", "Loc", "Loc_Name"]),
    )
    t.write_oa_postings(rows, path)
    files = [name for _, _, names in os.walk(path.removeprefix("file:")) for name in names if name.startswith("part-")]
    assert files and all(name.endswith(".csv.lz4") for name in files)
    read = sources.read_points(spark, path).select("PipeCode", "Post_Date", "Loc", "Loc_Name")
    assert counted(read) == counted(rows)
