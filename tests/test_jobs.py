"""Sinks, whole runs, replay and the stream on small hand-made postings."""

from __future__ import annotations

import importlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linepack import plans, sinks, sources, streaming
from linepack.fixed import META_RAW, OA_RAW
from linepack.operators import conform
from linepack.plans.jobs import run_name
from linepack.schemas import FACT, STORED_LOCATIONS, texts
from linepack.shared import new_folder, shared_folder

RUN_TS = datetime(2026, 1, 15, 6, 30)


def fact(day, dataset, loc, value, month=202601):
    row = dict.fromkeys(FACT.names)
    row.update(GasMonth=month, GasDay=date(2026, 1, day), Dataset=dataset, GFLocID=loc, OperatingCapacity=value)
    return row


def facts(spark, *rows):
    return spark.createDataFrame([fact(*r) for r in rows], FACT)


def content(spark, path):
    return sorted((r.GasDay.day, r.Dataset, r.GFLocID, r.OperatingCapacity) for r in sinks.read_gold(spark, path).collect())


@pytest.mark.parametrize("replace", [sinks.replace_slices, sinks.merge_slices])
def test_only_the_posted_slices_are_replaced(spark, replace):
    path = new_folder(spark, "gold")
    assert sinks.read_gold(spark, path).count() == 0 and not sinks.gold_exists(spark, path)
    replace(facts(spark, (1, "OA", "a", 1.0), (1, "OA", "b", 1.0), (2, "OA", "a", 2.0), (1, "NN", "a", 3.0)), path)
    again = facts(spark, (1, "OA", "a", 9.0))
    replace(again, path)
    want = [(1, "NN", "a", 3.0), (1, "OA", "a", 9.0), (2, "OA", "a", 2.0)]
    assert content(spark, path) == want
    replace(again, path)
    assert content(spark, path) == want
    assert sinks.read_gold(spark, path).columns == FACT.names


def test_merge_slices_makes_rows_distinct_however_finely_it_cuts(spark):
    path = new_folder(spark, "gold")
    rows = spark.range(4000).selectExpr("CAST(id % 500 AS string) AS GFLocID", "id % 500 / 2 AS OperatingCapacity")
    frame = conform(
        rows.withColumns({"GasMonth": F.lit(202601).cast("long"), "GasDay": F.lit(date(2026, 1, 5)),
                          "Dataset": F.lit("OA")}), FACT,
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.merge_slices(frame, path, rows_per_part=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sinks.read_gold(spark, path).count() == 500
    files = sinks.read_gold(spark, path).select(F.input_file_name()).distinct().count()
    assert files > 1


def test_parents_can_share_a_table(spark):
    path = new_folder(spark, "gold")
    rows = facts(spark, (1, "OA", "a", 1.0))
    for parent in ("A", "B"):
        sinks.replace_slices(rows.withColumn("ParentPipe", F.lit(parent)), path, extra=("ParentPipe",))
    assert spark.read.parquet(path).count() == 2


def test_cluster_only_recent_months(spark):
    path = new_folder(spark, "gold")
    sinks.replace_slices(facts(spark, (1, "OA", "b", 1.0), (1, "OA", "a", 2.0)), path)
    before = content(spark, path)
    assert not sinks.cluster_months(spark, path, [202601], as_of=date(2026, 2, 1))
    assert sinks.cluster_months(spark, path, [202601], as_of=date(2026, 1, 30))
    assert content(spark, path) == before
    stored = spark.read.parquet(path).select("GFLocID").collect()
    assert [r.GFLocID for r in stored] == ["a", "b"]


def test_bronze_run_is_replaced_not_added(spark):
    path = new_folder(spark, "bronze")
    raw = spark.createDataFrame(
        [("01-05-2026", "1", "P1", "P1_OA_20260105_x.csv"), ("bad", "2", "P1", "P1_OA.csv")],
        "Eff_Gas_Day string, Loc string, PipeCode string, PostingFile string",
    )
    for _ in range(2):
        sinks.write_bronze(raw, path, "OA", "r1")
    rows = sinks.read_bronze_run(spark, path, "OA", "r1")
    assert rows.count() == 2 and sinks.read_bronze(spark, path, "OA").columns[:len(OA_RAW)] == OA_RAW
    assert sinks.read_bronze_run(spark, path, "OA", "r2") is None
    periods = {r.period for r in spark.read.parquet(f"{path}/Dataset=OA").select(F.col("period").cast("string")).collect()}
    assert periods == {"202601", "unknown"}


PIPES = [("Parent", "One", "001", "P1"), ("Other", "Two", "002", "P2")]


@pytest.fixture
def pipes(spark):
    return spark.createDataFrame(PIPES, texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"]))


def oa_line(day, loc, cap, cycle="Timely"):
    row = dict.fromkeys(OA_RAW, "")
    row.update(Cycle_Desc=cycle, Eff_Gas_Day=day, Loc=loc, Loc_Name="Point", Flow_Ind_Desc="Receipt",
               Total_Design_Capacity=cap, Operating_Capacity=cap, Total_Scheduled_Quantity="1",
               Operationally_Available_Capacity="1")
    return ",".join(row[c] for c in OA_RAW)


def landing(tmp_path):
    folders = {d: tmp_path / d for d in ("OA", "NN", "SG")}
    for folder in folders.values():
        folder.mkdir()
    (folders["OA"] / "P1_OA_20260105_INTRDY.csv").write_text(
        "\n".join([",".join(OA_RAW), oa_line("01-05-2026", "7", "10"), oa_line("01-05-2026", "7", "10", "Evening"),
                   oa_line("01-06-2026", "7", "11"), oa_line("nope", "7", "12")]) + "\n")
    (folders["OA"] / "P2_OA_20260105_INTRDY.csv").write_text(
        "\n".join([",".join(OA_RAW), oa_line("01-05-2026", "7", "99")]) + "\n")
    (folders["NN"] / "P1_NN_20260105_.csv").write_text(
        "Effective_From_DateTime,Loc_Prop,Loc_Name,Allocated_Qty,Direction_Of_Flow,Accounting_Physincal_Indicator\n"
        "01/05/2026 09:00,8,Notice,5,B,A\n")
    (folders["SG"] / "P1_SG_Line_20260105_x.csv").write_text(
        "Gas Date: 2026-01-05  Cycle: Timely\nStation Name,Cap,Nom,Cap2\nSta,10,-3,8\n")
    return {d: str(f) for d, f in folders.items()}


WANT_DAY = [
    ("NN", "0010000008", None, "N"), ("OA", "0010000007", 10.0, "R"),
    ("SG", "001GF00001", 10.0, "F"), ("SG", "001GF00001", 8.0, "B"),
]


def gold_rows(spark, tables, day):
    rows = sinks.read_gold(spark, tables.gold).where(F.col("GasDay") == day).collect()
    return sorted(((r.Dataset, r.GFLocID, r.OperatingCapacity, r.FlowDirection) for r in rows), key=str)


def test_run_day_and_run_range(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    posted = landing(tmp_path)
    day = date(2026, 1, 5)
    availability = spark.createDataFrame(
        [(("One (P1)", "One", "P1"), True, True, True, True)],
        "pipe struct<label string, name string, code string>, has_OA boolean, has_SG boolean, has_NN boolean, has_MetaData boolean",
    )
    log = new_folder(spark, "log")
    plans.run_day(spark, posted, pipes, tables, day, RUN_TS, "Parent", availability=availability,
                  keep_run_gold=True, failure_log=log)
    assert [tuple(r) for r in sources.read_failures(spark, log).collect()] == [("P1", "META", day)]
    files = spark.read.parquet(f"{tables.audit}/raw_files").collect()
    assert sorted((r.Dataset, r.PipeCode, r.records) for r in files) == [
        ("NN", "P1", 1), ("OA", "P1", 3), ("OA", "P2", 1), ("SG", "P1", 1),
    ]
    assert gold_rows(spark, tables, day) == WANT_DAY
    assert sinks.read_gold(spark, tables.gold).where(F.col("GasDay") != day).count() == 0
    assert spark.read.parquet(tables.gold_runs).count() == 4
    locations = sinks.read_version(spark, tables.locations)
    assert sorted(r.RowKey for r in locations.collect()) == ["0010000007", "0010000008", "001GF00001"]
    assert set(STORED_LOCATIONS.names) == set(locations.columns)
    rejects = {(r.Dataset, r.Reason) for r in spark.read.parquet(tables.rejects).collect()}
    assert rejects == {("OA", "unknown pipe"), ("OA", "no gas day")}
    detail = {r.dataset_type + r.pipe_code: r for r in spark.read.parquet(f"{tables.audit}/dataset_detail").collect()}
    assert (detail["OAP1"].raw_records, detail["OAP1"].silver_records, detail["OAP1"].new_locations) == (3, 3, 1)
    assert (detail["OAP2"].raw_records, detail["OAP2"].silver_records) == (1, 0)
    missing = [(r.pipe_code, r.dataset_type) for r in spark.read.parquet(f"{tables.audit}/missing").collect()]
    assert missing == [("P1", "META")]

    plans.run_range(spark, posted, pipes, tables, day, date(2026, 1, 6), RUN_TS, "Parent")
    assert gold_rows(spark, tables, day) == WANT_DAY
    assert gold_rows(spark, tables, date(2026, 1, 6)) == [("OA", "0010000007", 11.0, "R")]
    with pytest.raises(ValueError, match="future"):
        plans.run_day(spark, posted, pipes, tables, date(2026, 2, 1), RUN_TS, "Parent")


def test_replay_runs_the_delivered_units_and_returns_the_rest(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    posted = landing(tmp_path)
    log = tmp_path / "fails.csv"
    log.write_text("P1|ALL|2026/01/05\nP1|SG|2026/01/04\n")
    open_units = plans.replay_failed(spark, str(log), posted, pipes, tables, RUN_TS, "Parent")
    assert [tuple(r) for r in open_units.collect()] == [("P1", "SG", date(2026, 1, 4))]
    assert gold_rows(spark, tables, date(2026, 1, 5)) == WANT_DAY


def test_a_batch_with_part_of_a_day_keeps_the_rest_of_it(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    posted = landing(tmp_path)
    stream = new_folder(spark, "stream")

    def ingest():
        streaming.ingest(spark, posted, pipes, tables, "Parent", stream, run_ts=RUN_TS, files_per_batch=1)

    ingest()
    day = date(2026, 1, 5)
    assert gold_rows(spark, tables, day) == WANT_DAY
    (tmp_path / "OA" / "P1_OA_20260105_LATE.csv").write_text(
        "\n".join([",".join(OA_RAW), oa_line("01-05-2026", "9", "20")]) + "\n")
    ingest()
    assert gold_rows(spark, tables, day) == sorted([*WANT_DAY, ("OA", "0010000009", 20.0, "R")], key=str)
    ingest()
    assert len(gold_rows(spark, tables, day)) == 5
    assert gold_rows(spark, tables, date(2026, 1, 6)) == [("OA", "0010000007", 11.0, "R")]


def test_a_stream_rebuilds_a_day_once_however_many_batches_touch_it(spark, tmp_path, pipes, monkeypatch):
    module = importlib.import_module("linepack.streaming.ingest")
    rebuilt, failing = [], []
    really, run_audit = module.rebuild_slices, module.write_audit

    def rebuild(spark, touched, *rest):
        rebuilt.append(sorted({row.GasDay for days in touched.values() for row in days.collect()}))
        really(spark, touched, *rest)

    def audit(*args):
        if failing and next(iter(args[0].values())).where("Loc = '9'").count():
            raise RuntimeError("audit")
        return run_audit(*args)

    monkeypatch.setattr(module, "rebuild_slices", rebuild)
    monkeypatch.setattr(module, "write_audit", audit)
    tables, stream = plans.Tables(new_folder(spark, "tables")), new_folder(spark, "stream")
    folder, day = tmp_path / "OA", date(2026, 1, 5)
    folder.mkdir()

    def post(name, loc):
        (folder / f"P1_OA_20260105_{name}.csv").write_text("\n".join([",".join(OA_RAW), oa_line("01-05-2026", loc, "20")]) + "\n")

    def ingest():
        streaming.ingest(spark, {"OA": str(folder)}, pipes, tables, "Parent", stream, run_ts=RUN_TS, files_per_batch=1)

    post("A1", "1")
    post("A2", "2")
    ingest()
    assert rebuilt == [[day]] and len(gold_rows(spark, tables, day)) == 2
    failing.append(True)
    post("B", "9")
    with pytest.raises(Exception):
        ingest()
    assert len(rebuilt) == 1  # nothing was waiting
    failing.clear()
    ingest()
    assert len(rebuilt) == 2 and len(gold_rows(spark, tables, day)) == 3


def test_shared_folder_is_the_one_the_session_names(spark):
    class Conf:
        def get(self, key, default):
            return "s3a://bucket/shared/" if key == "spark.checkpoint.dir" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Named:
        conf = Conf()
        sparkContext = Context()

    assert shared_folder(Named()) == "s3a://bucket/shared"


def test_no_folder_of_its_own_choice():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        def getCheckpointDir(self):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_attribute_history_takes_only_changes(spark, tmp_path):
    folder = tmp_path / "META"
    folder.mkdir()
    path = new_folder(spark, "attributes")
    header = "Loc,Loc Name,Loc Zone"

    def post(*lines):
        (folder / "P1_AllPoints.csv").write_text("\n".join([header, *lines]) + "\n")
        plans.update_attributes(spark, str(folder), path, date(2026, 1, 15), "Parent")
        rows = plans.stored_attributes(spark, path).collect()
        return sorted((r.Loc, r.LocName, r.LocZone) for r in rows)

    first = post("1,a,Z1", "2,b,Z1")
    assert first == [("1", "a", "Z1"), ("2", "b", "Z1")]
    assert post("1,a ,Z1", "2,b,Z1") == first
    assert post("1,a,Z1", "2,b,Z2", "3,c,NA") == sorted([*first, ("2", "b", "Z2"), ("3", "c", "")])


def nn_file(day, loc, value):
    return ("Effective_From_DateTime,Loc_Prop,Loc_Name,Allocated_Qty,Direction_Of_Flow,Accounting_Physincal_Indicator\n"
            f"{day} 09:00,{loc},Notice,{value},B,A\n")


def test_a_daily_run_takes_the_no_notice_day_that_can_be_there(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    oa, nn, meta = tmp_path / "OA", tmp_path / "NN", tmp_path / "META"
    for folder in (oa, nn, meta):
        folder.mkdir()
    for day in ("14", "15"):
        (oa / f"P1_OA_202601{day}_INTRDY_2026-01-15_0600.csv").write_text(
            "\n".join([",".join(OA_RAW), oa_line(f"01-{day}-2026", "7", "10")]) + "\n")
    (nn / "P1_NN_20260111.csv").write_text(nn_file("01/11/2026", 8, 5))
    (meta / "P1_AllPoints.csv").write_text(",".join(META_RAW) + "\n7,Point,TX,Bee,Z1,R,T1\n")
    availability = spark.createDataFrame(
        [(("One (P1)", "One", "P1"), True, False, True, True)],
        "pipe struct<label string, name string, code string>, has_OA boolean, has_SG boolean, has_NN boolean, has_MetaData boolean",
    )
    posted = {"OA": str(oa), "NN": str(nn), "META": str(meta)}
    plans.run_daily(spark, posted, pipes, tables, RUN_TS, "Parent", availability=availability)
    assert [c[:2] for c in content(spark, tables.gold)] == [(11, "NN"), (14, "OA"), (15, "OA")]
    assert spark.read.parquet(f"{tables.audit}/missing").count() == 0
    assert spark.read.parquet(tables.rejects).count() == 0


def test_a_later_posting_replaces_an_earlier_one_and_others_add_up(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    oa = tmp_path / "OA"
    oa.mkdir()
    both = pipes.withColumn("ParentPipe", F.lit("Parent"))

    def post(name, *lines):
        (oa / f"{name}.csv").write_text("\n".join([",".join(OA_RAW), *lines]) + "\n")

    day = date(2026, 1, 5)
    post("P1_OA_20260105_INTRDY_2026-01-05_0600", oa_line("01-05-2026", "7", "100"), oa_line("01-05-2026", "8", "1"))
    post("P2_OA_20260105_INTRDY_2026-01-05_0600", oa_line("01-05-2026", "9", "50"))

    def gold():
        return sorted((r.GFLocID, r.OperatingCapacity) for r in sinks.read_gold(spark, tables.gold).collect())

    def ingest():
        streaming.ingest(spark, {"OA": str(oa)}, both, tables, "Parent", stream, run_ts=RUN_TS)

    first = [("0010000007", 100.0), ("0010000008", 1.0), ("0020000009", 50.0)]
    plans.run_day(spark, {"OA": str(oa)}, both, tables, day, RUN_TS, "Parent")
    assert gold() == first
    streamed, stream = tables, new_folder(spark, "stream")
    tables = plans.Tables(new_folder(spark, "tables"))
    ingest()
    assert gold() == first
    post("P1_OA_20260105_INTRDY_2026-01-05_1200", oa_line("01-05-2026", "7", "222"))
    ingest()
    second = [("0010000007", 222.0), ("0020000009", 50.0)]
    assert gold() == second
    assert spark.read.parquet(f"{tables.audit}/raw_files").count() > 0
    tables = streamed
    plans.run_day(spark, {"OA": str(oa)}, both, tables, day, RUN_TS, "Parent")
    assert gold() == second


def test_a_repeated_run_leaves_nothing_behind(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    oa = tmp_path / "OA"
    oa.mkdir()
    name = oa / "P1_OA_20260105_INTRDY_2026-01-05_0600.csv"
    day = date(2026, 1, 5)
    name.write_text("\n".join([",".join(OA_RAW), oa_line("01-05-2026", "7", "100"), oa_line("01-05-2026", "-7", "1")]) + "\n")
    plans.run_day(spark, {"OA": str(oa)}, pipes, tables, day, RUN_TS, "Parent")
    assert len(content(spark, tables.gold)) == 1 and spark.read.parquet(tables.rejects).count() == 1
    # Another parent at the same time keeps its own runs and slices.
    plans.run_day(spark, {"OA": str(oa)}, pipes.withColumn("ParentPipe", F.lit("Twin")), tables, day, RUN_TS, "Twin")
    assert len(content(spark, tables.gold)) == 2 and spark.read.parquet(tables.rejects).count() == 2
    # All rows of the slice are rejected now: it is posted and empty.
    name.write_text("\n".join([",".join(OA_RAW), oa_line("01-05-2026", "-7", "1")]) + "\n")
    plans.run_day(spark, {"OA": str(oa)}, pipes, tables, day, RUN_TS, "Parent")
    rows = sinks.read_gold(spark, tables.gold, extra=("ParentPipe",)).collect()
    assert [r.ParentPipe for r in rows] == ["Twin"]
    name.write_text("\n".join([",".join(OA_RAW), oa_line("01-05-2026", "7", "5")]) + "\n")
    plans.run_day(spark, {"OA": str(oa)}, pipes, tables, day, RUN_TS, "Parent")
    runs = spark.read.parquet(tables.rejects).groupBy("run").count().collect()
    assert [r["count"] for r in runs] == [1] and len(content(spark, tables.gold)) == 2


def test_replay_leaves_days_between_alone(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    posted = landing(tmp_path)
    (tmp_path / "NN" / "P1_NN_20260111.csv").write_text(nn_file("01/11/2026", 8, 5))
    (tmp_path / "OA" / "P1_OA_20260108_INTRDY_2026-01-08_0600.csv").write_text(
        "\n".join([",".join(OA_RAW), oa_line("01-08-2026", "7", "10")]) + "\n")
    log = tmp_path / "fails.csv"
    log.write_text("P1|OA|2026/01/05\nP1|NN|2026/01/11\n")
    still_open = plans.replay_failed(spark, str(log), posted, pipes, tables, RUN_TS, "Parent")
    assert still_open.count() == 0
    assert {c[:2] for c in content(spark, tables.gold)} == {(5, "OA"), (11, "NN")}


def test_pipe_records_that_break_a_rule_are_listed(spark):
    rows = spark.createDataFrame(
        [("Parent", "One", 1, "P1"), ("Parent", "Far", 1000, "P2"), ("Parent", "Short", 3, "P"), ("P", "Who", 4, "P4")],
        "ParentPipe string, PipeName string, GFPipeID int, PipeCode string",
    )
    assert [tuple(r) for r in sources.pipe_reference(rows).collect()] == [("Parent", "One", "001", "P1")]
    bad = {r.PipeName: r.Reason for r in sources.pipe_rejects(rows).collect()}
    assert bad == {"Far": "id is not three digits", "Short": "code length", "Who": "parent length"}


def oa_post(folder, name, *lines):
    (folder / f"{name}.csv").write_text("\n".join([",".join(OA_RAW), *lines]) + "\n")


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_a_posting_that_moves_its_day_takes_the_old_day_with_it(spark, tmp_path, pipes, how):
    tables, stream = plans.Tables(new_folder(spark, "tables")), new_folder(spark, "stream")
    oa = tmp_path / "OA"
    oa.mkdir()
    minute = iter(range(60))

    def run():
        if how == "stream":
            streaming.ingest(spark, {"OA": str(oa)}, pipes, tables, "Parent", stream, run_ts=RUN_TS)
        else:
            at = RUN_TS.replace(minute=next(minute))
            plans.run_range(spark, {"OA": str(oa)}, pipes, tables, date(2026, 1, 1), date(2026, 1, 15), at, "Parent")

    def gold():
        return [(day, value) for day, _, _, value in content(spark, tables.gold)]

    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0800", oa_line("01-05-2026", "7", "100"))
    run()
    assert gold() == [(5, 100.0)]
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0900", oa_line("01-06-2026", "7", "100"))
    run()
    assert gold() == [(6, 100.0)]
    # Another unit touches the old day: the figure that was replaced does not come back.
    oa_post(oa, "P1_OA_20260105_LATE_2026-01-05_0930", oa_line("01-05-2026", "8", "5"))
    run()
    assert gold() == [(5, 5.0), (6, 100.0)]
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_1000", oa_line("01-05-2026", "7", "1"), oa_line("01-07-2026", "7", "2"))
    run()
    assert gold() == [(5, 1.0), (5, 5.0), (7, 2.0)]
    # An older download that lands late changes nothing.
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0700", oa_line("01-09-2026", "7", "9"))
    run()
    assert gold() == [(5, 1.0), (5, 5.0), (7, 2.0)]


def test_a_run_of_one_day_empties_the_day_a_posting_has_left(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    oa = tmp_path / "OA"
    oa.mkdir()
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0800", oa_line("01-05-2026", "7", "100"))
    plans.run_day(spark, {"OA": str(oa)}, pipes, tables, date(2026, 1, 5), RUN_TS, "Parent")
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0900", oa_line("01-06-2026", "7", "100"))
    plans.run_day(spark, {"OA": str(oa)}, pipes, tables, date(2026, 1, 6), RUN_TS.replace(hour=7), "Parent")
    assert [c[0] for c in content(spark, tables.gold)] == [6]


def test_files_are_landed_once(spark, tmp_path, pipes):
    tables = plans.Tables(new_folder(spark, "tables"))
    oa = tmp_path / "OA"
    oa.mkdir()

    def run(day, hour):
        plans.run_day(spark, {"OA": str(oa)}, pipes, tables, date(2026, 1, day), RUN_TS.replace(hour=hour), "Parent")

    def landed():
        rows = sinks.read_bronze(spark, tables.bronze, "OA").groupBy("run").count().collect()
        return {r.run[8:10]: r["count"] for r in rows}

    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0800", oa_line("01-05-2026", "7", "1"))
    run(5, 1)
    run(5, 2)
    assert landed() == {"01": 1}
    (oa / "P1_OA_20260106_INTRDY_2026-01-06_0800.csv").write_text("")
    oa_post(oa, "P1_OA_20260107_INTRDY_2026-01-07_0800", oa_line("01-07-2026", "7", "2"), oa_line("nope", "7", "2"))
    run(7, 3)
    assert landed() == {"01": 1, "03": 2}
    assert content(spark, tables.gold) == [(5, "OA", "0010000007", 1.0), (7, "OA", "0010000007", 2.0)]
    # Rows without a day are listed by the run that landed them, not by every later one.
    run(5, 4)
    listed = spark.read.parquet(tables.rejects).groupBy("run").count().collect()
    assert [(str(r.run)[8:10], r["count"]) for r in listed] == [("03", 1)]
    # The same name written again is a new file.
    oa_post(oa, "P1_OA_20260105_INTRDY_2026-01-05_0800", oa_line("01-05-2026", "7", "33"))
    run(5, 5)
    assert landed() == {"01": 1, "03": 2, "05": 1}
    assert content(spark, tables.gold)[0] == (5, "OA", "0010000007", 33.0)


ODD_NAMES = ["P1_OA_{0,1}_20260105_x", "P1_OA_0_20260105_x", "P1_OA_[1]_20260105_x", "P1 _OA_a b_20260105_x",
             "P1_OA_100%_20260105_x", "P1_OA_%41_20260105_x", "P1_OA_+_20260105_x", "P1_OA_*?_20260105_x", "P1_OA_é_20260105_x"]


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_names_are_taken_literally(spark, tmp_path, pipes, how):
    tables, stream = plans.Tables(new_folder(spark, "tables")), new_folder(spark, "stream")
    oa = tmp_path / "OA"
    oa.mkdir()
    want = []

    def run(hour):
        if how == "stream":
            streaming.ingest(spark, {"OA": str(oa)}, pipes, tables, "Parent", stream, run_ts=RUN_TS, files_per_batch=4)
        else:
            plans.run_day(spark, {"OA": str(oa)}, pipes, tables, date(2026, 1, 5), RUN_TS.replace(hour=hour), "Parent")

    for half, names in enumerate((ODD_NAMES[:2], ODD_NAMES[2:])):
        for name in names:
            want.append((f"001{len(want):07d}", float(len(want))))
            oa_post(oa, name, oa_line("01-05-2026", str(len(want) - 1), str(len(want) - 1)))
        run(half + 1)
        assert sorted((loc, value) for _, _, loc, value in content(spark, tables.gold)) == want
    stored = {r.PostingFile for r in sinks.read_bronze(spark, tables.bronze, "OA").select("PostingFile").collect()}
    assert stored == {f"{name}.csv" for name in ODD_NAMES}


def test_gold_of_the_latest_cycle_in_runs_and_stream(spark, tmp_path, pipes):
    folder = tmp_path / "OA"
    folder.mkdir()
    head = ",".join(OA_RAW)

    def post(cycle, *lines):
        (folder / f"P1_OA_20260105_{cycle}.csv").write_text("\n".join([head, *lines]) + "\n")

    def capacities(tables):
        return sorted((r.GFLocID, r.OperatingCapacity) for r in sinks.read_gold(spark, tables.gold).collect())

    tables = plans.Tables(new_folder(spark, "tables"), latest_cycle=True)
    streamed, stream = plans.Tables(new_folder(spark, "tables"), latest_cycle=True), new_folder(spark, "stream")
    day, landing = date(2026, 1, 5), {"OA": str(folder)}
    post("TIMELY", oa_line("01-05-2026", "7", "10"), oa_line("01-05-2026", "8", "20"))
    plans.run_day(spark, landing, pipes, tables, day, RUN_TS, "Parent")
    streaming.ingest(spark, landing, pipes, streamed, "Parent", stream, run_ts=RUN_TS)
    for each in (tables, streamed):
        assert capacities(each) == [("0010000007", 10.0), ("0010000008", 20.0)]
    post("INTRDY", oa_line("01-05-2026", "7", "12", "Intraday 1"), oa_line("01-05-2026", "7", "11", "Evening"))
    plans.run_day(spark, landing, pipes, tables, day, RUN_TS + timedelta(hours=1), "Parent")
    streaming.ingest(spark, landing, pipes, streamed, "Parent", stream, run_ts=RUN_TS)
    for each in (tables, streamed):
        assert capacities(each) == [("0010000007", 12.0), ("0010000008", 20.0)]
    counted = spark.read.parquet(f"{tables.audit}/cycles").where(F.col("run") == run_name(RUN_TS + timedelta(hours=1), "Parent")).collect()
    assert {r.cycle: r.silver_records for r in counted} == {"Timely": 2, "Evening": 1, "Intraday 1": 1}
