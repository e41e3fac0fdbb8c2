"""One query per key: the operator over inputs derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepack import fixed
from linepack import functions as L
from linepack import operators as O
from linepack import plans, sinks, sources, streaming
from linepack.schemas import FACT, REJECTS
from linepack.shared import materialise, new_folder

from . import testbed as t

Query = Callable[[SparkSession, str], DataFrame]


def point_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.oa_raw(spark, sf).join(t.pipe_entities(spark, sf), "PipeCode")
    location = L.strip(F.col("Loc"))
    key = L.gf_loc_id(L.pipe_id(F.col("GFPipeID")), location)
    return rows.select(
        "PipeCode",
        location.alias("Loc"),
        L.loc_id(location).alias("LocID"),
        key.alias("GFLocID"),
        L.pipe_of_gf_loc_id(key).alias("PipeOfKey"),
        L.signed(F.concat(F.lit("-"), F.col("Loc"))).alias("Signed"),
    )


def parse_quantity(spark: SparkSession, sf: str) -> DataFrame:
    posted = F.col("Operationally_Available_Capacity")
    return t.oa_raw(spark, sf).select(
        L.quantity(F.col("Total_Design_Capacity")).alias("design"),
        L.quantity(F.col("Operating_Capacity")).alias("operating"),
        L.quantity(posted).alias("available"),
        (posted.isNotNull() & L.quantity(posted).isNull()).alias("unreadable"),
    )


def gas_month(spark: SparkSession, sf: str) -> DataFrame:
    day = L.oa_day(F.col("Eff_Gas_Day"))
    return t.oa_raw(spark, sf).select("Eff_Gas_Day", day.alias("GasDay"), L.gas_month(day).alias("GasMonth"))


def flow_codes(spark: SparkSession, sf: str) -> DataFrame:
    oa, nn = F.col("Flow_Ind_Desc"), F.col("Direction_Of_Flow")
    points = t.oa_raw(spark, sf).select(
        F.lit("OA").alias("kind"), oa.alias("code"), L.oa_flow(oa).alias("flow"),
        L.mapped(L.strip(oa), fixed.NN_FLOW).alias("helper_flow"),
    )
    notices = t.nn_raw(spark, sf).select(
        F.lit("NN").alias("kind"), nn.alias("code"), L.nn_flow(nn).alias("flow"),
        L.mapped(L.strip(nn), fixed.NN_FLOW).alias("helper_flow"),
    )
    return points.unionByName(notices)


def file_name_parts(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.concat(F.lit("Line "), "l_linenumber", F.lit("/"), "l_linestatus", F.lit(" N"))
    stem = F.concat(F.lit("file:/landing/SG/P"), "s_nationkey")
    dated = F.concat(
        stem, F.lit("_SG_"), L.file_safe(segment), F.lit("_"),
        L.day_text(F.col("l_shipdate")), F.lit("_INTRDY.csv"),
    )
    path = F.when(F.col("l_linenumber") == 7, F.concat(stem, F.lit("_AllPoints.csv"))).when(
        F.col("l_linenumber") == 6, F.concat(dated, F.lit("/part-00000-x.csv"))
    ).otherwise(dated)
    name = L.posting_name(F.col("path"))
    return t.shipped(spark, sf).select(path.alias("path")).select(
        "path",
        name.alias("posting"),
        L.pipe_of_posting(name).alias("PipeCode"),
        L.date_of_posting(name).alias("eff_date"),
        L.last_part(F.col("path")).alias("last"),
    )


def parse_pipe_labels(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("c_custkey") % 10 == 0, F.col("c_name")).otherwise(
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")"))
    )
    parsed = t.table(spark, sf, "customer").select("c_custkey", L.pipe_label(label).alias("p"))
    return parsed.where(F.col("p").isNotNull()).select("c_custkey", "p.name", "p.code")


def day_calendar(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = t.table(spark, sf, "orders"), t.table(spark, sf, "customer")
    spans = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey")
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("start"),
             F.max(F.col("o_orderdate").cast("date")).alias("end"))
    )
    days = O.expand_days(spans, "start", "end", F.lit(date(2000, 6, 15)))
    return days.select("c_nationkey", "day", "nn_day")


def validate_pipes(spark: SparkSession, sf: str) -> DataFrame:
    records = t.table(spark, sf, "customer").selectExpr(
        "lower(concat(c_mktsegment, c_nationkey % 3)) AS PipeCode",
        "CASE WHEN c_custkey % 11 = 0 THEN 'A' ELSE c_name END AS ParentPipe",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS PipeName",
        "c_custkey AS GFPipeID",
    )
    return O.validate_pipes(records)


def validate_results(spark: SparkSession, sf: str) -> DataFrame:
    records = t.results(spark, sf).withColumns({
        "dataset_type": F.when(F.col("duration_s") > 100, "ALL").otherwise(F.col("dataset_type")),
        "duration_s": F.col("duration_s") - 1,
        "error": F.when(F.col("duration_s") < 20, "late").otherwise(F.col("error")),
    })
    return O.validate_results(records)


def udf_batch(spark: SparkSession, sf: str) -> DataFrame:
    magnitude = L.batch(lambda x: None if x is None else float(abs(x)), "double")
    return t.sg_raw(spark, sf).select("Nom", magnitude(F.col("Nom")).alias("magnitude"))


def pipe_reference(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "pipes")
    sources.pipe_reference(t.pipe_entities(spark, sf)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parent_pipes(spark: SparkSession, sf: str) -> DataFrame:
    return O.pipes_of(t.pipes(spark, sf), t.PARENT)


def loc_reference(spark: SparkSession, sf: str) -> DataFrame:
    entities = t.table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE CAST(o_custkey % 1200 AS int) END AS GFPipeID",
        "o_orderkey AS LocID",
        "o_orderstatus AS LocName",
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate + interval '1.5' second END AS UpdatedTime",
    )
    return sources.loc_reference(entities)


def read_points(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "oa")
    t.write_oa_postings(t.oa_raw(spark, sf), path)
    return sources.read_points(spark, path)


def read_segments(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "sg")
    t.write_sg_postings(t.sg_posted(spark, sf), path)
    rows = sources.read_segments(spark, path)
    return rows.withColumns({name: L.number(F.col(name)) for name in ["Cap", "Nom", "Cap2"]})


def oa_silver(spark: SparkSession, sf: str) -> DataFrame:
    return O.point_silver(t.oa_raw(spark, sf), t.pipes(spark, sf), "Loc")


def nn_silver(spark: SparkSession, sf: str) -> DataFrame:
    return O.point_silver(t.nn_raw(spark, sf), t.pipes(spark, sf), "Loc_Prop")


def sg_silver(spark: SparkSession, sf: str) -> DataFrame:
    return O.segment_silver(t.sg_raw(spark, sf), t.pipes(spark, sf))


def drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    return O.drop_all_null(t.sg_raw(spark, sf), fixed.SG_RAW)


def conform_fact(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_shipdate AS date) AS GasDay", "'OA' AS Dataset", "l_quantity AS OperatingCapacity",
        "CAST(l_suppkey AS string) AS GFLocID", "l_linestatus AS Other",
    )
    return O.conform(rows, FACT)


def sg_directions(spark: SparkSession, sf: str) -> DataFrame:
    return O.sg_directions(sg_silver(spark, sf))


def oa_gold(spark: SparkSession, sf: str) -> DataFrame:
    return O.gold_oa(oa_silver(spark, sf))


def nn_gold(spark: SparkSession, sf: str) -> DataFrame:
    return O.gold_nn(nn_silver(spark, sf))


def sg_gold(spark: SparkSession, sf: str) -> DataFrame:
    return O.gold_sg(sg_silver(spark, sf), t.locations(spark, sf))


def _all_points(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Facts of OA and NN with equal rows, which ``merge_gold`` makes one."""
    pipes = t.pipes(spark, sf)
    return [
        O.gold_oa(O.point_silver(t.oa_raw(spark, sf), pipes, "Loc", repeats=True)),
        O.gold_nn(O.point_silver(t.nn_raw(spark, sf), pipes, "Loc_Prop", repeats=True)),
    ]


def gold_merge(spark: SparkSession, sf: str) -> DataFrame:
    segments = O.segment_silver(t.sg_raw(spark, sf), t.pipes(spark, sf), repeats=True)
    return O.merge_gold(
        *_all_points(spark, sf), O.gold_sg(segments, t.locations(spark, sf)), run_ts=t.RUN_TS
    )


def latest_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of points and segments, each figure of its latest cycle only."""
    pipes = t.pipes(spark, sf)
    points = O.latest_cycle(O.point_silver(t.oa_raw(spark, sf), pipes, "Loc", repeats=True), fixed.OA, repeats=True)
    segments = O.latest_cycle(O.segment_silver(t.sg_raw(spark, sf), pipes, repeats=True), fixed.SG, repeats=True)
    return O.gold_oa(points).unionByName(O.gold_sg(segments, t.locations(spark, sf)))


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    oa, nn, sg, pipes = t.oa_raw(spark, sf), t.nn_raw(spark, sf), t.sg_raw(spark, sf), t.pipes(spark, sf)
    return O.conform(O.all_rejects(
        O.point_rejects(oa, pipes, fixed.OA),
        O.silver_rejects(oa_silver(spark, sf), fixed.OA),
        O.point_rejects(nn, pipes, fixed.NN),
        O.silver_rejects(nn_silver(spark, sf), fixed.NN),
        O.segment_rejects(sg, pipes),
        O.silver_rejects(sg_silver(spark, sf), fixed.SG),
        O.unmatched_stations(sg_silver(spark, sf), t.locations(spark, sf)),
    ), REJECTS)


def meta_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return O.meta_enrichment(t.meta_raw(spark, sf), t.pipes(spark, sf))


def meta_changes(spark: SparkSession, sf: str) -> DataFrame:
    return O.meta_changes(t.meta_raw(spark, sf), t.stored_meta(spark, sf), t.RUN_DAY, t.PARENT)


def _new_points(spark: SparkSession, sf: str, silver: DataFrame) -> DataFrame:
    return O.new_point_locations(
        silver, t.locations(spark, sf), meta_enrichment(spark, sf), t.RUN_TS
    )


def new_point_locations(spark: SparkSession, sf: str) -> DataFrame:
    return _new_points(spark, sf, oa_silver(spark, sf)).unionByName(_new_points(spark, sf, nn_silver(spark, sf)))


def _new_segments(spark: SparkSession, sf: str, silver: DataFrame) -> DataFrame:
    return O.new_segment_locations(silver, t.locations(spark, sf), t.pipes(spark, sf), t.RUN_TS)


def new_segment_locations(spark: SparkSession, sf: str) -> DataFrame:
    return _new_segments(spark, sf, sg_silver(spark, sf))


def upsert_locations(spark: SparkSession, sf: str) -> DataFrame:
    """New stations and a correction of known ones, through a versioned table."""
    stored = O.keyed(t.locations(spark, sf), t.PARENT)
    path = new_folder(spark, "locations")
    sinks.write_version(stored, path)
    corrected = t.locations(spark, sf).where("Loc = ''").select(
        "GFLocID", F.concat("LocName", F.lit("*")).alias("LocName"), F.lit("Z1").alias("LocZone")
    )
    fresh = new_segment_locations(spark, sf)
    for rows in (O.keyed(corrected, t.PARENT), O.keyed(fresh, t.PARENT)):
        sinks.write_version(O.upsert_by_key(sinks.read_version(spark, path), rows), path)
    return sinks.read_version(spark, path).select(
        "RowKey", "PartitionKey", "GFPipeID", "GFLocID", "LocID", "Loc", "LocName", "LocZone", "PipeName",
        "UpdatedTime",
    )


def _point_gold(spark: SparkSession, sf: str) -> DataFrame:
    return O.merge_gold(*_all_points(spark, sf), run_ts=t.RUN_TS)


def _posted_again(gold: DataFrame) -> DataFrame:
    """Every second month of OA with other figures, and fewer of them."""
    return gold.where((F.col("Dataset") == "OA") & (F.col("GasMonth") % 2 == 0)).withColumn(
        "OperatingCapacity", F.col("OperatingCapacity") + 1
    ).where("IT = 'F'")


def replace_slices(spark: SparkSession, sf: str) -> DataFrame:
    """All days of OA and NN, then the days of every second month of OA posted anew, twice."""
    path = new_folder(spark, "gold")
    gold = materialise(_point_gold(spark, sf), "posted")
    again = _posted_again(gold)
    sinks.replace_slices(gold, path)
    sinks.replace_slices(again, path)
    sinks.replace_slices(again, path)
    return sinks.read_gold(spark, path)


def merge_slices(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the write that makes rows distinct; days that lost all rows are marked as posted."""
    path = new_folder(spark, "gold")
    gold = materialise(_point_gold(spark, sf), "posted")
    even = gold.where((F.col("Dataset") == "OA") & (F.col("GasMonth") % 2 == 0))
    sinks.merge_slices(gold.unionByName(gold), path)
    sinks.merge_slices(_posted_again(gold), path, posted=even)
    return sinks.read_gold(spark, path)


def cluster_months(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "gold")
    sinks.replace_slices(_point_gold(spark, sf), path)
    written = sinks.read_gold(spark, path)
    months = [row.GasMonth for row in written.select("GasMonth").distinct().collect()]
    latest = written.agg(F.max("GasDay")).first()[0]
    sinks.cluster_months(spark, path, months, as_of=latest)
    return sinks.read_gold(spark, path)


def silver_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "silver")
    sinks.write_silver(sg_silver(spark, sf), path, fixed.SG, "20260115063000", t.RUN_DAY)
    return sinks.read_silver(spark, path, fixed.SG)


def _posted(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        fixed.OA: t.posted(t.oa_raw(spark, sf), "OA", "concat(substring(Post_Date, 7, 4), substring(Post_Date, 1, 2))"),
        fixed.NN: t.posted(
            t.nn_raw(spark, sf), "NN",
            "concat(substring(Effective_From_DateTime, 7, 4), substring(Effective_From_DateTime, 1, 2))",
        ),
        fixed.SG: t.posted(t.sg_raw(spark, sf), "SG", "date_format(EffGasDate, 'yyyyMM')"),
    }


def bronze_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "bronze")
    parts = []
    for dataset, raw in _posted(spark, sf).items():
        sinks.write_bronze(raw, path, dataset, "run1")
        rows = spark.read.parquet(f"{path}/Dataset={dataset}")
        parts.append(rows.groupBy(
            F.lit(dataset).alias("Dataset"),
            F.col("period").cast("string").alias("period"),
            sinks.bronze_location(F.col("PostingFile"), dataset).alias("location"),
        ).agg(F.count("*").alias("row_count")))
    meta = t.meta_raw(spark, sf).withColumn("PostingFile", F.concat("PipeCode", F.lit("_AllPoints.csv")))
    sinks.write_bronze(meta, path, fixed.META, "run1")
    parts.append(spark.read.parquet(f"{path}/Dataset=META").groupBy(
        F.lit("META").alias("Dataset"), "period",
        sinks.bronze_location(F.col("PostingFile"), fixed.META).alias("location"),
    ).agg(F.count("*").alias("row_count")))
    return O.union_by_name(*parts)


def audit_raw_counts(spark: SparkSession, sf: str) -> DataFrame:
    return O.union_by_name(*[
        O.raw_counts(raw, dataset) for dataset, raw in _posted(spark, sf).items()
    ])


def audit_raw_files(spark: SparkSession, sf: str) -> DataFrame:
    return O.union_by_name(*[
        O.file_counts(raw, "PipeCode", "PostingFile").withColumn("Dataset", F.lit(dataset))
        for dataset, raw in _posted(spark, sf).items()
    ])


_SILVER: dict[str, Query] = {fixed.OA: oa_silver, fixed.NN: nn_silver, fixed.SG: sg_silver}


def _written_silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    path, written = new_folder(spark, "silver"), {}
    for dataset, make in _SILVER.items():
        sinks.write_silver(make(spark, sf), path, dataset, "run1")
        written[dataset] = sinks.read_silver(spark, path, dataset)
    return written


def _silver_counts(silver: dict[str, DataFrame]) -> DataFrame:
    return O.union_by_name(*[
        O.silver_counts(rows.withColumn("Dataset", F.lit(dataset))) for dataset, rows in silver.items()
    ])


def _location_counts(spark: SparkSession, sf: str, silver: dict[str, DataFrame]) -> DataFrame:
    return O.new_location_counts({
        dataset: (_new_segments if dataset == fixed.SG else _new_points)(spark, sf, rows)
        for dataset, rows in silver.items()
    })


def audit_silver_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_counts(_written_silver(spark, sf)).drop("silver_files")


def audit_new_locations(spark: SparkSession, sf: str) -> DataFrame:
    return _location_counts(spark, sf, {dataset: make(spark, sf) for dataset, make in _SILVER.items()})


def audit_dataset_detail(spark: SparkSession, sf: str) -> DataFrame:
    """New locations are found in the written silver, as a run does, not in silver made a second time."""
    silver = _written_silver(spark, sf)
    return O.dataset_detail(
        audit_raw_counts(spark, sf), _silver_counts(silver), _location_counts(spark, sf, silver)
    ).drop("silver_files")


def audit_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return O.run_summary(t.results(spark, sf), t.runs(spark, sf))


def audit_failures(spark: SparkSession, sf: str) -> DataFrame:
    return O.failures(t.results(spark, sf))


def pipe_changes(spark: SparkSession, sf: str) -> DataFrame:
    return O.pipe_changes(t.live_pipes(spark, sf), t.configured_pipes(spark, sf))


def missing_downloads(spark: SparkSession, sf: str) -> DataFrame:
    delivered = O.union_by_name(*[
        raw.select(F.col("PipeCode").alias("pipe_code"), F.lit(dataset).alias("dataset_type"))
        for dataset, raw in _posted(spark, sf).items()
    ])
    return O.missing_downloads(t.availability(spark, sf), delivered)


def late_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Every attempt announces its unit for noon, a success delivers it: told in the middle and at the end of the month."""
    expected, landed = new_folder(spark, "expected"), new_folder(spark, "landed")
    events, checkpoint = new_folder(spark, "events"), new_folder(spark, "watch")
    attempts = t.results(spark, sf).withColumn("gas_day", F.to_date("date"))
    noon = F.col("gas_day").cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    unit = ["pipe_code", "dataset_type", "gas_day"]
    streaming.expect(attempts.select(*unit).distinct().withColumn("deadline", noon), expected, "run1")
    came = attempts.where("success").select(*unit, F.col("date").cast("timestamp").alias("at"))
    first = F.col("at") < F.lit(t.MID_MONTH)
    for part, now in ((came.where(first), t.MID_MONTH), (came.where(~first), t.END_MONTH)):
        part.write.mode("append").parquet(landed)
        delivered = spark.readStream.schema(came.schema).parquet(landed)
        streaming.watch_deliveries(spark, expected, delivered, events, checkpoint, now)
    return spark.read.parquet(events).withColumn("at", F.col("at").cast("timestamp_ntz"))


def failed_worklist(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "failures")
    failed = t.results(spark, sf).where("NOT success").selectExpr(
        "pipe_code AS pipecode",
        "CASE WHEN duration_s > 100 THEN 'ALL' ELSE 'SG' END AS type",
        "CAST(date AS date) AS scrape_date",
    )
    sources.append_failures(failed, path)
    sources.append_failures(failed, path)
    return plans.failed_worklist(spark, path)


def _landing(spark: SparkSession, sf: str) -> dict[str, str]:
    root = new_folder(spark, "landing")
    landing = {d: f"{root}/{d}" for d in (fixed.OA, fixed.NN, fixed.SG, fixed.META)}
    t.write_oa_postings(t.oa_raw(spark, sf), landing[fixed.OA])
    t.write_nn_postings(t.nn_raw(spark, sf), landing[fixed.NN])
    t.write_sg_postings(t.sg_posted(spark, sf), landing[fixed.SG])
    t.write_meta_postings(t.meta_raw(spark, sf), landing[fixed.META])
    return landing


def _installation(spark: SparkSession, sf: str) -> tuple[DataFrame, plans.Tables]:
    """Pipes, all of one parent, and tables that know the locations of the testbed."""
    tables = plans.Tables(new_folder(spark, "installation"))
    sinks.write_version(O.keyed(t.locations(spark, sf), "Network"), tables.locations)
    return t.pipes(spark, sf).withColumn("ParentPipe", F.lit("Network")), tables


def run_range(spark: SparkSession, sf: str) -> DataFrame:
    pipes, tables = _installation(spark, sf)
    plans.run_range(
        spark, _landing(spark, sf), pipes, tables, date(1990, 1, 1), date(2010, 1, 1), t.RUN_TS,
        "Network", availability=t.availability(spark, sf),
    )
    return sinks.read_gold(spark, tables.gold)


def run_day(spark: SparkSession, sf: str) -> DataFrame:
    pipes, tables = _installation(spark, sf)
    plans.run_day(
        spark, _landing(spark, sf), pipes, tables, date(1999, 1, 1), t.RUN_TS, "Network",
        keep_run_gold=True,
    )
    return sinks.read_gold(spark, tables.gold)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    pipes, tables = _installation(spark, sf)
    streaming.ingest(
        spark, _landing(spark, sf), pipes, tables, "Network", new_folder(spark, "stream"),
        run_ts=t.RUN_TS, files_per_batch=100,
    )
    return sinks.read_gold(spark, tables.gold)


def run_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Yesterday's and today's points, and the no-notice figures of four days ago."""
    pipes, tables = _installation(spark, sf)
    plans.run_daily(spark, _landing(spark, sf), pipes, tables, t.DAILY_TS, "Network")
    return sinks.read_gold(spark, tables.gold)


def repost(spark: SparkSession, sf: str) -> DataFrame:
    """Some pipes post all their days again: only the later figures count, other pipes stay."""
    pipes, tables = _installation(spark, sf)
    path = new_folder(spark, "landing")
    t.write_oa_postings(t.oa_raw(spark, sf), path)
    t.write_oa_postings(t.reposted(t.oa_raw(spark, sf)), path, "0900")
    plans.run_range(
        spark, {fixed.OA: path}, pipes, tables, date(1990, 1, 1), date(2010, 1, 1), t.RUN_TS, "Network"
    )
    return sinks.read_gold(spark, tables.gold)


def repost_moved(spark: SparkSession, sf: str) -> DataFrame:
    """Some pipes post all their rows again a day later, between two runs: the days they have left lose them."""
    pipes, tables = _installation(spark, sf)
    path = new_folder(spark, "landing")
    for rows, time, at in (
        (t.oa_raw(spark, sf), "0800", t.RUN_TS - timedelta(hours=1)), (t.moved(t.oa_raw(spark, sf)), "0900", t.RUN_TS),
    ):
        t.write_oa_postings(rows, path, time)
        plans.run_range(spark, {fixed.OA: path}, pipes, tables, date(1990, 1, 1), date(2010, 1, 1), at, "Network")
    return sinks.read_gold(spark, tables.gold)


def stream_repost(spark: SparkSession, sf: str) -> DataFrame:
    """The same as files land: the first postings, then the second ones."""
    pipes, tables = _installation(spark, sf)
    path, stream = new_folder(spark, "landing"), new_folder(spark, "stream")
    for rows, time in ((t.oa_raw(spark, sf), "0800"), (t.reposted(t.oa_raw(spark, sf)), "0900")):
        t.write_oa_postings(rows, path, time)
        streaming.ingest(spark, {fixed.OA: path}, pipes, tables, "Network", stream, run_ts=t.RUN_TS)
    return sinks.read_gold(spark, tables.gold)


def replay_failed(spark: SparkSession, sf: str) -> DataFrame:
    """Two days far apart that failed for every pipe: they are run, the days between are not."""
    pipes, tables = _installation(spark, sf)
    log = new_folder(spark, "failures")
    days = F.explode(F.array(F.lit(date(1995, 1, 1)), F.lit(date(1999, 1, 1)))).alias("scrape_date")
    sources.append_failures(pipes.select(F.col("PipeCode").alias("pipecode"), F.lit("ALL").alias("type"), days), log)
    plans.replay_failed(spark, log, _landing(spark, sf), pipes, tables, t.RUN_TS, "Network")
    return sinks.read_gold(spark, tables.gold)


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """The five tables of the report, one below the other, as text."""
    found = O.reports(
        t.results(spark, sf), t.runs(spark, sf), audit_dataset_detail(spark, sf), t.availability(spark, sf),
        t.live_pipes(spark, sf), t.configured_pipes(spark, sf),
    )
    shown = {
        "summary": ["pipeline", "is_total", "total", "succeeded"], "failures": ["pipe_code", "dataset_type", "date", "error"],
        "details": ["dataset_type", "pipe_code", "raw_records", "silver_records"], "missing": ["pipe_code", "dataset_type"],
        "changes": ["change_type", "pipe_code", "live_name", "config_name"],
    }
    return O.union_by_name(*[
        getattr(found, name).select(
            F.lit(name).alias("report"),
            *[(F.col(columns[k]) if k < len(columns) else F.lit(None)).cast("string").alias(f"value{k + 1}") for k in range(4)],
        )
        for name, columns in shown.items()
    ])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        point_keys, parse_quantity, gas_month, flow_codes, file_name_parts, parse_pipe_labels,
        day_calendar, validate_pipes, validate_results, udf_batch, pipe_reference, parent_pipes,
        loc_reference, read_points, read_segments, oa_silver, nn_silver, sg_silver,
        drop_all_null, conform_fact, sg_directions, oa_gold, nn_gold, sg_gold, gold_merge,
        latest_cycle, rejects, meta_enrichment, meta_changes, new_point_locations, new_segment_locations,
        upsert_locations, replace_slices, cluster_months, silver_roundtrip, bronze_layout,
        audit_raw_counts, audit_raw_files, audit_silver_counts, audit_new_locations,
        audit_dataset_detail, audit_run_summary, audit_failures, pipe_changes,
        missing_downloads, late_deliveries, failed_worklist, run_range, run_day, stream_ingest,
        merge_slices, run_daily, repost, repost_moved, stream_repost, replay_failed, reports,
    ]
}
