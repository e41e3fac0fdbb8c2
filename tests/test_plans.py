"""What Spark makes of the operators: scans, joins, shuffles, no Python."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries
from catalogue import testbed as t
from linepack import operators as O

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups")


def plan(df, mode="formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", ["oa_gold", "nn_gold", "sg_gold", "gold_merge", "rejects", "meta_changes"])
def test_no_python_and_broadcast_pipes(spark, name):
    text = plan(queries()[name](spark, SF))
    assert not PYTHON.search(text)
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_the_user_function_is_the_only_python(spark):
    assert PYTHON.search(plan(queries()["udf_batch"](spark, SF)))


def test_directions_scan_their_input_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    O.segment_silver(t.sg_raw(spark, SF), t.pipes(spark, SF)).write.parquet(path)
    text = plan(O.sg_directions(spark.read.parquet(path)), "simple")
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_pipes_are_broadcast_and_only_the_distinct_shuffles(spark, tmp_path):
    raw, pipes = str(tmp_path / "raw"), str(tmp_path / "pipes")
    t.oa_raw(spark, SF).write.parquet(raw)
    t.pipes(spark, SF).write.parquet(pipes)
    text = plan(O.point_silver(spark.read.parquet(raw), spark.read.parquet(pipes), "Loc"), "simple")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_gold_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "silver")
    O.point_silver(t.oa_raw(spark, SF), t.pipes(spark, SF), "Loc").write.parquet(path)
    text = plan(O.gold_oa(spark.read.parquet(path)))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "TSP_Name" not in schema and "Cycle_Desc" not in schema and "Operating_Capacity" in schema


def test_merging_slices_shuffles_rows_once(spark, tmp_path):
    """The exchange by slice and part also serves the distinct."""
    from pyspark.sql import functions as F

    from linepack.sinks import gold

    path, counted = str(tmp_path / "facts"), str(tmp_path / "sizes")
    queries()["nn_gold"](spark, SF).write.parquet(path)
    facts = spark.read.parquet(path)
    columns = gold.slice_columns()
    facts.groupBy(*columns).agg(F.count("*").alias("_parts")).write.parquet(counted)
    text = plan(gold.distinct_by_slice(facts, spark.read.parquet(counted), columns), "simple")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "BroadcastHashJoin" in text


def test_merging_evaluates_the_facts_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from linepack import sinks

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        seen.add(1)
        return value

    facts = queries()["nn_gold"](spark, SF).cache()
    rows = facts.count()
    sinks.merge_slices(facts.withColumn("OperatingCapacity", counted.asNondeterministic()("OperatingCapacity")), str(tmp_path / "gold"))
    assert seen.value == rows


def test_profiling_hashes_and_never_sorts_lines(spark, tmp_path):
    from linepack import sources

    (tmp_path / "P1_OA_1.csv").write_text("Loc\n1\n")
    text = plan(sources.profile(spark, str(tmp_path)), "simple")
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort " not in text


def test_profiling_decodes_a_name_per_file_not_per_line(spark, tmp_path):
    from linepack import sources

    (tmp_path / "P1_OA_1.csv").write_text("Loc\n1\n")
    (tmp_path / "notes.txt").write_text("Loc\n1\n")
    files = sources.profile(spark, str(tmp_path))
    above, below = files._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)
    assert "UrlCodec" in above and "UrlCodec" not in below
    assert [(r.name, r.lines) for r in files.collect()] == [("P1_OA_1.csv", 2)]


def test_a_record_is_split_once_and_each_field_is_looked_at_once(spark, tmp_path):
    from linepack import sources

    (tmp_path / "P1_OA_20250101_INTRDY_x.csv").write_text("Loc,A,B\n1,NA,2\n2,3,4,5\n3,,n/a,NA\n")
    rows = sources.read_points(spark, str(tmp_path))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_csv(") == 1
    assert text.count("UrlCodec") == 0  # names are decoded in the row of a file
    found = {r.Loc: (r.A, r.B, r.TooWide, r.PipeCode, r.PostingFile) for r in rows.collect()}
    name = "P1_OA_20250101_INTRDY_x.csv"
    assert found == {
        "1": (None, "2", False, "P1", name), "2": ("3", "4", True, "P1", name), "3": (None, None, True, "P1", name),
    }


def test_merged_facts_are_made_distinct_once(spark):
    """Silver rows of facts that become distinct anyway do not cross the network for it."""
    text = queries()["gold_merge"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [") == 1


def test_posted_text_is_made_before_rows_are_doubled(spark):
    from catalogue import testbed

    text = testbed.oa_raw(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Generate", 1)
    assert "format_number" not in above and "format_number" in below


def test_the_detail_audit_finds_locations_in_the_written_silver(spark):
    text = queries()["audit_dataset_detail"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [o_orderkey") == 2  # postings and their counts; silver is not made from orders again


def test_the_audit_of_a_run_counts_its_postings_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from linepack.plans import jobs

    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    rows = [("P1", "a.csv"), ("P1", "b.csv"), ("P2", "b.csv"), ("P1", "b.csv"), (None, "c.csv"), ("P2", None)]
    raw = spark.createDataFrame(rows, "PipeCode string, PostingFile string")
    raw = raw.withColumn("PipeCode", F.udf(count, "string").asNondeterministic()("PipeCode"))
    spark.range(3).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    tables = jobs.Tables(str(tmp_path / "installation"))
    posted = jobs.write_audit({"NN": raw}, {"NN": silver}, {"NN": silver}, tables, "r1")
    assert {tuple(r) for r in posted.collect()} == {("NN", "P1", 3, 2), ("NN", "P2", 2, 2), ("NN", None, 1, 1)}
    assert spark.read.parquet(f"{tables.audit}/raw_files").count() == 5
    assert seen.value == len(rows)
