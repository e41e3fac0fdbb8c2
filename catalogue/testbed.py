"""Domain-shaped inputs, derived row by row from the driver tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepack.functions import pipe_label
from linepack.shared import shuffles_removed

RUN_TS = datetime(2026, 1, 15, 6, 30)
RUN_DAY = date(2026, 1, 15)
DAILY_TS = datetime(1998, 3, 15, 6, 30)
MID_MONTH = datetime(2024, 1, 16, 3)
END_MONTH = datetime(2024, 2, 1)
PARENT = "AFRICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pipe_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipes as the outside keeps them: nations, their region as the parent."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "r_name AS ParentPipe",
        "n_name AS PipeName",
        "n_nationkey AS GFPipeID",
        "concat('P', n_nationkey) AS PipeCode",
        "n_regionkey AS Region",
    )


def pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipe_entities(spark, sf_dir).selectExpr(
        "ParentPipe", "PipeName", "lpad(CAST(GFPipeID AS string), 3, '0') AS GFPipeID", "PipeCode"
    )


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)


def oa_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point capacity: a posting per line item, some posted for several cycles or twice."""
    # The text is made before rows are doubled: once for each line item, not for each posting of it.
    rows = shipped(spark, sf_dir).selectExpr(
        """CASE l_linenumber WHEN 1 THEN array('Timely', 'Evening')
                             WHEN 2 THEN array('Timely', 'Timely')
                             ELSE array('Timely') END AS cycles""",
        "date_format(l_shipdate, 'MM-dd-yyyy') AS Post_Date",
        """CASE l_orderkey % 1000 WHEN 999 THEN 'not posted' WHEN 998 THEN NULL
                ELSE date_format(l_shipdate, 'MM-dd-yyyy') END AS Eff_Gas_Day""",
        "'Firm' AS Cap_Type_Desc",
        "'0800' AS Post_Time",
        "'0900' AS Eff_Time",
        "concat(' ', s_suppkey, chr(9)) AS Loc",
        "concat(s_name, ' ') AS Loc_Name",
        "concat('Z', s_nationkey % 4) AS Loc_Zn",
        """CASE concat(l_returnflag, l_linestatus)
                WHEN 'AF' THEN 'Delivery ' WHEN 'AO' THEN 'Storage Injection'
                WHEN 'NF' THEN 'Receipt' WHEN 'NO' THEN 'Storage Withdrawal'
                WHEN 'RF' THEN 'Other' END AS Flow_Ind_Desc""",
        "'M2' AS Loc_Purp_Desc",
        "'RPQ' AS Loc_QTI_Desc",
        "'MMBtu' AS Meas_Basis_Desc",
        "l_linestatus AS IT",
        "'Y' AS All_Qty_Avail",
        "format_number(l_extendedprice, 2) AS Total_Design_Capacity",
        "format_number(l_quantity * 1000, 2) AS Operating_Capacity",
        "format_number(l_quantity, 2) AS Total_Scheduled_Quantity",
        """CASE WHEN l_tax = 0 THEN 'n/q' ELSE format_number(l_quantity - l_extendedprice, 2) END
                AS Operationally_Available_Capacity""",
        "'Carrier' AS TSP_Name",
        "concat('0', s_nationkey) AS TSP",
        "CASE WHEN s_suppkey % 50 = 49 THEN 'ZZ' ELSE concat('P', s_nationkey) END AS PipeCode",
    )
    return rows.selectExpr("explode(cycles) AS Cycle_Desc", *rows.columns[1:])


def nn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No-notice activity: an allocation per order."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(
        "date_format(o_orderdate, 'MM/dd/yyyy HH:mm') AS Effective_From_DateTime",
        "concat(c_custkey, ' ') AS Loc_Prop",
        "c_name AS Loc_Name",
        "format_number(o_totalprice, 2) AS Allocated_Qty",
        """CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' WHEN o_orderpriority = '5-LOW' THEN NULL
                WHEN o_orderstatus = 'F' THEN 'D ' WHEN o_orderstatus = 'O' THEN 'R' ELSE 'B' END
                AS Direction_Of_Flow""",
        "'A' AS Accounting_Physincal_Indicator",
        "concat('P', c_nationkey) AS PipeCode",
    )


_SG_COLUMNS = [
    """CASE l_orderkey % 1000 WHEN 997 THEN NULL WHEN 996 THEN NULL
            ELSE concat('St', l_suppkey) END AS `Station Name`""",
    "CASE WHEN l_orderkey % 1000 = 996 THEN NULL ELSE l_quantity END AS Cap",
    """CASE WHEN l_orderkey % 1000 = 996 OR l_orderkey % 500 = 499 THEN NULL
            ELSE round(l_tax * 100) - 4 END AS Nom""",
    """CASE WHEN l_orderkey % 1000 = 996 OR l_linenumber % 2 = 1 THEN NULL
            ELSE -l_quantity / 2 END AS Cap2""",
]
_SG_PIPE = "CASE WHEN s_suppkey % 50 = 49 THEN 'ZZ' ELSE concat('P', s_nationkey) END AS PipeCode"


def sg_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment capacity: a station row per line item, one or two capacities."""
    return shipped(spark, sf_dir).selectExpr(
        *_SG_COLUMNS,
        "CAST(l_shipdate AS date) AS EffGasDate",
        "CASE WHEN l_linenumber = 1 THEN 'Evening' ELSE 'Timely' END AS CycleDesc",
        _SG_PIPE,
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known locations: two of three suppliers, half of them without a posted number,
    and some names a second time under another id."""
    supplier = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0")
    pipe = "lpad(CAST(s_nationkey AS string), 3, '0')"
    common = f"""{pipe} AS GFPipeID, concat('St', s_suppkey) AS LocName,
        CASE WHEN s_suppkey % 3 = 1 THEN '' ELSE CAST(s_suppkey AS string) END AS Loc"""
    first = supplier.selectExpr(
        *_columns(common), f"concat({pipe}, lpad(CAST(s_suppkey AS string), 7, '0')) AS GFLocID",
        "lpad(CAST(s_suppkey AS string), 7, '0') AS LocID",
    )
    second = supplier.where("s_suppkey % 10 = 1").selectExpr(
        *_columns(common), f"concat({pipe}, '9', lpad(CAST(s_suppkey AS string), 6, '0')) AS GFLocID",
        "concat('9', lpad(CAST(s_suppkey AS string), 6, '0')) AS LocID",
    )
    return first.unionByName(second)


def _columns(text: str) -> list[str]:
    """Split a select list at the commas outside of brackets."""
    parts, depth, last = [], 0, 0
    for at, sign in enumerate(text):
        depth += (sign == "(") - (sign == ")")
        if sign == "," and depth == 0:
            parts.append(text[last:at])
            last = at + 1
    return [*parts, text[last:]]


def meta_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of every supplier, once per flow direction, some with blanks around."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        "CAST(s_suppkey AS string) AS Loc",
        "concat(s_name, ' ') AS `Loc Name`",
        "concat('S', n_regionkey) AS `Loc St Abbrev`",
        "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat(' C', s_suppkey % 11) END AS `Loc Cnty`",
        "concat('Z', s_suppkey % 5) AS `Loc Zone`",
        "explode(array('D', 'R', 'R ')) AS `Dir Flo`",
        "concat('T', s_suppkey % 3) AS `Loc Type Ind`",
        "concat('P', s_nationkey) AS PipeCode",
    )


def stored_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was stored last time: the deliveries of most suppliers, one zone out of date."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    known = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return known.where("s_suppkey % 4 <> 3").selectExpr(
        "CAST(s_suppkey AS string) AS Loc",
        "s_name AS LocName",
        "concat('S', n_regionkey) AS LocStAbbrev",
        "CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat('C', s_suppkey % 11) END AS LocCnty",
        "CASE WHEN s_suppkey % 9 = 0 THEN 'Z9' ELSE concat('Z', s_suppkey % 5) END AS LocZone",
        "'D' AS DirFlo",
        "concat('T', s_suppkey % 3) AS LocTypeInd",
        "concat('P', s_nationkey) AS PipeCode",
        f"'{PARENT}' AS PartitionKey",
        "CAST(s_suppkey AS string) AS RowKey",
        "'20250101' AS ChangedOn",
    )



def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download results: an attempt per event, errors are failures."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('run', CAST(user_id % 7 AS string)) AS pipeline",
        "concat('P', user_id % 25) AS pipe_code",
        "CASE event_type WHEN 'view' THEN 'OA' WHEN 'click' THEN 'SG' WHEN 'purchase' THEN 'NN' WHEN 'signup' THEN 'META' ELSE 'OA' END AS dataset_type",
        "ts AS date",
        "event_type <> 'error' AS success",
        "value AS duration_s",
        "CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'timeout' END AS error",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their times, one of them still open and one without results."""
    events = table(spark, sf_dir, "events")
    return events.selectExpr("concat('run', CAST(user_id % 8 AS string)) AS pipeline", "ts").groupBy(
        "pipeline"
    ).agg(
        F.min("ts").alias("start_time"),
        F.when(F.col("pipeline") != "run3", F.max("ts")).alias("end_time"),
    )


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pipe offers which dataset."""
    return table(spark, sf_dir, "nation").selectExpr(
        "named_struct('label', concat(n_name, ' (P', n_nationkey, ')'), 'name', n_name, 'code', concat('P', n_nationkey)) AS pipe",
        "true AS has_OA",
        "n_nationkey % 2 = 0 AS has_SG",
        "n_nationkey % 3 = 0 AS has_NN",
        "n_nationkey % 5 = 0 AS has_MetaData",
    )


def live_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipes as the site lists them: a label with name and code."""
    labels = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").selectExpr(
        "concat(CASE WHEN c_custkey % 7 = 0 THEN 'New ' ELSE '' END, c_name, '  (c', c_custkey, ')') AS label"
    )
    return labels.select(pipe_label(F.col("label")).alias("p")).select("p.*")


def configured_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").selectExpr(
        "concat('C', c_custkey) AS PipeCode", "c_name AS PipeName"
    )


# Postings as files ------------------------------------------------------------

def _block(year: str) -> str:
    """First year of the block of four years that a year belongs to."""
    return f"CAST(1995 + 4 * ((CAST({year} AS int) - 1995) DIV 4) AS int)"


def _oa_file(time: str) -> str:
    return f"""concat(PipeCode, '_OA_', CAST(posted_year AS string), '0101_INTRDY_',
        CAST(posted_year AS string), '-01-01_{time}.csv')"""


#: Postings are text and lie there for the whole run: unpacked they are most of its disk. A packed file is read by
#: one task; parts are cut by size before they are written.
_PACKED = "lz4"


def _write_postings(rows: DataFrame, path: str) -> None:
    """One folder of packed part files per posting, as ``posting=<name>.csv``."""
    with shuffles_removed(rows.sparkSession, open_files=32):
        (
            rows.hint("rebalance", "posting")
            .write.mode("append")
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("compression", _PACKED)
            .partitionBy("posting")
            .csv(path)
        )


def posted(raw: DataFrame, dataset: str, day: str) -> DataFrame:
    """Rows with the name of the posting they could come from."""
    return raw.withColumn("PostingFile", F.expr(
        f"concat(PipeCode, '_{dataset}_', {day}, '01_INTRDY.csv')"
    ))


def reposted(oa: DataFrame) -> DataFrame:
    """What the pipes of even nations post a second time, with another mark on every row."""
    return oa.where("PipeCode <> 'ZZ' AND CAST(TSP AS int) % 2 = 0").withColumn("IT", F.lit("X"))


def moved(oa: DataFrame) -> DataFrame:
    """What the pipes of even nations post a second time, every readable gas day one day later."""
    later = F.date_format(F.date_add(F.try_to_date("Eff_Gas_Day", "MM-dd-yyyy"), 1), "MM-dd-yyyy")
    return oa.where("PipeCode <> 'ZZ' AND CAST(TSP AS int) % 2 = 0").withColumn("Eff_Gas_Day", F.coalesce(later, "Eff_Gas_Day"))


def write_oa_postings(rows: DataFrame, path: str, time: str = "0800") -> None:
    """OA files by pipe and four years; later files have other columns in another order."""
    rows = (
        rows.withColumn("posted_year", F.expr(f"{_block('substring(Post_Date, 7, 4)')}"))
        .withColumn("posting", F.expr(_oa_file(time)))
        .drop("PipeCode")
    )
    early = rows.where("posted_year < 1999").drop("posted_year")
    turned = list(reversed([c for c in early.columns if c != "posting"]))
    late = rows.where("posted_year >= 1999").select(
        *turned[:3], F.lit("late, \"noted\"").alias("Remark"), *turned[3:], "posting"
    )
    _write_postings(early, path)
    _write_postings(late, path)


def write_nn_postings(rows: DataFrame, path: str) -> None:
    rows = rows.withColumn(
        "posting",
        F.expr(f"concat(PipeCode, '_NN_', {_block('substring(Effective_From_DateTime, 7, 4)')}, '.csv')"),
    )
    _write_postings(rows.drop("PipeCode"), path)


def sg_posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment rows as a file holds them: the day and cycle of the file for all its rows."""
    return shipped(spark, sf_dir).selectExpr(
        *_SG_COLUMNS,
        f"make_date({_block('year(l_shipdate)')}, 1, 1) AS EffGasDate",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'Timely' ELSE 'Evening' END AS CycleDesc",
        _SG_PIPE,
        "l_suppkey % 2 AS segment",
    )


def write_meta_postings(rows: DataFrame, path: str) -> None:
    _write_postings(
        rows.withColumn("posting", F.concat("PipeCode", F.lit("_AllPoints.csv"))).drop("PipeCode"), path
    )


def write_sg_postings(rows: DataFrame, path: str) -> None:
    """SG files by pipe, segment and four years: the head line, the names, then the rows."""
    rows = rows.withColumn(
        "posting",
        F.expr("""concat(PipeCode, '_SG_Line_', segment, '_', date_format(EffGasDate, 'yyyyMMdd'),
                         '_INTRDY.csv')"""),
    )
    body = rows.select(
        "posting",
        F.lit(2).alias("at"),
        F.to_csv(F.struct("Station Name", "Cap", "Nom", "Cap2")).alias("value"),
    )
    heads = rows.select("posting", "EffGasDate", "CycleDesc").distinct().select(
        "posting",
        F.posexplode(F.array(
            F.concat(F.lit("Gas Date: "), F.date_format("EffGasDate", "yyyy-MM-dd"),
                     F.lit("  Cycle: "), "CycleDesc"),
            F.lit("Station Name,Cap,Nom,Cap2"),
        )).alias("at", "value"),
    )
    with shuffles_removed(rows.sparkSession):
        (
            heads.unionByName(body)
            .repartition("posting")
            .sortWithinPartitions("posting", "at")
            .select("posting", "value")
            .write.option("compression", _PACKED)
            .partitionBy("posting")
            .text(path)
        )
