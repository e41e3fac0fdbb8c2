"""The same questions as SQL over the driver tables, written from the rules."""

from __future__ import annotations

_BASE = r"""
pipes AS (
  SELECT r_name AS ParentPipe, n_name AS PipeName, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS GFPipeID,
         'P' || n_nationkey AS PipeCode
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
shipped AS (SELECT * FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
oa_raw AS (
  SELECT unnest(CASE l_linenumber WHEN 1 THEN ['Timely', 'Evening'] WHEN 2 THEN ['Timely', 'Timely']
                                  ELSE ['Timely'] END) AS Cycle_Desc,
         strftime(l_shipdate, '%m-%d-%Y') AS Post_Date,
         CASE l_orderkey % 1000 WHEN 999 THEN 'not posted' WHEN 998 THEN NULL
              ELSE strftime(l_shipdate, '%m-%d-%Y') END AS Eff_Gas_Day,
         'Firm' AS Cap_Type_Desc, '0800' AS Post_Time, '0900' AS Eff_Time,
         ' ' || s_suppkey || chr(9) AS Loc, s_name || ' ' AS Loc_Name, 'Z' || (s_nationkey % 4) AS Loc_Zn,
         CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Delivery ' WHEN 'AO' THEN 'Storage Injection'
              WHEN 'NF' THEN 'Receipt' WHEN 'NO' THEN 'Storage Withdrawal' WHEN 'RF' THEN 'Other' END
              AS Flow_Ind_Desc,
         'M2' AS Loc_Purp_Desc, 'RPQ' AS Loc_QTI_Desc, 'MMBtu' AS Meas_Basis_Desc, l_linestatus AS IT,
         'Y' AS All_Qty_Avail, format('{:,.2f}', l_extendedprice) AS Total_Design_Capacity,
         format('{:,.2f}', l_quantity * 1000) AS Operating_Capacity,
         format('{:,.2f}', l_quantity) AS Total_Scheduled_Quantity,
         CASE WHEN l_tax = 0 THEN 'n/q' ELSE format('{:,.2f}', l_quantity - l_extendedprice) END
              AS Operationally_Available_Capacity,
         'Carrier' AS TSP_Name, '0' || s_nationkey AS TSP,
         CASE WHEN s_suppkey % 50 = 49 THEN 'ZZ' ELSE 'P' || s_nationkey END AS PipeCode
  FROM shipped
),
nn_raw AS (
  SELECT strftime(o_orderdate, '%m/%d/%Y %H:%M') AS Effective_From_DateTime, c_custkey || ' ' AS Loc_Prop,
         c_name AS Loc_Name, format('{:,.2f}', o_totalprice) AS Allocated_Qty,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' WHEN o_orderpriority = '5-LOW' THEN NULL
              WHEN o_orderstatus = 'F' THEN 'D ' WHEN o_orderstatus = 'O' THEN 'R' ELSE 'B' END
              AS Direction_Of_Flow,
         'A' AS Accounting_Physincal_Indicator, 'P' || c_nationkey AS PipeCode
  FROM orders JOIN customer ON o_custkey = c_custkey
),
sg_all AS (
  SELECT CASE l_orderkey % 1000 WHEN 997 THEN NULL WHEN 996 THEN NULL ELSE 'St' || l_suppkey END
              AS "Station Name",
         CASE WHEN l_orderkey % 1000 = 996 THEN NULL ELSE l_quantity END AS Cap,
         CASE WHEN l_orderkey % 1000 = 996 OR l_orderkey % 500 = 499 THEN NULL
              ELSE round(l_tax * 100) - 4 END AS Nom,
         CASE WHEN l_orderkey % 1000 = 996 OR l_linenumber % 2 = 1 THEN NULL ELSE -l_quantity / 2 END AS Cap2,
         CAST(l_shipdate AS DATE) AS day, l_linenumber, l_suppkey,
         CASE WHEN s_suppkey % 50 = 49 THEN 'ZZ' ELSE 'P' || s_nationkey END AS PipeCode
  FROM shipped
),
sg_raw AS (
  SELECT "Station Name", Cap, Nom, Cap2, day AS EffGasDate,
         CASE WHEN l_linenumber = 1 THEN 'Evening' ELSE 'Timely' END AS CycleDesc, PipeCode
  FROM sg_all
),
locations AS (
  SELECT lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS GFPipeID, 'St' || s_suppkey AS LocName,
         CASE WHEN s_suppkey % 3 = 1 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS Loc,
         lpad(CAST(s_nationkey AS VARCHAR), 3, '0') || LocID AS GFLocID, LocID
  FROM (
    SELECT *, lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS LocID FROM supplier WHERE s_suppkey % 3 <> 0
    UNION ALL
    SELECT *, '9' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') FROM supplier
    WHERE s_suppkey % 3 <> 0 AND s_suppkey % 10 = 1
  )
),
meta_raw AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS Loc, s_name || ' ' AS "Loc Name", 'S' || n_regionkey AS "Loc St Abbrev",
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE ' C' || (s_suppkey % 11) END AS "Loc Cnty",
         'Z' || (s_suppkey % 5) AS "Loc Zone", unnest(['D', 'R', 'R ']) AS "Dir Flo",
         'T' || (s_suppkey % 3) AS "Loc Type Ind", 'P' || s_nationkey AS PipeCode
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def _silver(oa: str = "oa_raw", nn: str = "nn_raw", sg: str = "sg_raw") -> str:
    oa_columns = """Cycle_Desc, Post_Date, Eff_Gas_Day, Cap_Type_Desc, Post_Time, Eff_Time, Loc_Name, Loc_Zn,
        Flow_Ind_Desc, Loc_Purp_Desc, Loc_QTI_Desc, Meas_Basis_Desc, IT, All_Qty_Avail, Total_Design_Capacity,
        Operating_Capacity, Total_Scheduled_Quantity, Operationally_Available_Capacity, TSP_Name, TSP"""
    return rf"""
oa_silver AS (
  SELECT DISTINCT {oa_columns}, PipeName, regexp_replace(Loc, '^\s+|\s+$', '', 'g') AS Loc,
         GFPipeID || CASE WHEN length(regexp_replace(Loc, '^\s+|\s+$', '', 'g')) >= 7
                          THEN regexp_replace(Loc, '^\s+|\s+$', '', 'g')
                          ELSE lpad(regexp_replace(Loc, '^\s+|\s+$', '', 'g'), 7, '0') END AS GFLocID
  FROM {oa} JOIN pipes USING (PipeCode)
),
nn_silver AS (
  SELECT DISTINCT Effective_From_DateTime, Loc_Name, Allocated_Qty, Direction_Of_Flow,
         Accounting_Physincal_Indicator, PipeName, trim(Loc_Prop) AS Loc_Prop,
         GFPipeID || CASE WHEN length(trim(Loc_Prop)) >= 7 THEN trim(Loc_Prop)
                          ELSE lpad(trim(Loc_Prop), 7, '0') END AS GFLocID
  FROM {nn} JOIN pipes USING (PipeCode)
),
sg_silver AS (
  SELECT DISTINCT "Station Name", Cap, Nom, Cap2, EffGasDate, CycleDesc, GFPipeID
  FROM {sg} JOIN pipes USING (PipeCode)
)"""


def _amount(column: str) -> str:
    return f"CAST(TRY_CAST(replace({column}, ',', '') AS DECIMAL(38,2)) AS DOUBLE)"


_DIRECTIONS = """
directed AS (
  SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap) AS OpCap, abs(Nom) AS Nom, 'TD2' AS FlowInd
    FROM sg_silver WHERE Cap2 IS NULL AND Nom < 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap), abs(Nom), 'TD1'
    FROM sg_silver WHERE Cap2 IS NULL AND Nom >= 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap), 0.0, 'TD1' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom < 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap2), abs(Nom), 'TD2' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom < 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap), abs(Nom), 'TD1' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom > 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap2), 0.0, 'TD2' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom > 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap), 0.0, 'TD1' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom = 0
  UNION ALL SELECT * EXCLUDE (Cap, Nom, Cap2), abs(Cap2), 0.0, 'TD2' FROM sg_silver WHERE Cap2 IS NOT NULL AND Nom = 0
)"""


def _gold(locations: str = "locations") -> str:
    return rf"""{_DIRECTIONS},
oa_gold AS (
  SELECT CAST(year(GasDay) * 100 + month(GasDay) AS BIGINT) AS GasMonth, GasDay, 'OA' AS Dataset, GFLocID,
         trim(Loc_Name) AS LocName, {_amount('Total_Design_Capacity')} AS DesignCapacity,
         {_amount('Operating_Capacity')} AS OperatingCapacity,
         {_amount('Total_Scheduled_Quantity')} AS TotalScheduledQuantity,
         {_amount('Operationally_Available_Capacity')} AS OperationallyAvailableCapacity, IT,
         CASE trim(Flow_Ind_Desc) WHEN 'Delivery' THEN 'D' WHEN 'Receipt' THEN 'R'
              WHEN 'Storage Injection' THEN 'D' WHEN 'Storage Withdrawal' THEN 'R' ELSE 'Z' END AS FlowDirection,
         CAST(NULL AS TIMESTAMP) AS Timestamp
  FROM (SELECT *, CAST(TRY_STRPTIME(Eff_Gas_Day, '%m-%d-%Y') AS DATE) AS GasDay FROM oa_silver)
  WHERE GasDay IS NOT NULL
),
nn_gold AS (
  SELECT CAST(year(GasDay) * 100 + month(GasDay) AS BIGINT) AS GasMonth, GasDay, 'NN' AS Dataset, GFLocID,
         trim(Loc_Name) AS LocName, CAST(NULL AS DOUBLE) AS DesignCapacity, CAST(NULL AS DOUBLE) AS OperatingCapacity,
         {_amount('Allocated_Qty')} AS TotalScheduledQuantity,
         CAST(NULL AS DOUBLE) AS OperationallyAvailableCapacity, CAST(NULL AS VARCHAR) AS IT,
         CASE WHEN trim(Direction_Of_Flow) = 'B' THEN 'N' ELSE trim(Direction_Of_Flow) END AS FlowDirection,
         CAST(NULL AS TIMESTAMP) AS Timestamp
  FROM (SELECT *, CAST(TRY_STRPTIME(Effective_From_DateTime, '%m/%d/%Y %H:%M') AS DATE) AS GasDay FROM nn_silver)
  WHERE GasDay IS NOT NULL
),
sg_gold AS (
  SELECT CAST(year(EffGasDate) * 100 + month(EffGasDate) AS BIGINT) AS GasMonth, EffGasDate AS GasDay,
         'SG' AS Dataset, l.GFLocID, l.LocName, CAST(NULL AS DOUBLE) AS DesignCapacity, OpCap AS OperatingCapacity,
         Nom AS TotalScheduledQuantity, OpCap - Nom AS OperationallyAvailableCapacity, CAST(NULL AS VARCHAR) AS IT,
         CASE FlowInd WHEN 'TD1' THEN 'F' WHEN 'TD2' THEN 'B' ELSE 'N' END AS FlowDirection,
         CAST(NULL AS TIMESTAMP) AS Timestamp
  FROM directed d JOIN {locations} l ON l.LocName = d."Station Name" AND l.GFPipeID = d.GFPipeID
)"""


_STAMPED = "* REPLACE (TIMESTAMP '2026-01-15 06:30:00' AS Timestamp)"

_META = """
enriched AS (
  SELECT GFPipeID || lpad(Loc, 7, '0') AS GFLocID, PipeCode, Loc, trim("Loc Name") AS "Loc Name",
         "Loc St Abbrev" AS State, coalesce(trim("Loc Cnty"), '') AS County, "Loc Zone" AS LocZone,
         'D' AS "Dir Flo", "Loc Type Ind" AS ReportedFacilityType, GFPipeID, PipeName
  FROM meta_raw JOIN pipes USING (PipeCode) WHERE "Dir Flo" = 'D'
)"""

_NEW_POINTS = """
candidates AS (
  SELECT 'OA' AS Dataset, GFLocID, trim(Loc_Name) AS LocName, Loc, PipeName FROM oa_silver
  UNION SELECT 'NN', GFLocID, trim(Loc_Name), Loc_Prop, PipeName FROM nn_silver
),
new_points AS (
  SELECT Dataset, substring(c.GFLocID, 1, 3) AS GFPipeID, c.PipeName, c.GFLocID, '' AS GF_LocID_Tag,
         CASE WHEN length(c.Loc) >= 7 THEN c.Loc ELSE lpad(c.Loc, 7, '0') END AS LocID, c.Loc, '' AS GF_LocName,
         c.LocName, '' AS GF_FacilityType, '' AS GF_FacilityTypeGroup, e.ReportedFacilityType, '' AS LocSegment,
         e.LocZone, e.State, e.County, '' AS InterconnectingEntity,
         TIMESTAMP '2026-01-15 06:30:00' AS UpdatedTime
  FROM (SELECT *, row_number() OVER (PARTITION BY Dataset, GFLocID ORDER BY LocName NULLS LAST, Loc, PipeName) AS n
        FROM candidates) c
  LEFT JOIN enriched e ON e.GFLocID = c.GFLocID
  WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM locations k WHERE k.GFLocID = c.GFLocID)
)"""

_NEW_STATIONS = """
stations AS (
  SELECT DISTINCT GFPipeID, "Station Name" AS LocName FROM sg_silver s
  WHERE "Station Name" IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM locations k WHERE k.GFPipeID = s.GFPipeID AND k.LocName = s."Station Name")
),
numbered AS (
  SELECT s.GFPipeID, s.LocName,
         'GF' || lpad(CAST(coalesce(k.n, 0) + row_number() OVER (PARTITION BY s.GFPipeID ORDER BY s.LocName)
                           AS VARCHAR), 5, '0') AS LocID
  FROM stations s LEFT JOIN (SELECT GFPipeID, count(*) AS n FROM locations WHERE Loc IS NULL OR Loc = ''
                             GROUP BY GFPipeID) k ON k.GFPipeID = s.GFPipeID
),
new_stations AS (
  SELECT n.GFPipeID, p.PipeName, n.GFPipeID || n.LocID AS GFLocID, '' AS GF_LocID_Tag, n.LocID, '' AS Loc,
         '' AS GF_LocName, n.LocName, '' AS GF_FacilityType, '' AS GF_FacilityTypeGroup,
         '' AS ReportedFacilityType, '' AS LocSegment, '' AS LocZone, '' AS State, '' AS County,
         '' AS InterconnectingEntity, TIMESTAMP '2026-01-15 06:30:00' AS UpdatedTime
  FROM numbered n LEFT JOIN pipes p ON p.GFPipeID = n.GFPipeID
)"""

_BLOCKS = """
sg_blocks AS (
  SELECT "Station Name", Cap, Nom, Cap2, make_date(1995 + 4 * ((year(day) - 1995) // 4), 1, 1) AS EffGasDate,
         CASE WHEN l_suppkey % 2 = 0 THEN 'Timely' ELSE 'Evening' END AS CycleDesc, PipeCode
  FROM sg_all
)"""

_POSTED = """
posted AS (
  SELECT 'OA' AS Dataset, PipeCode, substring(Post_Date, 7, 4) || substring(Post_Date, 1, 2) AS ym FROM oa_raw
  UNION ALL SELECT 'NN', PipeCode, substring(Effective_From_DateTime, 7, 4) || substring(Effective_From_DateTime, 1, 2)
    FROM nn_raw
  UNION ALL SELECT 'SG', PipeCode, strftime(EffGasDate, '%Y%m') FROM sg_raw
),
named AS (SELECT *, PipeCode || '_' || Dataset || '_' || ym || '01_INTRDY.csv' AS PostingFile FROM posted)"""

_RAW_COUNTS = """
raw_counts AS (
  SELECT Dataset AS dataset_type, PipeCode AS pipe_code, count(*) AS raw_records,
         count(DISTINCT PostingFile) AS raw_files FROM named GROUP BY 1, 2
)"""

_SILVER_COUNTS = """
silver_counts AS (
  SELECT 'OA' AS dataset_type, count(*) AS silver_records FROM oa_silver
  UNION ALL SELECT 'NN', count(*) FROM nn_silver UNION ALL SELECT 'SG', count(*) FROM sg_silver
)"""

_NEW_COUNTS = """
new_counts AS (
  SELECT 'OA' AS dataset_type, count(*) AS new_locations FROM new_points WHERE Dataset = 'OA'
  UNION ALL SELECT 'NN', count(*) FROM new_points WHERE Dataset = 'NN'
  UNION ALL SELECT 'SG', count(*) FROM new_stations
)"""

_RESULTS = """
results AS (
  SELECT 'run' || CAST(user_id % 7 AS VARCHAR) AS pipeline, 'P' || (user_id % 25) AS pipe_code,
         CASE event_type WHEN 'view' THEN 'OA' WHEN 'click' THEN 'SG' WHEN 'purchase' THEN 'NN'
                         WHEN 'signup' THEN 'META' ELSE 'OA' END AS dataset_type,
         ts AS date, event_type <> 'error' AS success, value AS duration_s,
         CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'timeout' END AS error
  FROM events
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _run_gold() -> list[str]:
    return [_BASE, _BLOCKS, _silver(sg="sg_blocks"), _META, _NEW_STATIONS]


_ALL_LOCATIONS = """
all_locations AS (
  SELECT GFPipeID, LocName, GFLocID FROM locations UNION ALL SELECT GFPipeID, LocName, GFLocID FROM new_stations
)"""


def _run(where: str) -> str:
    return _with(
        *_run_gold(), _ALL_LOCATIONS, _gold("all_locations"),
        select=f"""SELECT DISTINCT {_STAMPED} FROM (
          SELECT * FROM oa_gold UNION ALL SELECT * FROM nn_gold UNION ALL SELECT * FROM sg_gold) {where}""",
    )


_REPOST = _with(
    _BASE, """
oa_twice AS (
  SELECT * REPLACE (CASE WHEN PipeCode <> 'ZZ' AND CAST(TSP AS INT) % 2 = 0 THEN 'X' ELSE IT END AS IT) FROM oa_raw
)""", _silver("oa_twice"), _gold(),
    select=f"SELECT DISTINCT {_STAMPED} FROM oa_gold",
)


_MOVED = _with(
    _BASE, """
oa_moved AS (
  SELECT * REPLACE (CASE WHEN PipeCode <> 'ZZ' AND CAST(TSP AS INT) % 2 = 0 AND TRY_STRPTIME(Eff_Gas_Day, '%m-%d-%Y') IS NOT NULL
                         THEN strftime(TRY_STRPTIME(Eff_Gas_Day, '%m-%d-%Y') + INTERVAL 1 DAY, '%m-%d-%Y')
                         ELSE Eff_Gas_Day END AS Eff_Gas_Day) FROM oa_raw
)""", _silver("oa_moved"), _gold(),
    select=f"SELECT DISTINCT {_STAMPED} FROM oa_gold",
)


ORACLES: dict[str, str] = {
    "point_keys": _with(_BASE, select=r"""
        SELECT PipeCode, regexp_replace(Loc, '^\s+|\s+$', '', 'g') AS Loc, k AS LocID, GFPipeID || k AS GFLocID,
               substring(GFPipeID || k, 1, 3) AS PipeOfKey, true AS Signed
        FROM (SELECT *, CASE WHEN length(regexp_replace(Loc, '^\s+|\s+$', '', 'g')) >= 7
                             THEN regexp_replace(Loc, '^\s+|\s+$', '', 'g')
                             ELSE lpad(regexp_replace(Loc, '^\s+|\s+$', '', 'g'), 7, '0') END AS k
              FROM oa_raw JOIN pipes USING (PipeCode))"""),
    "parse_quantity": _with(_BASE, select=f"""
        SELECT {_amount('Total_Design_Capacity')} AS design, {_amount('Operating_Capacity')} AS operating,
               {_amount('Operationally_Available_Capacity')} AS available,
               Operationally_Available_Capacity = 'n/q' AS unreadable FROM oa_raw"""),
    "gas_month": _with(_BASE, select="""
        SELECT Eff_Gas_Day, d AS GasDay, CAST(year(d) * 100 + month(d) AS BIGINT) AS GasMonth
        FROM (SELECT Eff_Gas_Day, CAST(TRY_STRPTIME(Eff_Gas_Day, '%m-%d-%Y') AS DATE) AS d FROM oa_raw)"""),
    "flow_codes": _with(_BASE, select="""
        SELECT 'OA' AS kind, Flow_Ind_Desc AS code,
               CASE WHEN trim(Flow_Ind_Desc) IN ('Delivery', 'Storage Injection') THEN 'D'
                    WHEN trim(Flow_Ind_Desc) IN ('Receipt', 'Storage Withdrawal') THEN 'R' ELSE 'Z' END AS flow,
               CASE WHEN trim(Flow_Ind_Desc) IN ('Receipt', 'Storage Withdrawal') THEN 'R' ELSE 'D' END AS helper_flow
        FROM oa_raw
        UNION ALL
        SELECT 'NN', Direction_Of_Flow,
               CASE WHEN trim(Direction_Of_Flow) = 'B' THEN 'N' ELSE trim(Direction_Of_Flow) END,
               CASE trim(Direction_Of_Flow) WHEN 'R' THEN 'R' WHEN 'B' THEN 'N' ELSE 'D' END
        FROM nn_raw"""),
    "file_name_parts": _with(_BASE, select="""
        SELECT CASE WHEN l_linenumber = 7 THEN stem || '_AllPoints.csv'
                    WHEN l_linenumber = 6 THEN stem || tail || '/part-00000-x.csv' ELSE stem || tail END AS path,
               CASE WHEN l_linenumber = 7 THEN 'P' || s_nationkey || '_AllPoints.csv'
                    ELSE 'P' || s_nationkey || tail END AS posting,
               'P' || s_nationkey AS PipeCode,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE strftime(l_shipdate, '%Y%m%d') END AS eff_date,
               CASE WHEN l_linenumber = 7 THEN 'P' || s_nationkey || '_AllPoints.csv'
                    WHEN l_linenumber = 6 THEN 'part-00000-x.csv' ELSE 'P' || s_nationkey || tail END AS last
        FROM (SELECT *, 'file:/landing/SG/P' || s_nationkey AS stem,
                     '_SG_Line_' || l_linenumber || l_linestatus || '_N_' || strftime(l_shipdate, '%Y%m%d')
                     || '_INTRDY.csv' AS tail FROM shipped)"""),
    "parse_pipe_labels": """SELECT c_custkey, c_name AS name, c_mktsegment AS code FROM customer
        WHERE c_custkey % 10 <> 0""",
    "day_calendar": """SELECT c_nationkey, CAST(d AS DATE) AS day,
               least(CAST(d AS DATE), DATE '2000-06-11') AS nn_day
        FROM (SELECT c_nationkey, unnest(generate_series(CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP),
                     least(CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP), TIMESTAMP '2000-06-15'), INTERVAL 1 DAY)) AS d
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)""",
    "validate_pipes": """
        SELECT PipeCode, ParentPipe, PipeName, GFPipeID, nullif(concat_ws('; ',
               CASE WHEN length(PipeCode) NOT BETWEEN 2 AND 10 THEN 'code length' END,
               CASE WHEN length(ParentPipe) NOT BETWEEN 2 AND 50 THEN 'parent length' END,
               CASE WHEN PipeName IS NULL OR length(PipeName) < 2 THEN 'name length' END,
               CASE WHEN GFPipeID > 999 THEN 'id is not three digits' END), '') AS Reason
        FROM (SELECT upper(c_mktsegment || (c_nationkey % 3)) AS PipeCode,
                     CASE WHEN c_custkey % 11 = 0 THEN 'A' ELSE c_name END AS ParentPipe,
                     CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS PipeName, c_custkey AS GFPipeID
              FROM customer)""",
    "validate_results": _with(_RESULTS, select="""
        SELECT *, nullif(concat_ws('; ', CASE WHEN dataset_type = 'ALL' THEN 'unknown dataset' END,
               CASE WHEN duration_s < 0 THEN 'negative duration' END,
               CASE WHEN success AND error IS NOT NULL THEN 'error on success' END), '') AS Reason
        FROM (SELECT * REPLACE (CASE WHEN duration_s > 100 THEN 'ALL' ELSE dataset_type END AS dataset_type,
                                duration_s - 1 AS duration_s,
                                CASE WHEN duration_s < 20 THEN 'late' ELSE error END AS error) FROM results)"""),
    "udf_batch": _with(_BASE, select="SELECT Nom, abs(Nom) AS magnitude FROM sg_raw"),
    "pipe_reference": _with(_BASE, select="SELECT * FROM pipes"),
    "parent_pipes": _with(_BASE, select="SELECT GFPipeID, PipeCode, PipeName FROM pipes WHERE ParentPipe = 'AFRICA'"),
    "loc_reference": """SELECT CASE WHEN o_orderkey % 10 = 9 THEN NULL WHEN o_custkey % 1200 > 999
                    THEN CAST(o_custkey % 1200 AS VARCHAR) ELSE lpad(CAST(o_custkey % 1200 AS VARCHAR), 3, '0') END
                    AS GFPipeID, CAST(o_orderkey AS VARCHAR) AS LocID, o_orderstatus AS LocName,
               CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(o_orderdate + INTERVAL 1500 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%f') END AS UpdatedTime
        FROM orders""",
    "read_points": _with(_BASE, select="""
        SELECT * EXCLUDE (y), CASE WHEN y = '1999' THEN 'late, "noted"' END AS Remark,
               PipeCode || '_OA_' || y || '0101_INTRDY_' || y || '-01-01_0800.csv' AS PostingFile, false AS TooWide
        FROM (SELECT *, CAST(1995 + 4 * ((CAST(substring(Post_Date, 7, 4) AS INTEGER) - 1995) // 4) AS VARCHAR) AS y
              FROM oa_raw)"""),
    "read_segments": _with(_BASE, select="""
        SELECT "Station Name", Cap, Nom, Cap2, make_date(y, 1, 1) AS EffGasDate,
               CASE WHEN l_suppkey % 2 = 0 THEN 'Timely' ELSE 'Evening' END AS CycleDesc, PipeCode,
               PipeCode || '_SG_Line_' || (l_suppkey % 2) || '_' || y || '0101_INTRDY.csv' AS PostingFile, false AS TooWide
        FROM (SELECT *, 1995 + 4 * ((year(day) - 1995) // 4) AS y FROM sg_all)"""),
    "oa_silver": _with(_BASE, _silver(), select="SELECT * FROM oa_silver"),
    "nn_silver": _with(_BASE, _silver(), select="SELECT * FROM nn_silver"),
    "sg_silver": _with(_BASE, _silver(), select="SELECT * FROM sg_silver"),
    "drop_all_null": _with(_BASE, select="""SELECT * FROM sg_raw
        WHERE NOT ("Station Name" IS NULL AND Cap IS NULL AND Nom IS NULL AND Cap2 IS NULL)"""),
    "conform_fact": """SELECT CAST(NULL AS BIGINT) AS GasMonth, CAST(l_shipdate AS DATE) AS GasDay, 'OA' AS Dataset,
               CAST(l_suppkey AS VARCHAR) AS GFLocID, CAST(NULL AS VARCHAR) AS LocName,
               CAST(NULL AS DOUBLE) AS DesignCapacity, l_quantity AS OperatingCapacity,
               CAST(NULL AS DOUBLE) AS TotalScheduledQuantity, CAST(NULL AS DOUBLE) AS OperationallyAvailableCapacity,
               CAST(NULL AS VARCHAR) AS IT, CAST(NULL AS VARCHAR) AS FlowDirection,
               CAST(NULL AS TIMESTAMP) AS Timestamp FROM lineitem""",
    "sg_directions": _with(_BASE, _silver(), _DIRECTIONS, select="SELECT * FROM directed"),
    "oa_gold": _with(_BASE, _silver(), _gold(), select="SELECT * FROM oa_gold"),
    "nn_gold": _with(_BASE, _silver(), _gold(), select="SELECT * FROM nn_gold"),
    "sg_gold": _with(_BASE, _silver(), _gold(), select="SELECT * FROM sg_gold"),
    "gold_merge": _with(_BASE, _silver(), _gold(), select=f"""
        SELECT DISTINCT {_STAMPED} FROM (SELECT * FROM oa_gold UNION ALL SELECT * FROM nn_gold
                                         UNION ALL SELECT * FROM sg_gold)"""),
    # The test cycles are Timely and Evening, so the later one is the smaller text.
    "latest_cycle": _with(_BASE, _silver(), """
oa_last AS (
  SELECT * FROM oa_silver QUALIFY Cycle_Desc = min(Cycle_Desc) OVER (
    PARTITION BY GFLocID, CAST(TRY_STRPTIME(Eff_Gas_Day, '%m-%d-%Y') AS DATE), IT,
      CASE trim(Flow_Ind_Desc) WHEN 'Delivery' THEN 'D' WHEN 'Receipt' THEN 'R'
           WHEN 'Storage Injection' THEN 'D' WHEN 'Storage Withdrawal' THEN 'R' ELSE 'Z' END)
),
sg_last AS (
  SELECT * FROM sg_silver QUALIFY CycleDesc = min(CycleDesc) OVER (PARTITION BY GFPipeID, "Station Name", EffGasDate)
)""", _gold().replace("oa_silver", "oa_last").replace("sg_silver", "sg_last"),
        select="SELECT * FROM oa_gold UNION ALL SELECT * FROM sg_gold"),
    "rejects": _with(_BASE, _silver(), select="""
        SELECT 'OA' AS Dataset, PipeCode AS Pipe, Loc AS Location, 'unknown pipe' AS Reason, true AS Dropped
          FROM oa_raw WHERE PipeCode = 'ZZ'
        UNION ALL SELECT 'OA', PipeName, GFLocID, 'no gas day', true FROM oa_silver
          WHERE Eff_Gas_Day IS NULL OR Eff_Gas_Day = 'not posted'
        UNION ALL SELECT 'OA', PipeName, GFLocID, 'Operationally_Available_Capacity is not a quantity', false
          FROM oa_silver WHERE Operationally_Available_Capacity = 'n/q'
        UNION ALL SELECT 'SG', PipeCode, "Station Name", 'unknown pipe', true FROM sg_raw WHERE PipeCode = 'ZZ'
        UNION ALL SELECT 'SG', GFPipeID, "Station Name", 'no figures and no name', true FROM sg_silver
          WHERE "Station Name" IS NULL AND Cap IS NULL AND Nom IS NULL AND Cap2 IS NULL
        UNION ALL SELECT 'SG', GFPipeID, "Station Name", 'no station name', true FROM sg_silver
          WHERE "Station Name" IS NULL AND (Cap IS NOT NULL OR Nom IS NOT NULL OR Cap2 IS NOT NULL)
        UNION ALL SELECT 'SG', GFPipeID, "Station Name", 'no nomination', true FROM sg_silver
          WHERE Nom IS NULL AND ("Station Name" IS NOT NULL OR Cap IS NOT NULL OR Cap2 IS NOT NULL)
        UNION ALL SELECT 'SG', GFPipeID, "Station Name", 'station without location', true FROM sg_silver s
          WHERE "Station Name" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM locations k
            WHERE k.GFPipeID = s.GFPipeID AND k.LocName = s."Station Name")"""),
    "meta_enrichment": _with(_BASE, _META, select="SELECT * FROM enriched"),
    "meta_changes": _with(_BASE, select="""
        SELECT *, '20260115' || PartitionKey || PipeCode || Loc AS RowKey, '20260115' AS ChangedOn FROM (
          SELECT Loc, trim("Loc Name") AS LocName, "Loc St Abbrev" AS LocStAbbrev,
                 coalesce(trim("Loc Cnty"), '') AS LocCnty, "Loc Zone" AS LocZone, trim("Dir Flo") AS DirFlo,
                 "Loc Type Ind" AS LocTypeInd, PipeCode, 'AFRICA' AS PartitionKey FROM meta_raw
          EXCEPT
          SELECT CAST(s_suppkey AS VARCHAR), s_name, 'S' || n_regionkey,
                 CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE 'C' || (s_suppkey % 11) END,
                 CASE WHEN s_suppkey % 9 = 0 THEN 'Z9' ELSE 'Z' || (s_suppkey % 5) END, 'D',
                 'T' || (s_suppkey % 3), 'P' || s_nationkey, 'AFRICA'
          FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 <> 3)"""),
    "new_point_locations": _with(_BASE, _silver(), _META, _NEW_POINTS,
                                 select="SELECT * EXCLUDE (Dataset) FROM new_points"),
    "new_segment_locations": _with(_BASE, _silver(), _NEW_STATIONS, select="SELECT * FROM new_stations"),
    "upsert_locations": _with(_BASE, _silver(), _NEW_STATIONS, select="""
        SELECT GFLocID AS RowKey, 'AFRICA' AS PartitionKey, GFPipeID, GFLocID, LocID, Loc,
               CASE WHEN Loc = '' THEN LocName || '*' ELSE LocName END AS LocName,
               CASE WHEN Loc = '' THEN 'Z1' ELSE '' END AS LocZone, '' AS PipeName, '' AS UpdatedTime
        FROM locations
        UNION ALL
        SELECT GFLocID, 'AFRICA', GFPipeID, GFLocID, LocID, Loc, LocName, LocZone, PipeName,
               '2026-01-15 06:30:00' FROM new_stations"""),
    "replace_slices": _with(*_run_gold(), _gold(), select=f"""
        SELECT {_STAMPED} FROM (
          SELECT DISTINCT * FROM (SELECT * FROM oa_gold UNION ALL SELECT * FROM nn_gold)
          WHERE NOT (Dataset = 'OA' AND GasMonth % 2 = 0
                     AND GasDay IN (SELECT GasDay FROM oa_gold WHERE IT = 'F'))
          UNION ALL
          SELECT DISTINCT * REPLACE (OperatingCapacity + 1 AS OperatingCapacity) FROM oa_gold
          WHERE GasMonth % 2 = 0 AND IT = 'F')"""),
    "cluster_months": _with(*_run_gold(), _gold(), select=f"""
        SELECT DISTINCT {_STAMPED} FROM (SELECT * FROM oa_gold UNION ALL SELECT * FROM nn_gold)"""),
    "silver_roundtrip": _with(_BASE, _silver(), select="""
        SELECT *, '20260115063000' AS run, '20260115' AS target FROM sg_silver"""),
    "bronze_layout": _with(_BASE, _POSTED, select="""
        SELECT Dataset, period, folder || '/' || period || '/' || PostingFile AS location, count(*) AS row_count
        FROM (SELECT *, CASE Dataset WHEN 'NN' THEN substring(ym, 1, 4) ELSE ym END AS period,
                     CASE Dataset WHEN 'OA' THEN 'PointCapacity' WHEN 'SG' THEN 'SegmentCapacity'
                                  ELSE 'NoNotice' END AS folder FROM named)
        GROUP BY 1, 2, 3
        UNION ALL
        SELECT 'META', 'unknown', 'Metadata/' || PipeCode || '_AllPoints.csv', count(*) FROM meta_raw GROUP BY 1, 2, 3"""),
    "audit_raw_counts": _with(_BASE, _POSTED, _RAW_COUNTS, select="SELECT * FROM raw_counts"),
    "audit_raw_files": _with(_BASE, _POSTED, select="""
        SELECT Dataset, PipeCode, PostingFile, count(*) AS records FROM named GROUP BY 1, 2, 3"""),
    "audit_silver_counts": _with(_BASE, _silver(), _SILVER_COUNTS, select="SELECT * FROM silver_counts"),
    "audit_new_locations": _with(_BASE, _silver(), _META, _NEW_POINTS, _NEW_STATIONS, _NEW_COUNTS,
                                 select="SELECT * FROM new_counts"),
    "audit_dataset_detail": _with(
        _BASE, _silver(), _META, _NEW_POINTS, _NEW_STATIONS, _NEW_COUNTS, _SILVER_COUNTS, _POSTED, _RAW_COUNTS,
        select="""
        SELECT dataset_type, pipe_code, raw_records, raw_files,
               CASE WHEN n = 1 THEN silver_records ELSE 0 END AS silver_records,
               CASE WHEN n = 1 THEN new_locations ELSE 0 END AS new_locations
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset_type ORDER BY pipe_code) AS n FROM raw_counts)
        JOIN silver_counts USING (dataset_type) JOIN new_counts USING (dataset_type)"""),
    "audit_run_summary": _with(_RESULTS, """
        runs AS (SELECT 'run' || CAST(user_id % 8 AS VARCHAR) AS pipeline, min(ts) AS s, max(ts) AS e FROM events GROUP BY 1),
        per_run AS (
          SELECT u.pipeline, count(r.pipeline) AS total, count(*) FILTER (WHERE r.success) AS succeeded,
                 CASE WHEN u.pipeline = 'run3' THEN 0 ELSE epoch_us(any_value(u.e)) - epoch_us(any_value(u.s)) END AS us
          FROM runs u LEFT JOIN results r ON r.pipeline = u.pipeline GROUP BY u.pipeline)""", select="""
        SELECT pipeline, GROUPING(pipeline) = 1 AS is_total, CAST(sum(total) AS BIGINT) AS total, CAST(sum(succeeded) AS BIGINT) AS succeeded,
               CAST(sum(total) - sum(succeeded) AS BIGINT) AS failed,
               CAST(CAST(sum(us) AS DECIMAL(28,6)) / 1000000 AS DOUBLE) AS duration_s,
               coalesce(sum(succeeded) * 100.0::DOUBLE / nullif(sum(total), 0), 0.0) AS success_rate
        FROM per_run GROUP BY ROLLUP (pipeline)"""),
    "audit_failures": _with(_RESULTS, select="""
        SELECT pipe_code, dataset_type, CAST(date AS DATE) AS date, duration_s, coalesce(error, 'Unknown') AS error
        FROM results WHERE NOT success"""),
    "pipe_changes": """
        SELECT CASE WHEN k.code IS NULL THEN 'new' WHEN v.code IS NULL THEN 'removed' ELSE 'renamed' END AS change_type,
               coalesce(v.code, k.code) AS pipe_code, v.name AS live_name, k.name AS config_name
        FROM (SELECT 'C' || c_custkey AS code, CASE WHEN c_custkey % 7 = 0 THEN 'New ' ELSE '' END || c_name AS name
              FROM customer WHERE c_custkey % 5 <> 0) v
        FULL JOIN (SELECT 'C' || c_custkey AS code, c_name AS name FROM customer WHERE c_custkey % 3 <> 0) k
          ON k.code = v.code
        WHERE k.code IS NULL OR v.code IS NULL OR v.name <> k.name""",
    "missing_downloads": _with(_BASE, _POSTED, select="""
        SELECT pipe_code, dataset_type FROM (
          SELECT 'P' || n_nationkey AS pipe_code, 'OA' AS dataset_type FROM nation
          UNION ALL SELECT 'P' || n_nationkey, 'SG' FROM nation WHERE n_nationkey % 2 = 0
          UNION ALL SELECT 'P' || n_nationkey, 'NN' FROM nation WHERE n_nationkey % 3 = 0
          UNION ALL SELECT 'P' || n_nationkey, 'META' FROM nation WHERE n_nationkey % 5 = 0)
        EXCEPT SELECT PipeCode, Dataset FROM posted"""),
    "late_deliveries": _with(_RESULTS, select="""
        , units AS (
          SELECT pipe_code, dataset_type, CAST(date AS DATE) AS gas_day,
                 CAST(CAST(date AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS deadline,
                 min(date_trunc('millisecond', date)) FILTER (WHERE success) AS came
          FROM results GROUP BY 1, 2, 3, 4)
        SELECT pipe_code, dataset_type, gas_day, 'late' AS state, deadline AS at FROM units
        WHERE came IS NULL OR came > deadline
        UNION ALL SELECT pipe_code, dataset_type, gas_day, 'came', came FROM units WHERE came > deadline"""),
    "failed_worklist": _with(_RESULTS, select="""
        SELECT DISTINCT pipe_code AS pipecode,
               unnest(CASE WHEN duration_s > 100 THEN ['OA', 'SG', 'NN'] ELSE ['SG'] END) AS type,
               CAST(date AS DATE) AS scrape_date
        FROM results WHERE NOT success"""),
    "merge_slices": _with(*_run_gold(), _gold(), select=f"""
        SELECT {_STAMPED} FROM (
          SELECT DISTINCT * FROM (SELECT * FROM oa_gold UNION ALL SELECT * FROM nn_gold)
          WHERE NOT (Dataset = 'OA' AND GasMonth % 2 = 0)
          UNION ALL
          SELECT DISTINCT * REPLACE (OperatingCapacity + 1 AS OperatingCapacity) FROM oa_gold
          WHERE GasMonth % 2 = 0 AND IT = 'F')"""),
    "run_daily": "SELECT * REPLACE (TIMESTAMP '1998-03-15 06:30:00' AS Timestamp) FROM (" + _run("""
        WHERE (Dataset <> 'NN' AND GasDay IN (DATE '1998-03-14', DATE '1998-03-15'))
           OR (Dataset = 'NN' AND GasDay = DATE '1998-03-11')""") + ")",
    "repost": _REPOST,
    "repost_moved": _MOVED,
    "stream_repost": _REPOST,
    "replay_failed": _run("WHERE GasDay IN (DATE '1995-01-01', DATE '1999-01-01') AND Dataset <> 'NN'"),
    "run_range": _run(""),
    "run_day": _run("WHERE GasDay = DATE '1999-01-01'"),
    "stream_ingest": _run(""),
}


def _shown(report: str, query: str, columns: list[str]) -> str:
    values = [f"CAST({columns[k]} AS VARCHAR)" if k < len(columns) else "NULL" for k in range(4)]
    listed = ", ".join(f"{value} AS value{k + 1}" for k, value in enumerate(values))
    return f"SELECT '{report}' AS report, {listed} FROM ({query})"


ORACLES["reports"] = " UNION ALL ".join([
    _shown("summary", ORACLES["audit_run_summary"], ["pipeline", "is_total", "total", "succeeded"]),
    _shown("failures", ORACLES["audit_failures"], ["pipe_code", "dataset_type", "date", "error"]),
    _shown("details", ORACLES["audit_dataset_detail"], ["dataset_type", "pipe_code", "raw_records", "silver_records"]),
    _shown("missing", ORACLES["missing_downloads"], ["pipe_code", "dataset_type"]),
    _shown("changes", ORACLES["pipe_changes"], ["change_type", "pipe_code", "live_name", "config_name"]),
])
