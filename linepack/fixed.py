"""Names, codes and formats that posted files and tables carry."""

from __future__ import annotations

# Datasets -----------------------------------------------------
OA = "OA"  # operational (point) capacity
SG = "SG"  # segment capacity
ST = "ST"  # storage capacity, a name only
NN = "NN"  # no-notice activity
META = "META"  # location attributes
DATASETS = [OA, SG, ST, NN, META]
FACT_DATASETS = [OA, SG, NN]

# Formats of posted text ---------------------------------------
OA_DAY_FORMAT = "M-d-yyyy"
NN_TIME_FORMAT = "M/d/yyyy H:mm"
FAIL_DAY_FORMAT = "yyyy/MM/dd"
NN_LAG_DAYS = 4
SEGMENT_HEAD = r"^\s*Gas Date: (.*?)  Cycle: (.*)$"

# Code tables --------------------------------------------------
OA_FLOW = {
    "Delivery": "D",
    "Receipt": "R",
    "Storage Injection": "D",
    "Storage Withdrawal": "R",
}
OA_FLOW_DEFAULT = "Z"
SG_FLOW = {"TD1": "F", "TD2": "B"}
SG_FLOW_DEFAULT = "N"
NN_FLOW = {
    "D": "D",
    "R": "R",
    "B": "N",
    "Delivery": "D",
    "Receipt": "R",
    "Storage Injection": "D",
    "Storage Withdrawal": "R",
}

# Cycles of a gas day, earliest first; short forms write ID for Intraday ---
CYCLES = ["Timely", "Evening", "Intraday 1", "Intraday 2", "Intraday 3", "Final"]

# Texts that mean "no value" in posted text columns ------------
NULL_MARKS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Characters that count as white space (the Unicode property) ----
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Landing folders and how much of yyyyMMdd names the period ----
BRONZE_FOLDER = {
    OA: "PointCapacity",
    SG: "SegmentCapacity",
    NN: "NoNotice",
    META: "Metadata",
}
BRONZE_PERIOD_DIGITS = {OA: 6, SG: 6, NN: 4}

# Widths of ids ------------------------------------------------
PIPE_ID_WIDTH = 3
LOC_ID_WIDTH = 7
GF_NUMBER_WIDTH = 5
GF_PREFIX = "GF"

# Columns ------------------------------------------------------
OA_RAW = [
    "Cycle_Desc", "Post_Date", "Eff_Gas_Day", "Cap_Type_Desc", "Post_Time",
    "Eff_Time", "Loc", "Loc_Name", "Loc_Zn", "Flow_Ind_Desc", "Loc_Purp_Desc",
    "Loc_QTI_Desc", "Meas_Basis_Desc", "IT", "All_Qty_Avail",
    "Total_Design_Capacity", "Operating_Capacity", "Total_Scheduled_Quantity",
    "Operationally_Available_Capacity", "TSP_Name", "TSP",
]
NN_RAW = [
    "Effective_From_DateTime", "Loc_Prop", "Loc_Name", "Allocated_Qty",
    "Direction_Of_Flow", "Accounting_Physincal_Indicator",
]
SG_RAW = ["Station Name", "Cap", "Nom", "Cap2"]
META_RAW = [
    "Loc", "Loc Name", "Loc St Abbrev", "Loc Cnty", "Loc Zone", "Dir Flo",
    "Loc Type Ind",
]
META_RENAME = {
    "Loc St Abbrev": "State",
    "Loc Cnty": "County",
    "Loc Zone": "LocZone",
    "Loc Type Ind": "ReportedFacilityType",
}
LOCATION_COLUMNS = [
    "GFPipeID", "PipeName", "GFLocID", "GF_LocID_Tag", "LocID", "Loc",
    "GF_LocName", "LocName", "GF_FacilityType", "GF_FacilityTypeGroup",
    "ReportedFacilityType", "LocSegment", "LocZone", "State", "County",
    "InterconnectingEntity", "UpdatedTime",
]
SLICE = ["GasMonth", "Dataset", "GasDay"]

# Recency and back-fill windows, in days -----------------------
CLUSTER_RECENT_DAYS = 30
HISTORIC_LAG_DAYS = 45
HISTORIC_SPAN_DAYS = 365
