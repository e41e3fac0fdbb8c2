"""Explicit schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

from . import fixed


def texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


FACT = T.StructType([
    T.StructField("GasMonth", T.LongType()),
    T.StructField("GasDay", T.DateType()),
    T.StructField("Dataset", T.StringType()),
    T.StructField("GFLocID", T.StringType()),
    T.StructField("LocName", T.StringType()),
    T.StructField("DesignCapacity", T.DoubleType()),
    T.StructField("OperatingCapacity", T.DoubleType()),
    T.StructField("TotalScheduledQuantity", T.DoubleType()),
    T.StructField("OperationallyAvailableCapacity", T.DoubleType()),
    T.StructField("IT", T.StringType()),
    T.StructField("FlowDirection", T.StringType()),
    T.StructField("Timestamp", T.TimestampNTZType()),
])

PIPES = texts(["ParentPipe", "PipeName", "GFPipeID", "PipeCode"])

LOCATIONS = texts(fixed.LOCATION_COLUMNS)
STORED_LOCATIONS = texts([*fixed.LOCATION_COLUMNS, "PartitionKey", "RowKey"])

OA_SILVER = texts([*fixed.OA_RAW, "PipeName", "GFLocID"])
NN_SILVER = texts([*fixed.NN_RAW, "PipeName", "GFLocID"])
SG_SILVER = T.StructType([
    T.StructField("Station Name", T.StringType()),
    T.StructField("Cap", T.DoubleType()),
    T.StructField("Nom", T.DoubleType()),
    T.StructField("Cap2", T.DoubleType()),
    T.StructField("EffGasDate", T.DateType()),
    T.StructField("CycleDesc", T.StringType()),
    T.StructField("GFPipeID", T.StringType()),
])
SILVER = {fixed.OA: OA_SILVER, fixed.NN: NN_SILVER, fixed.SG: SG_SILVER}

_LANDED = [
    T.StructField("PipeCode", T.StringType()),
    T.StructField("PostingFile", T.StringType()),
    T.StructField("TooWide", T.BooleanType()),
    T.StructField("GasDay", T.DateType()),
]
BRONZE = {
    fixed.OA: T.StructType(texts(fixed.OA_RAW).fields + _LANDED),
    fixed.NN: T.StructType(texts(fixed.NN_RAW).fields + _LANDED),
    fixed.SG: T.StructType([
        *texts(fixed.SG_RAW).fields,
        T.StructField("EffGasDate", T.DateType()),
        T.StructField("CycleDesc", T.StringType()),
        *_LANDED,
    ]),
}

FAILURE_LOG = texts(["pipecode", "type", "scrape_date"])

REJECTS = T.StructType([
    T.StructField("Dataset", T.StringType()),
    T.StructField("Pipe", T.StringType()),
    T.StructField("Location", T.StringType()),
    T.StructField("Reason", T.StringType()),
    T.StructField("Dropped", T.BooleanType()),
])

SCRAPE_RESULT = T.StructType([
    T.StructField("pipe_code", T.StringType()),
    T.StructField("dataset_type", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

AVAILABILITY = T.StructType([
    T.StructField("pipe", T.StructType([
        T.StructField("label", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
    ])),
    T.StructField("has_OA", T.BooleanType()),
    T.StructField("has_SG", T.BooleanType()),
    T.StructField("has_NN", T.BooleanType()),
    T.StructField("has_MetaData", T.BooleanType()),
])
