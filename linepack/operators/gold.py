"""Silver to gold: three differently shaped datasets as one fact table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import (
    gas_month,
    nn_day,
    nn_flow,
    oa_day,
    oa_flow,
    quantity,
    sg_direction,
    sg_flow,
    strip,
)
from ..schemas import FACT
from .shape import conform, drop_all_null, union_by_name

OA_QUANTITIES = {
    "DesignCapacity": "Total_Design_Capacity",
    "OperatingCapacity": "Operating_Capacity",
    "TotalScheduledQuantity": "Total_Scheduled_Quantity",
    "OperationallyAvailableCapacity": "Operationally_Available_Capacity",
}
NN_QUANTITIES = {"TotalScheduledQuantity": "Allocated_Qty"}
GAS_DAY = {
    fixed.OA: lambda: oa_day(F.col("Eff_Gas_Day")),
    fixed.NN: lambda: nn_day(F.col("Effective_From_DateTime")),
    fixed.SG: lambda: F.col("EffGasDate").cast("date"),
}


def with_gas_day(df: DataFrame, dataset: str) -> DataFrame:
    return df.withColumn("GasDay", GAS_DAY[dataset]())


def _dated(df: DataFrame, strict: bool) -> DataFrame:
    """Rows with a gas day, and their month; ``strict`` fails on the first without."""
    known: Column = F.col("GasDay").isNotNull()
    if strict:
        known = F.when(known, True).otherwise(
            F.raise_error(F.lit("unreadable gas day")).cast("boolean")
        )
    return df.where(known).withColumn("GasMonth", gas_month(F.col("GasDay")))


def gold_oa(silver: DataFrame, strict: bool = False) -> DataFrame:
    return conform(
        _dated(with_gas_day(silver, fixed.OA), strict).withColumns({
            "Dataset": F.lit(fixed.OA),
            "LocName": strip(F.col("Loc_Name")),
            "FlowDirection": oa_flow(F.col("Flow_Ind_Desc")),
            **{gold: quantity(F.col(posted)) for gold, posted in OA_QUANTITIES.items()},
        }),
        FACT,
    )


def gold_nn(silver: DataFrame, strict: bool = False) -> DataFrame:
    return conform(
        _dated(with_gas_day(silver, fixed.NN), strict).withColumns({
            "Dataset": F.lit(fixed.NN),
            "LocName": strip(F.col("Loc_Name")),
            "FlowDirection": nn_flow(F.col("Direction_Of_Flow")),
            **{gold: quantity(F.col(posted)) for gold, posted in NN_QUANTITIES.items()},
        }),
        FACT,
    )


def sg_directions(df: DataFrame) -> DataFrame:
    """One or two directed rows per segment row, as ``OpCap``, ``Nom``, ``FlowInd``.

    Without a second capacity the sign of the nomination names the direction.
    With one there is a row for each direction, and the nomination belongs to
    the one its sign points to; the other gets 0. Both figures come out without
    sign. A row without a nomination has no direction and gives no row. The
    input is read once: the rows are built as an array and inlined.
    """
    cap, nom, cap2 = F.col("Cap"), F.col("Nom"), F.col("Cap2")

    def directed(capacity: Column, nomination: Column, direction: Column) -> Column:
        return F.struct(
            F.abs(capacity).alias("OpCap"),
            F.abs(nomination).alias("Nom"),
            direction.alias("FlowInd"),
        )

    zero = F.lit(0.0)
    single = F.array(directed(cap, nom, sg_direction(nom)))
    double = F.array(
        directed(cap, F.when(nom < 0, zero).otherwise(nom), F.lit("TD1")),
        directed(cap2, F.when(nom < 0, nom).otherwise(zero), F.lit("TD2")),
    )
    kept = [F.col(f"`{name}`") for name in df.columns if name not in ("Cap", "Nom", "Cap2")]
    return df.where(nom.isNotNull()).select(
        *kept, F.inline(F.when(cap2.isNull(), single).otherwise(double))
    )


def gold_sg(silver: DataFrame, locations: DataFrame, strict: bool = False) -> DataFrame:
    """Segment rows of known stations; the join comes before the rows are doubled."""
    named = (
        drop_all_null(silver, fixed.SG_RAW)
        .withColumnRenamed("Station Name", "LocName")
        .join(locations.select("LocName", "GFPipeID", "GFLocID"), ["LocName", "GFPipeID"], "inner")
    )
    return conform(
        _dated(with_gas_day(sg_directions(named), fixed.SG), strict).withColumns({
            "Dataset": F.lit(fixed.SG),
            "FlowDirection": sg_flow(F.col("FlowInd")),
            "OperatingCapacity": F.col("OpCap"),
            "TotalScheduledQuantity": F.col("Nom"),
            "OperationallyAvailableCapacity": F.col("OpCap") - F.col("Nom"),
        }),
        FACT,
    )


def merge_gold(*facts: DataFrame, run_ts: datetime) -> DataFrame:
    """All datasets together, equal rows once, then stamped with the run's time."""
    return union_by_name(*facts).distinct().withColumn(
        "Timestamp", F.lit(run_ts).cast("timestamp_ntz")
    )
