"""Raw postings to silver: key every row to a pipe and a location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import gf_loc_id, number, signed, strip

LOCATION_COLUMN = {fixed.OA: "Loc", fixed.NN: "Loc_Prop"}
_LANDING_COLUMNS = ["PipeCode", "PostingFile", "TooWide"]


def pipes_of(pipes: DataFrame, parent: str | None = None) -> DataFrame:
    """Ids, codes and names of the pipes of one parent, or of all."""
    chosen = pipes if parent is None else pipes.where(F.col("ParentPipe") == parent)
    return chosen.select("GFPipeID", "PipeCode", "PipeName")


def well_formed(raw: DataFrame) -> DataFrame:
    """Rows with as many fields as their header has names, where the source says so."""
    return raw.where(~F.coalesce("TooWide", F.lit(False))) if "TooWide" in raw.columns else raw


def point_silver(raw: DataFrame, pipes: DataFrame, loc_col: str, repeats: bool = False) -> DataFrame:
    """OA (``Loc``) or NN (``Loc_Prop``) rows with ``GFLocID`` and ``PipeName``.

    Rows of unknown pipes and rows whose location starts with a sign are left
    out; ``point_rejects`` lists them. The pipe table has three-digit ids, so
    Spark broadcasts it by its own size check; nothing is shuffled but the
    distinct, which combines equal rows before it does. With ``repeats`` equal rows
    stay, for a caller that makes what it derives from them distinct: each row then
    crosses the network once, not twice.
    """
    rows = (
        well_formed(raw)
        .where(~F.coalesce(signed(F.col(loc_col)), F.lit(False)))
        .join(pipes_of(pipes), "PipeCode", "inner")
        .withColumn(loc_col, strip(F.col(loc_col)))
        .withColumn("GFLocID", gf_loc_id(F.col("GFPipeID"), F.col(loc_col)))
        .drop("GFPipeID", *_LANDING_COLUMNS)
    )
    return rows if repeats else rows.distinct()


def measure(df: DataFrame, name: str) -> Column:
    """A segment measure as double, whether it was read as text or as a number."""
    column = F.col(f"`{name}`")
    return number(column) if df.schema[name].dataType.typeName() == "string" else column.cast("double")


def segment_silver(raw: DataFrame, pipes: DataFrame, repeats: bool = False) -> DataFrame:
    """SG rows with ``GFPipeID`` in place of the pipe's code; ``repeats`` as in ``point_silver``."""
    rows = (
        well_formed(raw)
        .join(pipes_of(pipes), "PipeCode", "inner")
        .withColumns({name: measure(raw, name) for name in ["Cap", "Nom", "Cap2"]})
        .drop("PipeName", *_LANDING_COLUMNS)
    )
    return rows if repeats else rows.distinct()
