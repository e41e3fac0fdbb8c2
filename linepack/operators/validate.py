"""Record checks: every row gets the list of rules it breaks, null if none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import pipe_id


def _with_reason(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    broken = [F.when(~F.coalesce(kept, F.lit(False)), F.lit(text)) for text, kept in rules]
    return df.withColumn("Reason", F.nullif(F.concat_ws("; ", *broken), F.lit("")))


def _length(name: str, least: int, most: int | None = None) -> Column:
    size = F.length(name)
    return size >= least if most is None else size.between(least, most)


def validate_pipes(pipes: DataFrame) -> DataFrame:
    """Pipe records with the code in upper case and ``Reason``."""
    return _with_reason(
        pipes.withColumn("PipeCode", F.upper("PipeCode")),
        [
            ("code length", _length("PipeCode", 2, 10)),
            ("parent length", _length("ParentPipe", 2, 50)),
            ("name length", _length("PipeName", 2)),
            ("id is not three digits", pipe_id(F.col("GFPipeID")).rlike(r"^\d{3}\z")),
        ],
    )


def validate_results(results: DataFrame) -> DataFrame:
    """Download results with ``Reason``."""
    return _with_reason(
        results,
        [
            ("code length", _length("pipe_code", 2, 10)),
            ("unknown dataset", F.col("dataset_type").isin(fixed.DATASETS)),
            ("negative duration", F.col("duration_s") >= 0),
            ("error on success",
             ~(F.col("success") & (F.coalesce("error", F.lit("")) != ""))),
        ],
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("Reason").isNull()).drop("Reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("Reason").isNotNull())
