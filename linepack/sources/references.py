"""Reference tables: pipes, locations, stored location attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pipe_id
from ..operators.validate import rejected, valid, validate_pipes

_TIMES = (T.TimestampType, T.TimestampNTZType)


def pipe_reference(entities: DataFrame, parent: str | None = None) -> DataFrame:
    """The four pipe columns, the id as three-digit text; one parent's pipes on request.

    Records that break a rule of ``validate_pipes`` are left out; ``pipe_rejects``
    lists them. An id of more than three digits would key rows to another pipe.
    """
    pipes = _pipe_columns(entities)
    good = valid(validate_pipes(pipes.withColumn("_code", F.col("PipeCode"))))
    pipes = good.withColumn("PipeCode", F.col("_code")).select(*pipes.columns)
    return pipes if parent is None else pipes.where(F.col("ParentPipe") == parent)


def _pipe_columns(entities: DataFrame) -> DataFrame:
    return entities.select(
        "ParentPipe", "PipeName", pipe_id(F.col("GFPipeID").cast("int")).alias("GFPipeID"), "PipeCode"
    )


def pipe_rejects(entities: DataFrame) -> DataFrame:
    """Pipe records that ``pipe_reference`` leaves out, with the rules they break."""
    return rejected(validate_pipes(_pipe_columns(entities)))


def loc_reference(entities: DataFrame) -> DataFrame:
    """Every column as text, times in ISO form, a pipe id as three-digit text."""

    def as_text(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if field.name == "GFPipeID":
            return pipe_id(column.cast("int")).alias(field.name)
        if isinstance(field.dataType, _TIMES):
            whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
            parts = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            exact = F.date_trunc("second", column) == column
            return F.when(exact, whole).otherwise(parts).alias(field.name)
        return column.cast("string").alias(field.name)

    return entities.select([as_text(field) for field in entities.schema.fields])


def stored_meta(snapshot: DataFrame) -> DataFrame:
    """The stored attributes without the columns each change brings anew."""
    return snapshot.drop("RowKey", "ChangedOn")
