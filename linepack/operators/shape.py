"""Column-set operators: fit a DataFrame to a schema without touching its rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order; absent ones as typed nulls."""
    present = set(df.columns)
    return df.select([
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def with_missing_as_empty(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly ``names`` in this order; absent ones as empty text."""
    present = set(df.columns)
    return df.select([
        F.col(f"`{name}`") if name in present else F.lit("").alias(name) for name in names
    ])


def select_present(df: DataFrame, names: list[str]) -> DataFrame:
    present = set(df.columns)
    return df.select([F.col(f"`{name}`") for name in names if name in present])


def drop_all_null(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the rows in which every one of ``names`` is null."""
    return df.na.drop(how="all", subset=names)


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty text."""
    return df.select([
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)
        for name in df.columns
    ])


def alphanumeric_names(df: DataFrame) -> DataFrame:
    """Column names reduced to letters and digits."""
    return df.toDF(*[re.sub(r"[^a-zA-Z0-9]", "", name) for name in df.columns])


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
