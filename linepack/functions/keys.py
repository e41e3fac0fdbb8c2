"""Surrogate ids of pipes and locations, each from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import strip, zfill


def pipe_id(number: Column) -> Column:
    return zfill(number.cast("string"), fixed.PIPE_ID_WIDTH)


def loc_id(location: Column) -> Column:
    """A stripped location number in seven characters or more."""
    return zfill(location, fixed.LOC_ID_WIDTH)


def gf_loc_id(pipe: Column, location: Column) -> Column:
    """Pipe id and id of a stripped location side by side; null if either is missing."""
    return F.concat(pipe, loc_id(location))


def pipe_of_gf_loc_id(key: Column) -> Column:
    return F.substring(key, 1, fixed.PIPE_ID_WIDTH)


def gf_number(sequence: Column) -> Column:
    """``GF`` and the sequence number in five digits."""
    return F.concat(
        F.lit(fixed.GF_PREFIX), zfill(sequence.cast("string"), fixed.GF_NUMBER_WIDTH)
    )


def signed(location: Column) -> Column:
    """A location number with a sign in front cannot be a location number."""
    return F.substring(strip(location), 1, 1).isin("+", "-")
