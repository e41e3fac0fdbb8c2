"""Code tables, each from Column to Column."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import strip


def mapped(code: Column, table: dict[str, str], default: str = "D") -> Column:
    """Look ``code`` up in ``table``; unknown and null codes give ``default``."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(pairs[code], F.lit(default))


def oa_flow(text: Column) -> Column:
    return mapped(strip(text), fixed.OA_FLOW, fixed.OA_FLOW_DEFAULT)


def _plain_cycle(name: Column) -> Column:
    """Letters and digits of a cycle's name in lower case, its short form."""
    return F.replace(F.regexp_replace(F.lower(name), "[^a-z0-9]", ""), F.lit("intraday"), F.lit("id"))


def cycle_rank(name: Column) -> Column:
    """Place of a cycle in its gas day from 1; 0 for null and for names that are not known."""
    order = F.array(*[_plain_cycle(F.lit(cycle)) for cycle in fixed.CYCLES])
    return F.coalesce(F.array_position(order, _plain_cycle(name)), F.lit(0))


def nn_flow(text: Column) -> Column:
    """Only B is translated; every other value is kept as posted."""
    code = strip(text)
    return F.when(code == "B", "N").otherwise(code)


def sg_flow(direction: Column) -> Column:
    return mapped(direction, fixed.SG_FLOW, fixed.SG_FLOW_DEFAULT)


def sg_direction(nomination: Column) -> Column:
    return F.when(nomination < 0, "TD2").otherwise("TD1")
