"""A user's own per-value Python function as a column function."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def batch(fn: Callable[[Any], Any], returns: T.DataType | str) -> Callable[[Column], Column]:
    """Lift ``fn`` to columns, Arrow batch by Arrow batch; ``fn`` sees ``None`` for null.

    Every rule of this library is a native expression instead; this is for
    rules only the user can write.
    """

    def apply(values: pa.Array) -> pa.Array:
        # Arrow tells null from NaN, pandas does not.
        return pa.array([fn(value) for value in values.to_pylist()], kind)

    kind = to_arrow_type(T.DataType.fromDDL(returns) if isinstance(returns, str) else returns)
    apply.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, returns)
