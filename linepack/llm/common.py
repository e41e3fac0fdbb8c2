"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepack.shared import materialise, new_folder

__all__ = ["materialise", "new_folder", "free_name", "named", "ship", "text_rows", "keep_keys", "slices", "sub_batches"]

_shipped: set[str] = set()

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Stands for a missing id where keys must not be null.
NO_ID = -(2**63)

#: Words and their separators: the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def free_name(df: DataFrame, base: str) -> str:
    """``base``, made longer until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def named(column: str) -> Column:
    """The column of exactly that name, dots and spaces in it included."""
    return F.col("`" + column.replace("`", "``") + "`")


def ship(spark: SparkSession) -> None:
    """Send the package to Python workers, once for each application, unless their path has it."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # Spark serves the archive from the driver to every executor.
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='linepack-code-')}/linepack", "zip", root, "linepack")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, as ``doc_id`` and ``text``; a null text counts as empty."""
    ship(docs.sparkSession)
    return docs.select(
        named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text")
    )


def keep_keys(docs: DataFrame, keys: DataFrame, made: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose ``made`` values are a row of ``keys``, one for each key.

    ``made`` maps each column of ``keys`` to its expression over ``docs``; neither side
    may be null. Of rows with the same values (repeated rows) one stays; they meet in
    the same partitions as the join.
    """
    own = {k: free_name(docs, f"key_{k}") for k in made}
    left = docs.withColumns({own[k]: e for k, e in made.items()})
    right = keys.select([named(k).alias(own[k]) for k in made])
    return left.join(right, list(own.values()), "left_semi").dropDuplicates(list(own.values())).select(
        [named(c) for c in docs.columns]
    )


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to ``most`` or that hold one item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def sub_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces whose texts take ``most`` bytes or are one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for start, end in slices(sizes, most):
            yield batch.slice(start, end - start)
