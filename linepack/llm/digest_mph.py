"""Exact dedup against a history held in minimal perfect hash tables.

The distinct digests of the history are dealt to shards by their leading bits.
Each shard gets a minimal perfect hash: levels of bit arrays in which a digest
that is alone at its place settles, the others go on to the next level. The
number of settled bits before its own is a digest's slot, and the slot holds the
whole digest, the winner's id and the number of copies. A look-up compares all 32
bytes, so a digest outside the history never passes for a member.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, SPACES, keep_keys, materialise, named, text_rows

#: Distinct digests of the history in a shard, about.
SHARD_DIGESTS = 2048
INDEX = "shard long, levels array<long>, settled binary, digests binary, winners array<long>, copies array<long>"
LOOKED_UP = "digest binary, keep_id long, copies long"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one blank."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ").cast("binary"), 256))


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The place of each digest among ``size`` at a level."""
    x = words[:, level % 4] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    x ^= words[:, (level + 1) % 4] >> np.uint64(3)
    return (x % np.uint64(size)).astype(np.int64)


def build_table(digests: list[bytes]) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, settled bits and the slot of each of the distinct digests."""
    words = _words(b"".join(digests))
    left, levels, bits = np.arange(len(digests)), [], []
    slots, base = np.zeros(len(digests), np.int64), 0
    while left.size:
        size = 2 * left.size + 1
        place = _place(words[left], len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        settled = alone[place]
        slots[left[settled]] = base + np.cumsum(alone)[place[settled]] - 1
        base += int(alone.sum())
        levels.append(size)
        bits.append(alone)
        left = left[~settled]
    return levels, np.packbits(np.concatenate(bits)).tobytes() if bits else b"", slots


def find_slots(digests: list[bytes], levels: list[int], settled: bytes, held: bytes) -> np.ndarray:
    """The slot of each digest, -1 for those whose bytes are not held in their slot."""
    words, held_words = _words(b"".join(digests)), _words(held)
    bits = np.unpackbits(np.frombuffer(settled, np.uint8), count=sum(levels)).astype(bool)
    rank = np.cumsum(bits) - 1
    slot, left, start = np.full(len(digests), -1), np.arange(len(digests)), 0
    for level, size in enumerate(levels):
        at = start + _place(words[left], level, size)
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    found = np.flatnonzero(slot >= 0)
    same = (held_words[slot[found]] == words[found]).all(axis=1)
    slot[found[~same]] = -1
    return slot


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    levels, settled, slots = build_table(rows["digest"].tolist())
    at_slot = rows.iloc[np.argsort(slots)]
    return pd.DataFrame({
        "shard": [key[0]], "levels": [levels], "settled": [settled], "digests": [b"".join(at_slot["digest"])],
        "winners": [at_slot["keep_id"].tolist()], "copies": [at_slot["copies"].tolist()],
    })


def _look_up_shard(rows: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Members take the winner of their slot, the others keep their own."""
    own = rows["keep_id"].astype("Int64").copy()
    if len(index) and len(rows):
        table = index.iloc[0]
        slot = find_slots(rows["digest"].tolist(), list(table["levels"]), table["settled"], table["digests"])
        winners = np.asarray(table["winners"])
        own[slot >= 0] = winners[slot[slot >= 0]]
    return pd.DataFrame({"digest": rows["digest"], "keep_id": own, "copies": rows["copies"]})


def _shard(bits: int) -> Column:
    head = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long")
    return F.shiftright(head, 48 - bits)


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))


def build_index(history: DataFrame, bits: int) -> DataFrame:
    """One row for each shard of the distinct digests of ``history`` (doc_id, digest)."""
    return _groups(history).withColumn("shard", _shard(bits)).groupBy("shard").applyInPandas(_build_shard, INDEX)


def resolve(rows: DataFrame, index: DataFrame, bits: int) -> DataFrame:
    """digest, keep_id, copies of the distinct digests of ``rows``: members with the history's winner."""
    mine = _groups(rows).withColumn("shard", _shard(bits))
    return mine.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        lambda r, i: _look_up_shard(r, i), LOOKED_UP
    )


def exact_groups(docs: DataFrame, history_before: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row, and (digest, keep_id, copies) of every distinct text.

    Rows with an id below ``history_before`` (the middle of the ids if not given)
    are the history that the index is built on; all others are looked up in it and
    those it does not hold are grouped by themselves. As the history has the
    smaller ids, its winner is the smallest id of a text.

    Null texts count as empty. A row without id never wins over one with an id. An
    empty table gives empty results. Both results are written to the shared folder.
    """
    rows = materialise(text_rows(docs, id_col, text_col).select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    seen = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    bits = max(0, (seen[0] // (2 * SHARD_DIGESTS)).bit_length())
    if history_before is None:
        history_before = 0 if seen[1] is None else (seen[1] + seen[2]) // 2 + 1
    old = rows.where(F.col("doc_id") < history_before)
    new = rows.where(F.col("doc_id").isNull() | (F.col("doc_id") >= history_before))
    index = materialise(build_index(old, bits), "digest-index")
    found = _groups(old).unionByName(resolve(new, index, bits))
    groups = found.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("copies").alias("copies"))
    return rows, materialise(groups, "digest-groups")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; see ``exact_groups``.

    Rows that share the winner's id and text are the same document: all are marked
    as kept. Without any id in a group, keep_id is null and its rows are kept.
    """
    rows, groups = exact_groups(docs, id_col=id_col, text_col=text_col)
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their columns, one for each text: the one with the smallest id."""
    _, groups = exact_groups(docs, id_col=id_col, text_col=text_col)
    keys = groups.select("digest", F.coalesce("keep_id", F.lit(NO_ID)).alias("keep_id"))
    own_id = F.coalesce(named(id_col).cast("long"), F.lit(NO_ID))
    return keep_keys(docs, keys, {"digest": text_digest(named(text_col)), "keep_id": own_id})
