"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within the radius have a common variant within half the radius of
both. All variants of a fingerprint are dealt to tasks by some of their bits: a
fingerprint goes to the buckets that half the radius can reach, with what is left
of it, and its variants in a bucket are made there. Fingerprints that share a
variant are links (half and half is the radius), so each variant needs only a star
over its owners, never all their pairs, and a bucket only a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_keys, materialise, named, sub_batches, text_rows
from .components import components

#: Variants of a bucket, about; and variants that a task holds at a time.
BUCKET_VARIANTS = 2_000_000
HELD_VARIANTS = 1_000_000
#: Shingles whose bits are counted at a time.
COUNTED = 65_536
SEED = 42
#: The order in which bits are used for dealing: spread over the fingerprint.
BIT_ORDER = [i * 37 % 64 for i in range(64)]


def fingerprint(text: str, width: int) -> int:
    """Majority bits of the XXH64 of all shingles of ``width`` words; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    tops = ends[-n:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, COUNTED):
        spans = zip(starts[at : min(n, at + COUNTED)].tolist(), tops[at : at + COUNTED].tolist(), strict=True)
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            fps = np.fromiter((fingerprint(t, width) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _masks(bits: Sequence[int], most: int) -> np.ndarray:
    """Every flip of up to ``most`` of ``bits``."""
    out = [0]
    for k in range(1, most + 1):
        out += [sum(1 << b for b in flipped) for flipped in combinations(bits, k)]
    return np.array(out, np.uint64)


def _route(bits: int, half: int):
    """Rows (bucket, fp, rest): the buckets in reach, and the flips left in each."""
    flips = [(sum(1 << b for b in c), half - k) for k in range(half + 1) for c in combinations(range(bits), k)]
    mask, rest = np.array([m for m, _ in flips], np.int64), np.array([r for _, r in flips], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            bucket = np.zeros(fps.size, np.int64)
            for k, b in enumerate(BIT_ORDER[:bits]):
                bucket |= (fps >> np.uint64(b) & np.uint64(1)).astype(np.int64) << k
            yield pa.RecordBatch.from_arrays([
                pa.array((bucket[:, None] ^ mask).ravel()), pa.array(np.repeat(fps.view(np.int64), mask.size)),
                pa.array(np.tile(rest, fps.size)),
            ], ["bucket", "fp", "rest"])

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` with the smallest index of each component after joining ``a`` to ``b``."""
    while True:
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped


def link_bucket(centres: np.ndarray, rest: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    """For each fingerprint of a bucket, the index of the one its forest hangs on.

    ``centres`` are the fingerprints with the bucket's own bits put in place, ``rest``
    the flips that remain, ``bits`` those that may be flipped. While there are too
    many variants, the next bit splits them in two halves that are done in turn.
    """
    label = np.arange(centres.size)
    todo = [(np.arange(centres.size), centres, rest, list(bits))]
    while todo:
        owner, at, left, free = todo.pop()
        sizes = [_reach(len(free), k) for k in range(int(left.max(initial=0)) + 1)]
        if sum(int((left == k).sum()) * size for k, size in enumerate(sizes)) > HELD_VARIANTS and free:
            bit = np.uint64(1 << free[0])
            for side in (np.uint64(0), bit):
                off = at & bit != side
                stay = ~off | (left > 0)
                if stay.sum() > 1:
                    todo.append((owner[stay], at[stay] & ~bit | side, left[stay] - off[stay], free[1:]))
            continue
        variants, owners = [], []
        for k in range(len(sizes)):
            mine = left == k
            if mine.any():
                masks = _masks(free, k)
                variants.append((at[mine][:, None] ^ masks).ravel())
                owners.append(np.repeat(owner[mine], masks.size))
        v, o = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(v)
        v, o = v[order], o[order]
        same = np.flatnonzero(v[1:] == v[:-1])
        if same.size:
            pairs = np.unique(np.stack([o[same], o[same + 1]], axis=1), axis=0)
            label = _forest(centres.size, pairs[:, 0], pairs[:, 1], label)
    return label


def _reach(free: int, most: int) -> int:
    total = term = 1
    for k in range(1, most + 1):
        term = term * (free - k + 1) // k
        total += term
    return total


def _link(bits: int):
    used, free = BIT_ORDER[:bits], BIT_ORDER[bits:]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        clear = np.uint64(2**64 - 1 - sum(1 << b for b in used))
        own = np.uint64(sum(1 << b for k, b in enumerate(used) if key[0] >> k & 1))
        label = link_bucket(fps & clear | own, rows["rest"].to_numpy().astype(np.int64), free)
        moved = np.flatnonzero(label != np.arange(label.size))
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[moved], "b": signed[label[moved]]})

    return run


def near_links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, whose components are those of all links.

    ``radius`` must be even: each side gets half of it. Two linked fingerprints are
    joined by a chain of differences within the radius.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    half, n = radius // 2, fps.count()
    bits = min(max(1, (n * _reach(64, half) // BUCKET_VARIANTS).bit_length()), 32)
    dealt = fps.select("fp").mapInArrow(_route(bits, half), "bucket long, fp long, rest int")
    return dealt.groupBy("bucket").applyInPandas(_link(bits), "a long, b long")


def near_groups(docs: DataFrame, radius: int = 4, width: int = 4,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row and (fp, component_id) of every distinct fingerprint.

    Null texts count as empty; texts without words have fingerprint 0 and are linked
    like others. A row without id never names a component that has another; alone, its
    component is null. Both results are written to the shared folder.
    """
    rows = materialise(fingerprints(docs, width, id_col, text_col), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    met = materialise(components(near_links(distinct, radius)), "fingerprint-components")
    names = met.join(distinct, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("first_id").alias("component_id"))
    named_nodes = met.join(materialise(names, "component-names"), "component").select("node", "component_id")
    groups = distinct.join(named_nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    return rows, materialise(groups, "fingerprint-groups")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows, groups = near_groups(docs, radius, width, id_col, text_col)
    return rows.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their columns, one for each component: the one with the smallest id.

    An id stands for one document: of repeated rows one stays. Rows without id cannot
    be told apart by a winner's id and all stay.
    """
    _, groups = near_groups(docs, radius, width, id_col, text_col)
    own_id = named(id_col).cast("long")
    keys = groups.where("component_id IS NOT NULL").select(F.col("component_id").alias("doc_id")).distinct()
    return keep_keys(docs.where(own_id.isNotNull()), keys, {"doc_id": own_id}).unionByName(docs.where(own_id.isNull()))
