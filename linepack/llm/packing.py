"""Packing token ids into rows of fixed length, best fit decreasing.

Documents are encoded, cut losslessly into pieces of at most a row, and dealt to
packing shards of bounded size by a hash of a number of their own, which missing and
repeated ids do not share. Inside a shard pieces are placed longest first, each into
the open row with the least room that still takes it. A segment tree over room sizes
finds that row in logarithmic time. A shard is written as one matrix of ids, with the
running lengths of its segments and the places where positions start at 0 again.

Each shard leaves at most its last rows part empty, so the loss does not grow with
the corpus, and no task packs more than a shard.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, sub_batches, text_rows

ROW_TOKENS = 2048
#: Tokens of a packing shard, about.
SHARD_TOKENS = 1_000_000

PIECE = "doc_id long, source_row long, piece int, n int, ids binary"
ROW = ("shard long, row int, n_tokens int, doc_ids array<long>, source_rows array<long>, pieces array<int>, "
       "cu_seqlens array<int>, ids binary")
MATRIX = ("shard long, n_rows int, n_tokens long, id_bytes int, matrix binary, cu_seqlens array<int>, "
          "position_resets array<int>, doc_ids array<long>, source_rows array<long>, pieces array<int>")


class RoomTree:
    """Which room sizes have an open row: a segment tree over 0 to ``capacity``."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The smallest room of at least ``size`` and a row that has it, removed."""
        at, count = size + self.width, self.count
        if not count[at]:
            # Up until a right neighbour has rows, then down to its smallest room.
            while at > 1 and not (at % 2 == 0 and count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.width
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Rows of indices into ``sizes`` (each at most ``capacity``); empty pieces take no room."""
    tree, rows = RoomTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        tree.put(room - sizes[i], row)
    return rows


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.dtype]:
    """The vocabulary's encoder, and the least of 16 and 32 bits that takes its ids and one more for padding."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    width = np.dtype("<u2" if max(ranks.values()) + 1 < 2**16 else "<u4")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), width


def token_pieces(docs: DataFrame, vocabulary: str, pattern: str, row_tokens: int = ROW_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, source_row, piece (from 0), n and ids (little endian, see ``id_type``) of each row's pieces.

    Put together in order, the pieces of a ``source_row`` (a number of each row of
    ``docs``, new in every evaluation: write the result before using it twice) are all of its
    ids. Null and empty texts have no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, width = _encoder(vocabulary, pattern)
        most = row_tokens * width.itemsize
        for batch in sub_batches(batches):
            doc, source, piece, raw = [], [], [], []
            for d, r, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source_row", "text")), strict=True):
                whole = np.array(encoding.encode_ordinary(text), width).tobytes()
                cut = [whole[i : i + most] for i in range(0, len(whole), most)]
                doc += [d] * len(cut)
                source += [r] * len(cut)
                piece += range(len(cut))
                raw += cut
            yield pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(source, pa.int64()), pa.array(piece, pa.int32()),
                pa.array([len(r) // width.itemsize for r in raw], pa.int32()), pa.array(raw, pa.binary()),
            ], ["doc_id", "source_row", "piece", "n", "ids"])

    return text_rows(docs, id_col, text_col).withColumn("source_row", F.monotonically_increasing_id()).mapInArrow(run, PIECE)


def id_type(vocabulary: str, pattern: str) -> np.dtype:
    """How the ids of a vocabulary are written."""
    return _encoder(vocabulary, pattern)[1]


def _dealt(pieces: DataFrame, shard_tokens: int) -> DataFrame:
    tokens = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-tokens // shard_tokens))
    return pieces.withColumn("shard", F.pmod(F.xxhash64("source_row", "piece"), F.lit(shards)))


def _packed_shard(rows: pd.DataFrame, row_tokens: int) -> list[tuple[list, list, list, np.ndarray, bytes]]:
    """doc_ids, source_rows, pieces, running lengths and ids of a shard's packed rows."""
    rows = rows.sort_values(["source_row", "piece"], kind="stable").reset_index(drop=True)
    sizes, raw = rows["n"].tolist(), rows["ids"].tolist()
    doc, source, piece = ([None if pd.isna(v) else int(v) for v in rows[c]] for c in ("doc_id", "source_row", "piece"))
    return [
        ([doc[i] for i in own], [source[i] for i in own], [piece[i] for i in own],
         np.cumsum([0, *[sizes[i] for i in own]]), b"".join(raw[i] for i in own))
        for own in best_fit_decreasing(sizes, row_tokens)
    ]


def pack(pieces: DataFrame, row_tokens: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each packed row: shard, row, n_tokens, doc_ids, source_rows, pieces, cu_seqlens, ids.

    ``cu_seqlens`` has 0 and the running lengths of the segments; segment k is piece
    ``pieces[k]`` of ``source_rows[k]``, whose id is ``doc_ids[k]``. ``pieces`` (see
    ``token_pieces``) must be a written table: it is counted first. No shard is much larger
    than ``shard_tokens``, whatever ids are missing or repeated.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = [
            (key[0], number, int(ends[-1]), docs, sources, own, ends.tolist(), ids)
            for number, (docs, sources, own, ends, ids) in enumerate(_packed_shard(rows, row_tokens))
        ]
        return pd.DataFrame(out, columns=["shard", "row", "n_tokens", "doc_ids", "source_rows", "pieces", "cu_seqlens", "ids"])

    return _dealt(pieces, shard_tokens).groupBy("shard").applyInPandas(run, ROW)


def position_resets(packed: DataFrame) -> DataFrame:
    """``packed`` with position_ids: every segment counts from 0."""
    spans = F.zip_with(
        F.slice("cu_seqlens", F.lit(1), F.size("cu_seqlens") - 1), F.slice("cu_seqlens", F.lit(2), F.size("cu_seqlens") - 1),
        lambda a, b: F.when(b > a, F.sequence(F.lit(0), b - a - 1)).otherwise(F.array().cast("array<int>")),
    )
    return packed.withColumn("position_ids", F.flatten(spans))


def write_matrices(pieces: DataFrame, folder: str, width: np.dtype, pad: int, row_tokens: int = ROW_TOKENS,
                   shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pack ``pieces``, write the id matrices and return the written table.

    Each row of the table is one shard: ``matrix`` (n_rows x row_tokens ids of ``id_bytes``
    bytes, little endian, rows filled up with ``pad``), ``cu_seqlens`` (0 and where in the
    flat matrix each segment ends, the rows one after the other and the padding of a row
    being a segment of its own), ``position_resets`` (where in the flat matrix positions start at 0
    again: where a segment starts) and ``doc_ids``, ``source_rows`` and ``pieces`` of the
    segments (null for padding).
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packed = _packed_shard(rows, row_tokens)
        matrix = np.full((len(packed), row_tokens), pad, width)
        of_doc, of_source, of_piece, ends = [], [], [], [0]
        for k, (docs, sources, own, cuts, ids) in enumerate(packed):
            size = int(cuts[-1])
            matrix[k, :size] = np.frombuffer(ids, width)
            ends += [k * row_tokens + int(c) for c in cuts[1:]]
            gap = size < row_tokens
            if gap:
                ends.append((k + 1) * row_tokens)
            of_doc += docs + [None] * gap
            of_source += sources + [None] * gap
            of_piece += own + [None] * gap
        return pd.DataFrame({
            "shard": [key[0]], "n_rows": [len(packed)], "n_tokens": [int(rows["n"].sum())], "id_bytes": [width.itemsize],
            "matrix": [matrix.tobytes()], "cu_seqlens": [ends], "position_resets": [ends[:-1]],
            "doc_ids": [of_doc], "source_rows": [of_source], "pieces": [of_piece],
        })

    _dealt(pieces, shard_tokens).groupBy("shard").applyInPandas(run, MATRIX).write.option("compression", "zstd").parquet(folder)
    return pieces.sparkSession.read.schema(MATRIX).parquet(folder)


def packed_documents(docs: DataFrame, vocabulary: str, pattern: str, row_tokens: int = ROW_TOKENS, pad: int | None = None,
                     folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, cut and pack ``docs`` and write the matrices; see ``write_matrices`` for the columns.

    ``pad`` is the first id beyond the vocabulary by default, ``folder`` one in the shared
    folder. Rows without id are packed under a null id, repeated rows each for itself:
    ``source_rows`` tells them apart. Pieces of equal size are placed in the order of rows. An empty
    table gives no rows. Other columns are ignored.
    """
    encoding, width = _encoder(vocabulary, pattern)
    written = new_folder(docs.sparkSession, "token-pieces")
    token_pieces(docs, vocabulary, pattern, row_tokens, id_col, text_col).write.option("compression", "zstd").parquet(written)
    pieces = docs.sparkSession.read.schema(PIECE).parquet(written)
    pad = encoding.max_token_value + 1 if pad is None else pad
    return write_matrices(pieces, folder or new_folder(docs.sparkSession, "matrices"), width, pad, row_tokens)


__all__ = ["best_fit_decreasing", "id_type", "pack", "packed_documents", "position_resets", "token_pieces", "write_matrices"]
