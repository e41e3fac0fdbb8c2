"""Byte-level BPE by replaying merges over a block's vocabulary, and decoding.

The distinct pre-tokens of a block of texts are laid out as one linked list of
symbols. An inverted index leads from each merge to the places where its pair
stands. Merges are replayed in rank order; a merge visits only its own places and
re-indexes the two neighbours of each. Texts then take the ids of their parts, and
decoding goes the other way, from ids to bytes.

A block is a bounded number of characters of one partition, so no index has to
fit more than that and nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, sub_batches, text_rows
from .pieces import PartMemo

#: Characters of a block.
BLOCK_CHARS = 4_000_000
#: Pairs whose merge is remembered.
PAIR_LIMIT = 300_000
#: Text parts whose ids are remembered.
PARTS = 600_000


class MergeReplay:
    """Ranks of a vocabulary; the rank of a token is its id."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.table: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.text = [str(i) for i in range(len(self.table))]
        #: What two bytes make, by the first byte times 256 plus the second.
        self.of_pair = np.array([self.ranks.get(bytes(divmod(i, 256)), -1) for i in range(65536)])
        self.pairs: dict[int, int] = {}

    def encode(self, pieces: Sequence[str]) -> list[bytes]:
        """Ids of each piece, as 32-bit numbers."""
        raw = [p.encode() for p in pieces]
        whole = [self.ranks.get(r) for r in raw]
        ends = np.cumsum([len(r) + 1 for r, w in zip(raw, whole, strict=True) if w is None], dtype=np.int64)
        symbols, pair, index = self._laid_out([r for r, w in zip(raw, whole, strict=True) if w is None], ends)
        if len(self.pairs) > PAIR_LIMIT:
            self.pairs = {}
        self._replay(symbols, pair, index)
        out: list[bytes] = []
        start, replayed = 0, iter(ends.tolist())
        for w in whole:
            if w is not None:
                out.append(array("I", (w,)).tobytes())
                continue
            end = next(replayed)
            out.append(array("I", [s for s in symbols[start:end] if s >= 0]).tobytes())
            start = end
        return out

    def _laid_out(self, raw: list[bytes], ends: np.ndarray) -> tuple[list[int], list[int], dict[int, list[int]]]:
        """Symbols with -1 after each piece, the merge at each place, and the places of each merge."""
        if not raw:
            return [], [], {}
        data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).astype(np.int64)
        symbols = self.of_byte[data]
        symbols[ends - 1] = -1
        pair = np.full(data.size, -1)
        pair[:-1] = np.where((symbols[:-1] >= 0) & (symbols[1:] >= 0), self.of_pair[data[:-1] << 8 | data[1:]], -1)
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        tokens, starts = np.unique(pair[at], return_index=True)
        groups = np.split(at, starts[1:])
        return symbols.tolist(), pair.tolist(), {t: g.tolist() for t, g in zip(tokens.tolist(), groups, strict=False)}

    def _replay(self, symbols: list[int], pair: list[int], index: dict[int, list[int]]) -> None:
        """Every merge in rank order, at its places; ``symbols`` end merged, -2 where one was taken up."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        known, ranks, table = self.pairs, self.ranks, self.table
        get = known.get
        heap = list(index)
        heapify(heap)
        while heap:
            token = heappop(heap)
            places = index.pop(token)
            places.sort()
            for i in places:
                if pair[i] != token:  # merged away, or its neighbour has changed
                    continue
                j = after[i]
                k = after[i] = after[j]
                before[k] = i
                symbols[i], symbols[j], pair[j] = token, -2, -1
                # Both neighbours make another pair now. What stands before the first piece is the last -1.
                h = before[i]
                x = symbols[h]
                if x >= 0:
                    key = x << 32 | token
                    made = get(key, -2)
                    if made == -2:
                        made = known[key] = ranks.get(table[x] + table[token], -1)
                    pair[h] = made
                    if made >= 0:
                        if made in index:
                            index[made].append(h)
                        else:
                            index[made] = [h]
                            heappush(heap, made)
                y = symbols[k]
                made = -1
                if y >= 0:
                    key = token << 32 | y
                    made = get(key, -2)
                    if made == -2:
                        made = known[key] = ranks.get(table[token] + table[y], -1)
                    if made >= 0:
                        if made in index:
                            index[made].append(i)
                        else:
                            index[made] = [i]
                            heappush(heap, made)
                pair[i] = made

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> tuple[MergeReplay, PartMemo]:
    replay = MergeReplay(path)
    return replay, PartMemo(pattern, replay.encode, b"".join, limit=PARTS)


def encode_texts(texts: Sequence[str], path: str, pattern: str) -> Iterator[tuple[list[int], str]]:
    """The ids of each text, as numbers and as decimal text."""
    replay, memo = codec(path, pattern)
    for start, end in slices([len(t) for t in texts], BLOCK_CHARS):
        for head, tail in memo.values(texts[start:end]):
            ids = np.frombuffer(head + b"".join(tail), np.uint32).tolist()
            yield ids, " ".join(map(replay.text.__getitem__, ids))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row; null and empty texts have no ids.

    ``vocabulary`` is the path of a rank file on every machine. A null id stays
    null, repeated rows are encoded each, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            texts = batch.column("text").to_pylist()
            ids = pa.array([i for i, _ in encode_texts(texts, vocabulary, pattern)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of its ids; null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, _ = codec(vocabulary, pattern)
        for batch in batches:
            raw = pa.array([replay.decode(i or ()) for i in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), raw], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, vocabulary: str, pattern: str,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids' decimal text and of the decoded bytes.

    Encoding and decoding of ``encode_documents`` and ``decode_documents`` without
    carrying ids between tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, _ = codec(vocabulary, pattern)
        for batch in sub_batches(batches):
            n, of_ids, of_bytes = [], [], []
            for ids, decimal in encode_texts(batch.column("text").to_pylist(), vocabulary, pattern):
                n.append(len(ids))
                of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(replay.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encoded_with_digests(docs: DataFrame, vocabulary: str, pattern: str,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 and decoded_sha256 of each row: what is kept for training and its check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, _ = codec(vocabulary, pattern)
        for batch in sub_batches(batches):
            flat, lengths, of_ids, of_bytes = array("i"), [0], [], []
            for ids, decimal in encode_texts(batch.column("text").to_pylist(), vocabulary, pattern):
                flat.extend(ids)
                lengths.append(len(flat))
                of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(replay.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.frombuffer(flat, np.int32))),
                pa.array(np.diff(lengths)), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()),
            ], ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
