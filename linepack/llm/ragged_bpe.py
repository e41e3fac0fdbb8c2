"""Token counts by rank-synchronous merging of ragged arrays.

Many pre-tokens are held as one array of symbols with the start of each. In
every round each sequence merges its own lowest-ranked pair, at all its places,
in one set of array operations for the whole batch; sequences without a known
pair leave. What survives is counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, sub_batches, text_rows
from .pieces import PartMemo

#: Characters of text that are cut into parts at a time.
SLICE_CHARS = 4_000_000
NO_RANK = np.int64(2**62)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in shown}
    rest = [b for b in range(256) if b not in chars]
    chars |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: b for b, c in chars.items()}


class RaggedMerger:
    """Merge table of a vocabulary: sorted pair keys, their ranks and results."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_byte = np.zeros(256, np.int64)
        for char, byte in byte_symbols().items():
            self.of_byte[byte] = vocab[char]
        self.special = [t["content"] for t in spec["added_tokens"]]

    def counts(self, pieces: list[str]) -> np.ndarray:
        """The number of symbols that each piece is merged to."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        final = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), lengths)
        while symbols.size > 1:
            at = self._at(symbols, owner)
            rank = np.where(at >= 0, self.ranks[at], NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, owner.size])
            live = least < NO_RANK
            final[owner[starts[~live]]] = sizes[~live]
            in_live = np.repeat(live, sizes)
            hit = (rank == np.repeat(least, sizes)) & in_live
            hit = self._leftmost(hit)
            symbols = np.where(hit, self.made[at], symbols)
            gone = np.r_[False, hit[:-1]]
            stay = in_live & ~gone
            symbols, owner = symbols[stay], owner[stay]
        final[owner] = 1 if symbols.size else final[owner]
        return final

    def _at(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Where the pair that begins at each place is in the table, else -1."""
        at = np.full(symbols.size, -1)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        key = symbols[inner] << 32 | symbols[inner + 1]
        found = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        at[inner] = np.where(self.keys[found] == key, found, -1)
        return at

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of hits in a row (a pair of equal symbols) the first, third and so on.

        Hits of neighbouring sequences never touch: the last place of a sequence
        begins no pair.
        """
        if not (hit[1:] & hit[:-1]).any():
            return hit
        place = np.arange(hit.size)
        last_miss = np.maximum.accumulate(np.where(hit, -1, place))
        return hit & ((place - last_miss) % 2 == 1)


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> tuple[PartMemo, list[str]]:
    merger = RaggedMerger(path)
    return PartMemo(pattern, lambda pieces: merger.counts(pieces).tolist(), sum), merger.special


def count_texts(texts: list[str], path: str, pattern: str) -> list[int]:
    """Tokens of each text; a special string inside a text is one token."""
    memo, special = _counter(path, pattern)
    out = []
    for start, end in slices([len(t) for t in texts], SLICE_CHARS):
        split: list[str] = []
        owners: list[int] = []
        extra = [0] * (end - start)
        for i, text in enumerate(texts[start:end]):
            own = [text]
            for mark in special:
                own = [q for p in own for q in p.split(mark)] if mark in text else own
            extra[i] = len(own) - 1
            split += own
            owners += [i] * len(own)
        for i, (head, tail) in zip(owners, memo.values(split), strict=True):
            extra[i] += head + sum(tail)
        out += extra
    return out


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row.

    ``vocabulary`` is the path of a byte-level BPE file in tokenizers' format on
    every machine, ``pattern`` its pre-token pattern. Null and empty texts have no
    tokens; a null id stays null; repeated rows are counted each; other columns
    are ignored. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            texts = batch.column("text").to_pylist()
            n = pa.array(count_texts(texts, vocabulary, pattern), pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            over = pa.array([k > limit for k in n.to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, n, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return text_rows(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
