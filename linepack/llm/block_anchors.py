"""Substring dedup with fixed-block anchors.

A window of 13 words always holds one whole block of 7 words of its document, when
blocks stand at every seventh word. So every document's blocks are the index, and
every rolling window of 7 words of every document is a probe. A probe that meets a
block from elsewhere is an anchor. Around anchors, repeats are extended: all windows
of 13 words that hold an anchor are compared by 96 bits of hash, and of those that
start in several documents only the one with the smallest id keeps its words. Runs
of such windows are the maximal repeats.

Words travel as arrays of hashes, not as rows. A task takes its documents in chunks
of bounded size. Equal windows of a chunk are settled in it and sent once, so a
passage that a third of all documents share reaches its task once for each chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, sub_batches, text_rows

WINDOW = 13
#: Words of a chunk, and entries of a bucket, about.
CHUNK_WORDS = 800_000
BUCKET_WORDS = 300_000
#: Bits of a window's hash that are compared within a bucket; the lowest bit of 32 says whether it is a block.
ANCHOR_BITS = 31

# Rows of an exchange. Entries (kind 0) go to the bucket ``key``, chunks (kind 1) pass through.
SENT = "key long, chunk string, kind int, first binary, second binary, third binary, fourth binary"
SPOTS = "doc_id long, text_hash long, spots binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_compressor, _decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(raw: bytes) -> bytes:
    return _compressor.compress(raw)


def unsqueeze(packed: bytes) -> bytes:
    return _decompressor.decompress(packed)


def pack_longs(values: np.ndarray) -> bytes:
    """Differences of the values, byte plane by byte plane, compressed."""
    steps = np.diff(values.astype("<i8"), prepend=np.int64(0)).astype("<i8")
    return squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_longs(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def places(packed: list[bytes] | None) -> np.ndarray:
    """All places that any of the packed arrays hold, in order."""
    return np.unique(np.concatenate([unpack_longs(p) for p in packed])) if packed else np.zeros(0, np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ x >> np.uint64(33)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on (short at the end)."""
    n = max(0, hashes.size - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64)
        out = out * np.uint64(0xD6E8FEB86659FD93) + (hashes[k : k + n] ^ odd)
    return _mixed(out)


@dataclass
class Chunk:
    """Documents one after the other: ids, text hashes, where each begins, and word hashes."""

    ids: list[int]
    texts: list[int]
    starts: np.ndarray
    hashes: np.ndarray
    spots: list[np.ndarray]

    @property
    def name(self) -> str:
        """The same whenever the same documents come in the same order."""
        return hashlib.sha256(np.array([self.ids, self.texts], "<i8").tobytes()).hexdigest()[:32]

    def whole(self, width: int) -> np.ndarray:
        """Places at which ``width`` words of one document follow."""
        ends = np.r_[self.starts[1:], len(self.hashes)]
        ok = np.zeros(len(self.hashes) + 1, np.int64)
        long = ends - self.starts >= width
        np.add.at(ok, self.starts[long], 1)
        np.add.at(ok, ends[long] - width + 1, -1)
        return np.flatnonzero(np.cumsum(ok[:-1]))


def _chunks(batches: Iterator[pa.RecordBatch], with_spots: bool, most: int) -> Iterator[Chunk]:
    ids, texts, hashes, starts, spots, total = [], [], [], [], [], 0

    def done() -> Chunk:
        return Chunk(ids, texts, np.array(starts, np.int64), np.concatenate(hashes), spots)

    for batch in batches:
        own_spots = batch.column("spots").to_pylist() if with_spots else [None] * batch.num_rows
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("raw").to_pylist(), own_spots, strict=True)
        for doc, text, raw, spot in rows:
            words = (unsqueeze(raw) if raw else b"").split()
            if doc is None or len(words) < WINDOW:
                continue
            ids.append(doc)
            texts.append(text)
            starts.append(total)
            hashes.append(word_hashes(words))
            if with_spots:
                spots.append(places(spot) + total)
            total += len(words)
            if total >= most:
                yield done()
                ids, texts, hashes, starts, spots, total = [], [], [], [], [], 0
    if ids:
        yield done()


def _sent(chunk: Chunk, settled: np.ndarray, bucket: np.ndarray, columns: list[tuple[np.ndarray, Callable[[np.ndarray], bytes]]]) -> pa.RecordBatch:
    """The chunk's own row, with places settled in it, and its entries by bucket. ``bucket`` is sorted."""
    name = chunk.name
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if bucket.size else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], bucket.size].astype(np.int64)
    # Chunks have keys below 0, away from all buckets.
    keys = [-1 - int(name[:12], 16), *bucket[cuts].tolist()]
    blobs = [[pack_longs(np.array(chunk.ids)), pack_longs(np.array(chunk.texts)), pack_longs(chunk.starts), pack_longs(settled)]]
    for a, b in zip(cuts.tolist(), ends.tolist(), strict=True):
        own = [put(values[a:b]) for values, put in columns]
        blobs.append(own + [None] * (4 - len(own)))
    return pa.RecordBatch.from_arrays([
        pa.array(keys, pa.int64()), pa.array([name] * len(keys)), pa.array([1] + [0] * cuts.size, pa.int32()),
        *[pa.array([b[k] for b in blobs], pa.binary()) for k in range(4)],
    ], ["key", "chunk", "kind", "first", "second", "third", "fourth"])


def _probe(bits: int, block: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, False, most):
            at = chunk.whole(block)
            window = rolled(chunk.hashes[:, 0], block)[at]
            owner = np.searchsorted(chunk.starts, at, side="right") - 1
            is_block = (at - chunk.starts[owner]) % block == 0
            key = window >> np.uint64(64 - ANCHOR_BITS - bits)
            order = np.argsort(key, kind="stable")
            key, place = key[order], at[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, key.size])
            twice = np.repeat(size > 1, size)
            any_block = np.maximum.reduceat(is_block[order], first)
            bucket = (key[first] >> np.uint64(ANCHOR_BITS)).astype(np.int64)
            low = (key[first] << np.uint64(64 - ANCHOR_BITS) >> np.uint64(64 - ANCHOR_BITS) << np.uint64(1)).astype("<u4") | any_block.astype("<u4")
            by_place = np.lexsort((place[first], bucket))
            yield _sent(chunk, np.sort(place[twice]), bucket[by_place],
                        [(low[by_place], lambda v: v.tobytes()), (place[first][by_place], pack_longs)])

    return run


def _meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Which entries of a bucket are anchors: windows of two chunks, one of them a block."""
    if key[0] < 0:
        return rows
    parts = [np.frombuffer(b, "<u4") for b in rows["first"]]
    low, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [p.size for p in parts])
    order = np.argsort(low >> 1, kind="stable")
    window, block = low[order] >> 1, low[order] & 1
    first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
    size = np.diff(np.r_[first, window.size])
    hit = np.zeros(low.size, bool)
    hit[order] = np.repeat((size > 1) & (np.maximum.reduceat(block, first) > 0), size)
    return _answers(rows, owner, hit, "second")


def _answers(rows: pd.DataFrame, owner: np.ndarray, hit: np.ndarray, places: str) -> pd.DataFrame:
    """For each row with hits, their places in its chunk."""
    out = []
    counts = np.bincount(owner, minlength=len(rows))
    ends = np.cumsum(counts)
    for k, (chunk, packed) in enumerate(zip(rows["chunk"], rows[places], strict=True)):
        own = hit[ends[k] - counts[k] : ends[k]]
        if own.any():
            out.append((0, chunk, 0, pack_longs(unpack_longs(packed)[own]), None, None, None))
    return pd.DataFrame(out, columns=["key", "chunk", "kind", "first", "second", "third", "fourth"])


def _gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """All places of a chunk, by document."""
    own = rows[rows["kind"] == 1]
    if own.empty:
        raise RuntimeError("the rows of a chunk came in another order when a task was repeated; write the documents first")
    own = own.iloc[0]
    ids, texts, starts = (unpack_longs(own[c]) for c in ("first", "second", "third"))
    found = places([own["fourth"], *rows.loc[rows["kind"] == 0, "first"]])
    owner = np.searchsorted(starts, found, side="right") - 1
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if found.size else np.zeros(0, np.int64)
    docs = owner[cuts]
    return pd.DataFrame({
        "doc_id": ids[docs], "text_hash": texts[docs],
        "spots": [pack_longs(p - starts[d]) for d, p in zip(docs, np.split(found, cuts[1:]) if cuts.size else [], strict=True)],
    })


def _extend(bits: int, block: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, True, most):
            anchors = np.zeros(len(chunk.hashes) + WINDOW, np.int64)
            anchors[np.concatenate(chunk.spots)] = 1
            so_far = np.cumsum(np.r_[0, anchors])
            at = chunk.whole(WINDOW)
            at = at[so_far[at + WINDOW - block + 1] > so_far[at]]
            one, two = rolled(chunk.hashes[:, 0], WINDOW)[at], rolled(chunk.hashes[:, 1], WINDOW)[at].astype("<u4")
            doc = np.array(chunk.ids, np.int64)[np.searchsorted(chunk.starts, at, side="right") - 1]
            order = np.lexsort((doc, two, one))
            one, two, doc, place = one[order], two[order], doc[order], at[order]
            if not at.size:
                yield _sent(chunk, at, at, [])
                continue
            first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
            least = np.repeat(doc[first], np.diff(np.r_[first, one.size]))
            open_ = doc == least
            bucket = (one[open_] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(int(open_.sum()), np.int64)
            by_place = np.lexsort((place[open_], bucket))
            columns = [(one[open_], lambda v: v.tobytes()), (two[open_], lambda v: v.tobytes()), (doc[open_], pack_longs), (place[open_], pack_longs)]
            yield _sent(chunk, np.sort(place[~open_]), bucket[by_place], [(v[by_place], put) for v, put in columns])

    return run


def _settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Entries of a bucket whose window also starts in a document with a smaller id."""
    if key[0] < 0:
        return rows
    one = np.concatenate([np.frombuffer(b, "<u8") for b in rows["first"]])
    two = np.concatenate([np.frombuffer(b, "<u4") for b in rows["second"]])
    docs = [unpack_longs(b) for b in rows["third"]]
    owner, doc = np.repeat(np.arange(len(docs)), [d.size for d in docs]), np.concatenate(docs)
    order = np.lexsort((doc, two, one))
    a, b, d = one[order], two[order], doc[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    later = np.zeros(doc.size, bool)
    later[order] = d > np.repeat(d[first], np.diff(np.r_[first, a.size]))
    return _answers(rows, owner, later, "fourth")


def _exchange(sent: DataFrame, judge: Callable, label: str) -> DataFrame:
    """Deal entries to buckets, judge them, and bring the answers back to documents.

    One row for each id and text, however often it is repeated: copies of a row are in
    several places of chunks, and what is found for any of them holds for all.
    """
    met = materialise(sent.groupBy("key").applyInPandas(judge, SENT), label)
    found = met.groupBy("chunk").applyInPandas(_gather, SPOTS)
    return materialise(found.groupBy("doc_id", "text_hash").agg(F.collect_set("spots").alias("spots")), f"{label}-spots")


def _squeezed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash and the compressed UTF-8 text, as it travels to joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            raw = pa.array([squeeze(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), raw], ["doc_id", "text_hash", "raw"])

    rows = text_rows(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, raw binary")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     chunk_words: int = CHUNK_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """doc_id, text_hash, spots: where windows start that also start in a smaller doc_id.

    ``spots`` is a list of packed arrays (see ``places``). One row for each id and text;
    documents without such windows have none.
    """
    block = (WINDOW + 1) // 2
    plain = text_rows(docs, id_col, text_col)
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(64 - ANCHOR_BITS, (size // 6 // bucket_words).bit_length())
    squeezed = _squeezed(docs, id_col, text_col)
    anchors = _exchange(squeezed.mapInArrow(_probe(bits, block, chunk_words), SENT), _meet, "anchors")
    # Sorted, so that a repeated task makes the same chunks.
    near = squeezed.join(anchors, ["doc_id", "text_hash"]).sortWithinPartitions("doc_id", "text_hash")
    return _exchange(near.mapInArrow(_extend(bits, block, chunk_words), SENT), _settle, "repeats")


def removed_words(n: int, spots: np.ndarray) -> np.ndarray:
    """Which of ``n`` words are covered by windows at ``spots``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, spots, 1)
    np.add.at(steps, spots + WINDOW, -1)
    return np.cumsum(steps[:-1]) > 0


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, str]] = []
        for raw, spots in zip(batch.column("raw").to_pylist(), batch.column("spots").to_pylist(), strict=True):
            words, gone = (unsqueeze(raw) if raw else b"").split(), 0
            n = len(words)
            if spots is not None:
                mask = removed_words(n, places(spots))
                gone = int(mask.sum())
                words = [w for w, m in zip(words, mask.tolist(), strict=True) if not m]
            out.append((n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
            pa.array([o[2] for o in out], pa.string()),
        ], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    chunk_words: int = CHUNK_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``.

    Null and empty texts have no words. A document without id is no reference and loses
    no words. Repeated rows (same id and text) lose the same words, and none to each
    other, as neither id is smaller; each has its row. An empty table gives no rows, other
    columns are left out. ``docs`` should be a stored table: chunks must come
    in the same order when a task is repeated, else the run stops.
    """
    spots = repeated_windows(docs, id_col, text_col, chunk_words, bucket_words)
    return _squeezed(docs, id_col, text_col).join(spots, ["doc_id", "text_hash"], "left").select(
        "doc_id", "raw", "spots"
    ).mapInArrow(_digest, RESULT)


def kept_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept_text (words joined by one blank) and spans (first word and number of words removed)."""
    kind = "doc_id long, kept_text string, spans array<struct<first:int,words:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for raw, spots in zip(batch.column("raw").to_pylist(), batch.column("spots").to_pylist(), strict=True):
                words = (unsqueeze(raw) if raw else b"").split()
                gone = removed_words(len(words), places(spots))
                edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                spans.append([{"first": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                texts.append(b" ".join(w for w, m in zip(words, gone.tolist(), strict=True) if not m).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(texts, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))),
            ], ["doc_id", "kept_text", "spans"])

    spots = repeated_windows(docs, id_col, text_col)
    return _squeezed(docs, id_col, text_col).join(spots, ["doc_id", "text_hash"], "left").select("doc_id", "raw", "spots").mapInArrow(run, kind)
