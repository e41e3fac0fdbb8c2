"""License scan, token counts and BPE against libraries, brute force and SQL."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import edges
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import compare, connect
from tokenizers import Tokenizer

from linepack.llm import license_scan, merge_replay, packing, queries, ragged_bpe

SF = "/root/testdata/sf0.001"
JSON, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "​", " ", "a", "Ab", "é", "日本", "1", "²", "½", "!", "'s", "'ll",
       "<|endoftext|>", "😀", "é", "\x00", "aaa", "_", "\r\n", "١"]


def library() -> tiktoken.Encoding:
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == []


def odd_texts(n: int) -> list[str]:
    rnd = random.Random(3)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_counts_are_those_of_the_library():
    texts = [r[1] or "" for r in edges.rows()] + odd_texts(5000)
    tokenizer = Tokenizer.from_file(JSON)
    assert ragged_bpe.count_texts(texts, JSON, PATTERN) == [
        len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


def test_ids_are_those_of_the_library_and_decode_to_the_text():
    texts = [r[1] or "" for r in edges.rows()] + odd_texts(5000)
    replay, _ = merge_replay.codec(RANKS, PATTERN)
    encoding = library()
    for text, (ids, decimal) in zip(texts, merge_replay.encode_texts(texts, RANKS, PATTERN), strict=True):
        assert list(ids) == encoding.encode_ordinary(text)
        assert decimal == " ".join(map(str, ids)) and replay.decode(ids).decode() == text


def test_token_counts_of_awkward_rows(spark):
    docs = edges.documents(spark)
    got = sorted(map(tuple, ragged_bpe.token_counts(docs, JSON, PATTERN).collect()), key=str)
    tokenizer = Tokenizer.from_file(JSON)
    want = []
    for row in edges.rows():
        n = len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids)
        want.append((row[0], len((row[1] or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert ragged_bpe.token_counts(edges.nothing(spark), JSON, PATTERN).count() == 0


def test_round_trip_of_awkward_rows(spark):
    encoding = library()
    want = []
    for row in edges.rows():
        ids = encoding.encode_ordinary(row[1] or "")
        want.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((row[1] or "").encode()).hexdigest()))
    got = merge_replay.round_trip_digests(edges.documents(spark), RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    both = merge_replay.encoded_with_digests(edges.documents(spark), RANKS, PATTERN).drop("ids").collect()
    assert sorted(map(tuple, both), key=str) == sorted(want, key=str)
    assert merge_replay.round_trip_digests(edges.nothing(spark), RANKS, PATTERN).count() == 0
    encoded = merge_replay.encode_documents(edges.with_ids(spark), RANKS, PATTERN)
    decoded = merge_replay.decode_documents(encoded, RANKS, PATTERN).collect()
    texts = {r[0]: r[1] or "" for r in edges.rows() if r[0] is not None}
    assert {r.doc_id: r.decoded.decode() for r in decoded} == texts


def test_packing_is_best_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(200):
        capacity = rnd.choice([1, 7, 64, 100])
        sizes = [rnd.randint(0, capacity) for _ in range(rnd.randint(0, 60))]
        rooms: list[int] = []
        for size in sorted(sizes, reverse=True):
            fitting = [r for r in rooms if r >= size]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - size)
            else:
                rooms.append(capacity - size)
        rows = packing.best_fit_decreasing(sizes, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(capacity - sum(sizes[i] for i in r) for r in rows) == sorted(rooms)


def test_packed_rows_hold_every_token_once(spark, tmp_path):
    encoding = library()
    docs = edges.with_ids(spark)
    pieces = packing.token_pieces(docs, RANKS, PATTERN, 128)
    written = str(tmp_path / "pieces")
    pieces.write.parquet(written)
    packed = packing.pack(spark.read.parquet(written), 128, shard_tokens=20_000)
    rows = packing.position_resets(packed).collect()
    found: dict[int, dict[int, list[int]]] = {}
    for row in rows:
        ids = [int.from_bytes(row.ids[i : i + 2], "little") for i in range(0, len(row.ids), 2)]
        assert len(ids) == row.n_tokens == row.cu_seqlens[-1] <= 128
        assert row.position_ids == [i for a, b in zip(row.cu_seqlens, row.cu_seqlens[1:]) for i in range(b - a)]
        for doc, piece, a, b in zip(row.doc_ids, row.pieces, row.cu_seqlens, row.cu_seqlens[1:]):
            assert piece not in found.setdefault(doc, {})
            found[doc][piece] = ids[a:b]
    whole = {doc: [i for _, p in sorted(own.items()) for i in p] for doc, own in found.items()}
    want = {r.doc_id: encoding.encode_ordinary(r.text or "") for r in docs.collect()}
    assert whole == {d: ids for d, ids in want.items() if ids}
    tokens = sum(map(len, want.values()))
    assert len(rows) <= tokens / 128 + len({r.shard for r in rows}) + 1
    width = packing.id_type(RANKS, PATTERN)
    matrices = packing.write_matrices(spark.read.parquet(written), str(tmp_path / "matrices"), width, 50256, 128, 20_000).collect()
    assert sum(m.n_rows for m in matrices) == len(rows) and sum(m.n_tokens for m in matrices) == tokens
    again: dict[int, dict[int, list[int]]] = {}
    for m in matrices:
        assert len(m.matrix) == m.n_rows * 256 and m.cu_seqlens[-1] == m.n_rows * 128 and m.position_resets == m.cu_seqlens[:-1]
        flat = [int.from_bytes(m.matrix[i : i + 2], "little") for i in range(0, len(m.matrix), 2)]
        assert set(range(0, len(flat), 128)) <= set(m.position_resets)
        for doc, piece, a, b in zip(m.doc_ids, m.pieces, m.cu_seqlens[:-1], m.cu_seqlens[1:], strict=True):
            if doc is None:
                assert set(flat[a:b]) == {50256}
            else:
                again.setdefault(doc, {})[piece] = flat[a:b]
    assert again == found
    assert packing.packed_documents(edges.nothing(spark), RANKS, PATTERN).count() == 0
    assert packing.packed_documents(edges.documents(spark), RANKS, PATTERN).count() > 0


def test_packing_spreads_rows_without_id_and_repeated_rows(spark, tmp_path):
    rows = [(None, f"text number {k} " * 3) for k in range(2000)] + [(7, "the same row " * 4)] * 2000
    pieces = packing.token_pieces(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, PATTERN, 64)
    pieces.write.parquet(str(tmp_path / "pieces"))
    packed = packing.pack(spark.read.parquet(str(tmp_path / "pieces")), 64, shard_tokens=500).collect()
    sizes: dict[int, int] = {}
    whole: dict[int, dict[int, bytes]] = {}
    for row in packed:
        sizes[row.shard] = sizes.get(row.shard, 0) + row.n_tokens
        for source, piece, a, b in zip(row.source_rows, row.pieces, row.cu_seqlens[:-1], row.cu_seqlens[1:], strict=True):
            assert piece not in whole.setdefault(source, {})
            whole[source][piece] = row.ids[2 * a : 2 * b]
    assert max(sizes.values()) < 1000
    encoding = library()
    got = sorted(encoding.decode(np.frombuffer(b"".join(p for _, p in sorted(own.items())), "<u2").tolist()) for own in whole.values())
    assert got == sorted(t for _, t in rows)


def test_packing_chooses_the_width_of_ids(tmp_path):
    wide = tmp_path / "wide.tiktoken"
    wide.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % (b + 70_000) for b in range(256)))
    assert packing.id_type(str(wide), PATTERN).itemsize == 4 and packing.id_type(RANKS, PATTERN).itemsize == 2


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def test_license_matches_are_those_of_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = sorted({w.decode() for lines in license_scan.TEMPLATES.values() for line in lines for w in license_scan.words(line)})
    rows = [(i, "\n".join(" ".join(rnd.choice([*vocabulary, "zz", "the"]) for _ in range(rnd.randint(0, 25))) for _ in range(3))) for i in range(40)]
    lines = [line for own in license_scan.TEMPLATES.values() for line in own]
    rows += [(100 + i, "x\n" + " ".join(w for k, w in enumerate(line.split()) if k != i % 5) + " y") for i, line in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: sorted((m.label, m.block, m.containment) for m in r.matches) for r in license_scan.scan(docs).collect()}
    some = 0
    for doc, text in rows:
        want = []
        for k, line in enumerate(text.split("\n")):
            own = set(WORD.findall(lowered(line)))
            for label, templates in license_scan.TEMPLATES.items():
                for template in templates:
                    tokens = set(WORD.findall(lowered(template)))
                    if len(own & tokens) / len(tokens) >= 0.8 - 1e-12:
                        want.append((label, k, len(own & tokens) / len(tokens)))
        some += len(want)
        assert got[doc] == sorted(want)
    assert some > 5


def test_license_scan_of_awkward_rows(spark):
    got = license_scan.license_digest(license_scan.scan(edges.documents(spark))).collect()
    assert len(got) == len(edges.rows())
    by_id = {r.doc_id: r for r in got}
    row = by_id[15 * 3 % 17]
    assert (row.n_base, row.base_labels, row.labels, row.first_word, row.last_word, row.score) == (
        3, "apache,mit", "apache,apache-notice,mit", 3, 10, 1.0)
    empty = by_id[0]
    assert (empty.n_words, empty.n_base, empty.first_word, empty.last_word, empty.base_labels, empty.labels, empty.score) == (
        0, 0, None, None, "", "", 0.0)
    assert license_scan.scan(edges.nothing(spark)).count() == 0
