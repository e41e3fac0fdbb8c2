"""Exact, near, substring and embedding dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import edges
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from linepack.llm import block_anchors, digest_mph, pruned_graph, simhash_ball
from linepack.llm.components import components

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def reach(nodes, links):
    """The smallest node that each node reaches."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


def normal(text):
    return SPACES.sub(" ", text or "")


def test_a_minimal_perfect_hash_finds_members_only():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    levels, settled, slots = digest_mph.build_table(digests)
    assert sorted(slots.tolist()) == list(range(3000))
    held = b"".join(d for _, d in sorted(zip(slots.tolist(), digests, strict=True)))
    assert (digest_mph.find_slots(digests, levels, settled, held) == slots).all()
    strangers = [hashlib.sha256(str(-i - 1).encode()).digest() for i in range(3000)]
    assert (digest_mph.find_slots(strangers, levels, settled, held) == -1).all()


@pytest.mark.parametrize("before", [None, 0, 5, 1000])
def test_exact_groups_do_not_depend_on_what_is_history(spark, before):
    docs = edges.with_ids(spark)
    rows, groups = digest_mph.exact_groups(docs, history_before=before)
    got = {r.doc_id: (r.keep_id, r.copies) for r in rows.join(groups, "digest").collect()}
    texts = {r.doc_id: normal(r.text) for r in docs.collect()}
    assert got == {
        d: (min(k for k, u in texts.items() if u == t), sum(u == t for u in texts.values())) for d, t in texts.items()
    }


def test_exact_dedup_of_awkward_rows(spark):
    docs = edges.documents(spark)
    got = digest_mph.exact_duplicates(docs).collect()
    assert len(got) == len(edges.rows())
    kept = digest_mph.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in edges.rows()})
    assert {r.doc_id for r in kept.collect() if r.text == "no id at all"} == {None}
    assert digest_mph.exact_duplicates(edges.nothing(spark)).count() == 0
    assert digest_mph.drop_exact_duplicates(edges.nothing(spark)).count() == 0


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_rows():
    rnd = random.Random(8)
    rows, base = [], [edges.words(rnd, 60) for _ in range(8)]
    for i in range(120):
        own = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(len(own))] = rnd.choice(["new", "words", "here"])
        rows.append((i * 7 % 127, " ".join(own)))
    return rows


def test_near_groups_are_those_of_brute_force(spark):
    rows = near_rows() + [(r[0] + 1000, r[1]) for r in edges.rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = {d: plain_fingerprint(t) for d, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4]
    want = reach(prints, links)
    got = simhash_ball.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{prints[d]:016x}", want[d]) for d in prints}
    assert len(set(want.values())) < len(prints)
    kept = simhash_ball.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("bits, held", [(1, 10**6), (5, 10**6), (9, 3000)])
def test_buckets_lose_no_link(bits, held, monkeypatch):
    rnd = random.Random(bits)
    base = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(250):
        x = rnd.choice(base)
        for _ in range(rnd.randint(1, 6)):
            x ^= 1 << rnd.randrange(64)
        base.append(x)
    fps = np.array(sorted(set(base)), np.uint64)
    monkeypatch.setattr(simhash_ball, "HELD_VARIANTS", held)
    batch = pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64))], ["fp"])
    dealt = pa.Table.from_batches(list(simhash_ball._route(bits, 2)(iter([batch])))).to_pandas()
    links = []
    for key, group in dealt.groupby("bucket"):
        made = simhash_ball._link(bits)((key,), group.reset_index(drop=True))
        links += list(zip(made.a.tolist(), made.b.tolist(), strict=True))
    nodes = fps.view(np.int64).tolist()
    true = [(a, b) for a in nodes for b in nodes if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4]
    assert reach(nodes, links) == reach(nodes, true)


def test_near_dedup_of_awkward_rows(spark):
    docs = edges.documents(spark)
    got = simhash_ball.near_duplicates(docs).collect()
    assert len(got) == len(edges.rows())
    assert {r.fingerprint for r in got if r.doc_id == 0} == {"0" * 16}
    kept = simhash_ball.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 2
    assert simhash_ball.near_duplicates(edges.nothing(spark)).count() == 0
    assert simhash_ball.drop_near_duplicates(edges.nothing(spark)).count() == 0
    with pytest.raises(ValueError, match="even"):
        simhash_ball.near_links(spark.createDataFrame([(1,)], "fp long"), radius=3)


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300)]
    links += [(rnd.randint(400, 460), rnd.randint(400, 460)) for _ in range(40)]
    frame = spark.createDataFrame(links, "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in components(frame).collect()} == reach(nodes, [x for x in links if x[0] != x[1]])
    assert components(frame.limit(0)).count() == 0


def plain_removal(rows):
    words = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d, own in words.items():
        for i in range(len(own) - 12):
            key = tuple(own[i : i + 13])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, own in words.items():
        gone = set()
        for i in range(len(own) - 12):
            if first[tuple(own[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out[d] = (len(own), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("chunk, bucket", [(10**6, 10**6), (700, 300)])
def test_removed_words_are_those_of_brute_force(spark, chunk, bucket):
    rnd = random.Random(6)
    passages = [edges.words(rnd, n) for n in (13, 14, 19, 20, 60)]
    rows = []
    for i in range(60):
        own = edges.words(rnd, rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            own += rnd.choice(passages) + edges.words(rnd, rnd.randint(0, 9))
        rows.append((i * 11 % 61, " ".join(own)))
    rows.append((70, "the same " * 40))
    rows.append((71, "same the " * 30))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    got = block_anchors.substring_dedup(docs, chunk_words=chunk, bucket_words=bucket).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain_removal(rows)


def test_substring_dedup_of_awkward_rows(spark):
    docs = edges.documents(spark)
    got = block_anchors.substring_dedup(docs).collect()
    assert len(got) == len(edges.rows())
    want = plain_removal([(r[0], r[1]) for r in edges.rows() if r[0] is not None])
    assert all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert block_anchors.substring_dedup(edges.nothing(spark)).count() == 0
    texts = block_anchors.kept_texts(docs).collect()
    for r in texts:
        if r.doc_id is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == want[r.doc_id][2]
            assert sum(s.words for s in r.spans) == want[r.doc_id][1]


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_substring_dedup_of_repeated_rows(spark, parts):
    base = edges.rows()
    text = next(r[1] for r in base if r[1] and len(r[1].split()) > 100)
    rows = [r[:2] for r in base] + [(500, "start " + text), *[(501, text + " end")] * 1000, (502, text), (502, "other words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    want = plain_removal([r for r in dict.fromkeys(rows) if r[0] is not None and r[0] != 502])
    for chunk_words in (800, block_anchors.CHUNK_WORDS):
        got = block_anchors.substring_dedup(docs, chunk_words=chunk_words).collect()
        assert len(got) == len(rows)
        assert all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id not in (None, 502))
        assert sorted(r.n_removed > 0 for r in got if r.doc_id == 502) == [False, True]


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(400):
        v = centres[i % 12] + rng.normal(size=16) * (0.03 if i % 3 else 0.6)
        rows.append((i * 7 % 401, v.astype(np.float32).tolist(), i % 2))
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [1.0, None] * 8, 1),
             (1004, rows[0][1], None), (1005, rows[0][1], rows[0][2]), (1006, [float("inf")] * 16, 1), (None, rows[0][1], 0),
             (1007, [1.0, 2.0], 0)]
    return rows


def test_vector_links_against_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in pruned_graph.near_vectors(frame).collect()}
    assert len(got) == len(rows)
    good = [(i, np.array(v, np.float64), k) for i, v, k in rows
            if i is not None and k is not None and v is not None and len(v) == 16 and None not in v
            and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, v, k in good for b, w, m in good
             if a < b and k == m and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98]
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = sum(min(got[i].n_links, n) for i, n in count.items())
    assert found >= 0.9 * sum(count.values()) > 0
    assert all(got[i].n_links <= n for i, n in count.items())
    label = reach([i for i in count if i is not None], links)
    assert {i: got[i].component_id for i in label} == label
    assert all(got[i].kept == (label[i] == i) for i in label)
    assert got[1004].n_links == got[1000].n_links == 0 and got[1005].audit_recall >= 0.9
    assert pruned_graph.near_vectors(frame.limit(0)).count() == 0


def test_links_of_equal_vectors_are_whole(spark):
    rng = np.random.default_rng(5)
    rows = []
    for copies in (100, 1000, 3):
        one = rng.normal(size=16)
        near = one + rng.normal(size=16) * 0.01
        rows += [(one, 1)] * copies + [(near, 1)] * 2 + [(one, 2)]
    order = rng.permutation(len(rows)).tolist()
    rows = [(i, rows[k][0].tolist(), rows[k][1]) for i, k in enumerate(order)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept, r.audit_recall) for r in pruned_graph.near_vectors(frame).collect()}
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    assert got == {i: (int(own.sum()) - 1, int(own.argmax()), int(own.argmax()) == i, 1.0) for i, own in enumerate(linked)}


def test_neighbours_of_rows_that_pivots_hardly_part_are_candidates(monkeypatch):
    monkeypatch.setattr(pruned_graph, "LEAF_ROWS", 32)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3, 16))
    x = base[rng.integers(0, 3, 4000)] + rng.normal(size=(4000, 16)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argsort(-(x @ x.T), axis=1)[:, 1]
    together = np.zeros(len(x), bool)
    for leaf in pruned_graph._leaves(x, rng):
        together[leaf[np.isin(near[leaf], leaf)]] = True
    assert together.mean() >= 0.9
    assert [leaf.size for leaf in pruned_graph._leaves(np.repeat(x[:1], 500, axis=0), rng)][:2] == [500, 500]
    some = x[:1500]
    edges_of = pruned_graph.build_edges(some, rng)
    seen, entry = np.full(len(some), -1), int(np.argmax(some @ some.mean(axis=0)))
    found = sum(pruned_graph.range_search(some, edges_of, q, entry, seen, 0.9).size for q in range(300))
    true = int((some[:300] @ some.T >= 0.9).sum()) - 300
    assert true >= found >= 0.98 * true > 0
