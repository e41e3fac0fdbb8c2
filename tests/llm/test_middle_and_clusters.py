"""Fill-in-the-middle and centroid clustering against brute force and SQL."""

from __future__ import annotations

import hashlib
import random

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from linepack.llm import mean_order, middle_fill


def filled(doc_id, text):
    """The contract in plain Python."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def same(a, b):
    return sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def odd_rows():
    rnd = random.Random(4)
    marks = ["<P>", "<S>", "<M>", "<", "S>", ">", "P", "\n", "\r\n", "😀", "é", "é", "$1", "\\", " ", "a", "日本", " ", "\x00"]
    rows = [(k, "".join(rnd.choice(marks[3:] if k % 3 else marks) for _ in range(rnd.randint(0, 30)))) for k in range(600)]
    return [*rows, (700, "😀" * 9000), (701, "ab\n" * 100_000), (702, "<P"), (703, None), (None, "no id"), (None, None), (5, "twice"), (5, "twice")]


def test_fill_of_awkward_rows(spark):
    for rows, frame in ((odd_rows(), None), ([r[:2] for r in edges.rows()], edges.documents(spark))):
        frame = frame if frame is not None else spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = middle_fill.fill_in_middle(frame)
        assert same(got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect(), [filled(*r) for r in rows])
        wrong = got.where(middle_fill.restored(F.col("output"), F.col("form")) != F.col("text"))
        assert wrong.isEmpty()
    assert {r.form for r in got.collect()} >= {"plain", "psm"}
    assert middle_fill.fill_digest(middle_fill.fill_in_middle(edges.nothing(spark))).count() == 0


def test_fill_takes_its_shares(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    found = {r.form: r["count"] for r in middle_fill.fill_in_middle(docs, plain_percent=50, suffix_first_percent=50).groupBy("form").count().collect()}
    assert abs(found["plain"] - 2500) < 200 and abs(found["spm"] - 1250) < 150


def test_fill_shuffles_nothing(spark):
    plan = middle_fill.fill_digest(middle_fill.fill_in_middle(edges.documents(spark)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def plain_clusters(rows, clusters=16, rounds=3, size=64, scale=64):
    """The contract without any search."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            own = [v for (_, v), f in zip(kept, found) if f == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    found = [nearest(v) for _, v in kept]
    return [
        (vec_id, k, d, sum(e for e, j in found if j == k), sum(e for e, _ in found),
         hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
        for (vec_id, _), (d, k) in zip(kept, found)
    ]


VECTORS = "cluster string, vec_id long, embedding array<float>, label int, vector string, distance int"


def vector_rows(n=300, size=64):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(9, size)).astype("f4")
    rows = [(k, (base[k % 9] + rnd.normal(scale=0.05, size=size)).astype("f4").tolist()) for k in range(n)]
    rows += [(None, rows[0][1]), (None, rows[4][1]), rows[7], rows[7], (n, [0.0] * size), (n + 1, [0.0] * size),
             (n + 2, None), (n + 3, []), (n + 4, [1.0] * (size - 1)), (n + 5, [float("nan")] + [0.0] * (size - 1)),
             (n + 6, [float("inf")] + [0.0] * (size - 1)), (n + 7, [None] + [0.0] * (size - 1)), (n + 8, [-0.015625, 0.0156] * (size // 2))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([("x", i, v, 1, "y", 2) for i, v in rows], VECTORS)


@pytest.mark.parametrize("parts", [1, 5])
def test_clusters_of_awkward_vectors(spark, parts):
    rows = vector_rows()
    assert same(mean_order.clustered(frame(spark, rows).repartition(parts)).collect(), plain_clusters(rows))


def test_few_equal_and_no_vectors(spark):
    few = vector_rows()[:3]
    assert same(mean_order.clustered(frame(spark, few)).collect(), plain_clusters(few))
    equal = [(k, [0.5] * 64) for k in range(40)]
    assert same(mean_order.clustered(frame(spark, equal)).collect(), plain_clusters(equal))
    assert mean_order.clustered(frame(spark, [])).count() == 0


def test_huge_components_are_held(spark):
    rows = [(k, [(-1.0) ** k * 3e38] * 64) for k in range(20)] + vector_rows()[:30]
    got = mean_order.clustered(frame(spark, rows)).collect()
    assert len(got) == 50 and all(r.distance >= 0 for r in got)


def test_search_is_exact_and_passes_centroids_over():
    rnd = np.random.default_rng(1)
    centroids = rnd.integers(-60, 60, (200, 64))
    centroids[50:60] = centroids[:10]
    # Vectors near centroids whose means differ: the bounds can exclude most of them.
    centroids += rnd.integers(-60, 60, (200, 1))
    vectors = centroids[rnd.integers(0, 200, 3000)] + rnd.integers(-3, 4, (3000, 64))
    at, best, taken = mean_order.MeanOrder(centroids).nearest(vectors)
    gaps = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (at == gaps.argmin(1)).all() and (best == gaps.min(1)).all()
    assert taken < 0.2 * gaps.size
