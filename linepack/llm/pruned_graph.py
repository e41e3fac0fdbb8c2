"""Embedding near-duplicates by range search in a robust-pruned flat graph.

Vectors of one label are dealt to overlapping shards, each to those of its two
nearest centres. In a shard every vector gets out-edges chosen by robust pruning:
the nearest candidate stays and drops those that lie closer to it than to the
vector. The adjacency lists of a vector's shards are united. Every vector is then
looked for from its shard's medoid, and where it is found the search widens over all
neighbours in range. Each link is verified in double precision; an audit compares a
sample with brute force.

Equal vectors of a label go through all of this as one, with their number: they would
occlude each other in every list of edges. Their links are put back by that number.

Links are counted, not listed: the two shards of a pair agree that the smaller common
one counts it. A forest over the links goes on to the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, named, ship
from .components import components
from .simhash_ball import _forest as forest

THRESHOLD = 0.98
#: Centres are fitted on at most this many vectors; there are at most MOST_CENTRES.
SAMPLE_ROWS = 8192
MOST_CENTRES = 256
#: Vectors of a centre over all labels, and queries of a task, about.
CENTRE_ROWS = 4096
TASK_QUERIES = 2048
#: Vectors compared with each other while edges are chosen, and rows of them at a time.
LEAF_ROWS = 1024
BLOCK_ROWS = 256
#: A leaf's part that holds this share of it is not parted again: its rows are all alike.
ALIKE = 0.75
#: Candidates of a vector, its out-edges, and how much nearer an occluding edge must be.
CANDIDATES, DEGREE, ALPHA = 48, 24, 1.2
#: Nodes kept while searching.
BEAM = 8
#: Vectors whose links are counted by brute force for the audit.
AUDITED = 256

MEMBER = "label long, centre int, vec_id long, vector array<double>, copies long, other int"
EDGES = "label long, vec_id long, edges array<long>"
FOUND = "vec_id long, n long, root long"


def unit(vector: Column) -> Column:
    """The vector at length 1 in double precision; null if null, zero or not finite in a component."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad & (norm > 0) & (norm < float("inf")), F.transform(wide, lambda x: x / norm))


def fit_centres(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, from evenly spaced rows."""
    centres = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)]
    for _ in range(8):
        near = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else column.tolist(), np.float64)


def _assign(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_matrix(batch.column("vector")) @ centres.T), axis=1, kind="stable")[:, :2]
            first, last = near[:, 0], near[:, -1]
            for own, other, rows in ((first, last, slice(None)), (last, first, first != last)):
                at = pa.array(np.arange(batch.num_rows)[rows])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(at), pa.array(own[rows].astype(np.int32)), batch.column("vec_id").take(at),
                     batch.column("vector").take(at), batch.column("copies").take(at), pa.array(other[rows].astype(np.int32))],
                    ["label", "centre", "vec_id", "vector", "copies", "other"],
                )

    return run


def robust_prune(sims: np.ndarray, candidates: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Up to DEGREE of the candidates, nearest first, without those an earlier one occludes.

    ``sims`` are cosines to the vector, ``between`` those of candidates to each other;
    distances are 1 - cosine.
    """
    order = np.argsort(-sims, kind="stable")
    alive = np.ones(order.size, bool)
    kept = []
    for place in order:
        if not alive[place]:
            continue
        kept.append(candidates[place])
        if len(kept) == DEGREE:
            break
        alive &= ALPHA * (1 - between[place]) > 1 - sims
    return np.array(kept, np.int64)


def _leaves(x: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Overlapping sets of at most LEAF_ROWS rows, or more that pivots don't part: each row is in those of its two nearest pivots."""
    todo, done = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if rows.size <= LEAF_ROWS:
            done.append(rows)
            continue
        pivots = x[rng.choice(rows, 8, replace=False)]
        near = np.argsort(-(x[rows] @ pivots.T), axis=1)[:, :2]
        for k in range(8):
            own = rows[(near == k).any(axis=1)]
            if own.size:
                (todo if own.size < ALIKE * rows.size else done).append(own)
    return done


def build_edges(x: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Out-edges of each row, with the edges back."""
    out: list[list[np.ndarray]] = [[] for _ in x]
    for rows in _leaves(x, rng):
        own = x[rows]
        near = min(CANDIDATES, rows.size - 1)
        for i in range(rows.size):
            if i % BLOCK_ROWS == 0:
                block = own[i : i + BLOCK_ROWS] @ own.T
            sims = block[i % BLOCK_ROWS]
            sims[i] = -2
            # The nearest, and some at random for the long way.
            at = np.argpartition(-sims, near - 1)[:near] if near else np.zeros(0, np.int64)
            at = np.unique(np.r_[at, rng.integers(0, rows.size, 8)])
            at = at[at != i]
            kept = robust_prune(sims[at], at, own[at] @ own[at].T)
            out[rows[i]].append(rows[kept])
    ends = [np.unique(np.concatenate(o)) if o else np.zeros(0, np.int64) for o in out]
    back: list[list[int]] = [[] for _ in x]
    for i, own in enumerate(ends):
        for j in own:
            back[j].append(i)
    return [np.union1d(own, np.array(b[: 2 * DEGREE], np.int64)) for own, b in zip(ends, back, strict=True)]


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    ids = rows["vec_id"].to_numpy()
    edges = build_edges(_matrix(rows["vector"]), np.random.default_rng(7))
    return pd.DataFrame({"label": np.full(len(ids), key[0]), "vec_id": ids, "edges": [ids[e].tolist() for e in edges]})


def range_search(x: np.ndarray, adjacency: list[np.ndarray], q: int, entry: int, seen: np.ndarray, threshold: float) -> np.ndarray:
    """Rows within ``threshold`` of row ``q`` that the graph leads to. ``seen`` is marked with q."""
    target = x[q]
    nodes = np.unique([entry, q])
    seen[nodes] = q
    sims = x[nodes] @ target
    in_range = [nodes[sims >= threshold]]
    beam, near, opened = nodes, sims, np.zeros(nodes.size, bool)
    while not opened.all():
        best = int(np.argmax(np.where(opened, -3, near)))
        opened[best] = True
        new = adjacency[beam[best]]
        new = new[seen[new] != q]
        if new.size:
            seen[new] = q
            sims = x[new] @ target
            in_range.append(new[sims >= threshold])
            beam, near, opened = np.r_[beam, new], np.r_[near, sims], np.r_[opened, np.zeros(new.size, bool)]
            top = np.argsort(-near, kind="stable")[:BEAM]
            beam, near, opened = beam[top], near[top], opened[top]
    frontier = np.concatenate(in_range)
    while frontier.size:
        new = np.unique(np.concatenate([adjacency[i] for i in frontier]))
        new = new[seen[new] != q]
        seen[new] = q
        frontier = new[x[new] @ target >= threshold] if new.size else new
        in_range.append(frontier)
    found = np.concatenate(in_range)
    return found[found != q]


def _search(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        ids, x = rows["vec_id"].to_numpy(), _matrix(rows["vector"])
        centre, other, mine, copies = key[1], rows["other"].to_numpy(), rows["mine"].to_numpy(), rows["copies"].to_numpy()
        place = {v: i for i, v in enumerate(ids.tolist())}
        adjacency = [np.array([place[v] for v in e if v in place], np.int64) for e in rows["edges"]]
        entry = int(np.argmax(x @ x.mean(axis=0)))
        seen, label, counts = np.full(len(ids), -1), np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for q in np.flatnonzero(mine):
            found = range_search(x, adjacency, int(q), entry, seen, threshold)
            # A pair with both shards in common is counted in the smaller one only.
            twice = (other[found] == other[q]) & (other[q] < centre)
            counts[q] = copies[found[~twice]].sum()
            if found.size:
                label = forest(len(ids), np.full(found.size, q), found, label)
        return pd.DataFrame({"vec_id": ids, "n": counts, "root": ids[label]})[mine | (label != np.arange(len(ids)))]

    return run


def _audit(sample: pa.Table, threshold: float):
    ids, labels = sample.column("vec_id").to_numpy(), sample.column("label").to_numpy()
    vectors = _matrix(sample.column("vector").combine_chunks()) if len(ids) else np.zeros((0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ids.size, np.int64)
        for batch in batches:
            if batch.num_rows:
                linked = (vectors @ _matrix(batch.column("vector")).T >= threshold)
                linked &= labels[:, None] == batch.column("label").to_numpy()
                linked &= ids[:, None] != batch.column("vec_id").to_numpy()
                total += linked.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["vec_id", "true_links"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept and audit_recall of every row of ``vectors``.

    Only vectors of equal, not null labels are compared. Vectors that are null, zero or
    hold a null or non-finite component link with nothing, nor do those of another
    length than most. Ids must be unique and not null to be linked: rows that share an id
    are one vector (the first by value is used for all); a null id has no links.
    audit_recall is the share of the links of a bounded sample that were found, 1 if it
    has none. Work tables go to the shared folder.
    """
    ship(vectors.sparkSession)
    given = vectors.select(named(id_col).cast("long").alias("vec_id"), named(label_col).cast("long").alias("label"),
                           unit(named(vector_col)).alias("vector"))
    usable = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    width = usable.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if width is None:
        return _labelled(given.select("vec_id"), None, 1.0)
    clean = materialise(
        usable.where(F.size("vector") == width[0]).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("v"))
        .select("vec_id", "v.*"), "unit-vectors",
    )
    # Equal vectors are one node, named by the smallest id; their cosine is 1.
    nodes = materialise(clean.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")), "distinct-vectors")
    many = nodes.where("copies > 1").select("label", "vector", F.col("vec_id").alias("node"))
    same = materialise(clean.join(many, ["label", "vector"]).select("vec_id", "node"), "equal-vectors")
    n = nodes.count()
    sample = _matrix(nodes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vector").toArrow().column("vector").combine_chunks())
    centres = fit_centres(sample, max(1, min(MOST_CENTRES, len(sample), n // CENTRE_ROWS)))
    members = materialise(nodes.mapInArrow(_assign(centres), MEMBER), "shard-members")
    edges = (
        members.groupBy("label", "centre").applyInPandas(_build, EDGES)
        .groupBy("label", "vec_id").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))
    )
    edges = materialise(edges, "adjacency")
    # A large shard is searched by several tasks, each with all of it and its own queries.
    sizes = members.groupBy("label", "centre").agg(F.ceil(F.count(F.lit(1)) / TASK_QUERIES).alias("tasks"))
    searched = (
        members.join(edges, ["label", "vec_id"]).join(materialise(sizes, "shard-sizes"), ["label", "centre"])
        .withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)))
        .withColumn("mine", F.pmod(F.xxhash64("vec_id"), F.col("tasks")) == F.col("task")).drop("tasks")
    )
    found = materialise(searched.groupBy("label", "centre", "task").applyInPandas(_search(threshold), FOUND), "found-links")
    linked = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    own = nodes.join(linked, "vec_id", "left").select(F.col("vec_id").alias("node"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    met = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    own = materialise(own.join(met, "node", "left").select("node", "n_links", F.coalesce("component", "node").alias("component")), "node-links")
    counts = materialise(
        own.withColumnRenamed("node", "vec_id").join(same, "vec_id", "left_anti")
        .unionByName(same.join(own, "node").select("vec_id", "n_links", "component")), "link-counts",
    )
    audited = clean.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(AUDITED).toArrow()
    truth = clean.mapInArrow(_audit(audited, threshold), "vec_id long, true_links long").groupBy("vec_id").agg(F.sum("true_links").alias("true_links"))
    sums = truth.join(counts, "vec_id", "left").agg(
        F.sum(F.least("true_links", F.coalesce("n_links", F.lit(0)))), F.sum("true_links")
    ).first()
    recall = float(sums[0]) / float(sums[1]) if sums[1] else 1.0
    return _labelled(given.select("vec_id"), counts, recall)


def _labelled(rows: DataFrame, counts: DataFrame | None, recall: float) -> DataFrame:
    if counts is not None:
        rows = rows.join(counts, "vec_id", "left")
    else:
        rows = rows.withColumns({"n_links": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"), F.lit(recall).alias("audit_recall"),
    )
