"""Quality classifier by co-training of a text view and a metadata view.

Two logistic models see different columns of a document: one its text, one what is
known about it (language, source, length). In each round a model labels all
documents without a label that it is sure of, and the other one learns from them.
Held-out labelled rows then calibrate both views and weigh them in one probability.

Only the sample of labelled rows is bounded. Pseudo-labels are not gathered: each
task sums what its documents add to a Newton step (slope and curvature, per class),
the sums are added in groups of tasks, and the driver makes the step. The
pseudo-labels of a class together weigh as much as its labelled rows at most, at
every size of the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import free_name, materialise, named, ship, sub_batches

#: Labelled rows that models are fitted on at most.
LABELLED_ROWS = 10_000
#: Rounds, and passes over the unlabelled documents (Newton steps) in each.
ROUNDS = 5
STEPS = 2
#: How sure a view must be of a document to pass its label on.
SURE = 0.98
#: Documents with a lower probability of good quality are rejected.
ACCEPT = 0.5
#: Every fifth labelled row is held out for calibration.
HELD_OUT = 5
#: Hash buckets of each metadata column, and of the runs of four bytes of a text.
BUCKETS = 32
GRAM_BUCKETS = 64
RIDGE = 1e-2
#: No weight moves further in one Newton step.
FARTHEST = 3.0
#: Groups in which the sums of tasks are added up before they reach the driver.
SUM_GROUPS = 64
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 20


def _gram_shares(raw: np.ndarray) -> np.ndarray:
    """Square roots of the shares of the text's runs of four bytes in each hash bucket."""
    counts = np.zeros(GRAM_BUCKETS)
    for start in range(0, len(raw) - 3, PIECE):
        x = raw[start : start + PIECE + 3].astype(np.uint32)
        runs = x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24
        buckets = (runs * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BUCKETS.bit_length() + 1)
        counts += np.bincount(buckets, minlength=GRAM_BUCKETS)
    return np.sqrt(counts / max(1.0, counts.sum()))


def content_features(text: str) -> list[float]:
    """Shares of kinds of characters, words, lines and hashed runs of four bytes; all 0 for an empty text."""
    raw = text.encode()
    codes = np.frombuffer(raw, np.uint8)
    counts = np.bincount(codes, minlength=256)
    total = max(1, len(raw))
    lower, upper = int(counts[97:123].sum()), int(counts[65:91].sum())
    digits, beyond = int(counts[48:58].sum()), int(counts[128:].sum())
    blanks = int(counts[9:14].sum() + counts[32])
    quiet = int(sum(counts[ord(c)] for c in ".,;:'\"-()?"))
    symbols = int(counts[:128].sum()) - lower - upper - digits - blanks - quiet
    words = raw.split()
    n = max(1, len(words))
    repeats = sum(map(eq, words, words[1:])) if len(words) > 1 else 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, lower + upper + beyond)
    shares = [
        upper / letters, digits / total, symbols / total, quiet / total, beyond / total,
        int(counts[ord("|")]) / n, int(counts[ord("!")]) / n, repeats / n,
        1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(words)) / n,
    ]
    return [*shares, *[math.sqrt(s) for s in shares], math.log1p(len(words)), len(raw) / n / 10, *_gram_shares(codes).tolist()]


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """One-hot hash buckets of language and source, and the length's logarithm; null is a value."""
    out = [0.0] * (2 * BUCKETS + 2)
    out[zlib.crc32((lang or "\0").encode()) % BUCKETS] = 1.0
    out[BUCKETS + zlib.crc32((source or "\0").encode()) % BUCKETS] = 1.0
    size = math.log1p(max(0, n_chars or 0))
    out[-2:] = [size, size * size / 10]
    return out


#: What rows add to a Newton step: their number, slope and curvature.
Sums = tuple[float, np.ndarray, np.ndarray]


@dataclass
class Logistic:
    """Ridge logistic regression over standardised columns, by Newton's method."""

    middle: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1.0
        self.weights = np.zeros(x.shape[1] + 1)
        for _ in range(50):
            if self.step([(1.0, self.sums(x, y))]) < 1e-6:
                break
        return self

    def sums(self, x: np.ndarray, y: np.ndarray | float) -> Sums:
        z = self._design(x)
        p = _probability(np.clip(z @ self.weights, -30, 30))
        return float(len(x)), z.T @ (p - y), (z * (p * (1 - p))[:, None]).T @ z

    def step(self, parts: list[tuple[float, Sums]]) -> float:
        """Move by one Newton step over weighted sums; how far the weights moved at most."""
        rows = sum(weight * n for weight, (n, _, _) in parts)
        ridge = np.full(len(self.weights), RIDGE * rows)
        ridge[0] = 1e-6 * rows
        slope = sum(weight * g for weight, (_, g, _) in parts) + ridge * self.weights
        curve = sum(weight * h for weight, (_, _, h) in parts) + np.diag(ridge + 1e-9)
        move = np.linalg.solve(curve, slope)
        farthest = float(np.abs(move).max())
        self.weights = self.weights - move * min(1.0, FARTHEST / max(farthest, FARTHEST))
        return farthest

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), (x - self.middle) / self.scale])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.weights, -30, 30)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


@dataclass
class CoTrained:
    """Both views and what combines them; without both classes only the share of good rows."""

    content: Logistic | None = None
    metadata: Logistic | None = None
    calibrators: tuple[Logistic, Logistic] | None = None
    combiner: Logistic | None = None
    share: float = 1.0

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Columns: the text view's, the metadata view's and the combined probability."""
        if self.content is None or self.metadata is None or self.calibrators is None or self.combiner is None:
            return np.full((len(content), 3), self.share)
        views = np.column_stack([
            self.calibrators[0].logit(self.content.logit(content)[:, None]),
            self.calibrators[1].logit(self.metadata.logit(metadata)[:, None]),
        ])
        return _probability(np.column_stack([views, self.combiner.logit(views)]))


Models = tuple[Logistic, Logistic]


def _taught(content: np.ndarray, metadata: np.ndarray, teachers: Models, learners: Models) -> np.ndarray:
    """For each view and class, the sums over rows that the other view is sure of, as one vector."""
    views, out = (content, metadata), []
    for k in (0, 1):
        p = _probability(teachers[1 - k].logit(views[1 - k]))
        for label, rows in ((0.0, 1 - p >= SURE), (1.0, p >= SURE)):
            n, slope, curve = learners[k].sums(views[k][rows], label)
            out += [np.array([n]), slope, curve.ravel()]
    return np.concatenate(out)


def _unpacked(vector: np.ndarray, learners: Models) -> list[list[Sums]]:
    """The sums of ``_taught`` by view and class."""
    out, at = [], 0
    for model in learners:
        d, found = len(model.weights), []
        for _ in range(2):
            found.append((float(vector[at]), vector[at + 1 : at + 1 + d], vector[at + 1 + d : at + 1 + d + d * d].reshape(d, d)))
            at += 1 + d + d * d
        out.append(found)
    return out


def train(content: np.ndarray, metadata: np.ndarray, label: np.ndarray,
          taught: Callable[[Models, Models], np.ndarray], rounds: int = ROUNDS) -> CoTrained:
    """Fit both views on labelled rows (1 is good, a fixed order) and on what ``taught`` sums over all others."""
    if len(label) == 0 or label.min() == label.max():
        return CoTrained(share=float(label.mean()) if len(label) else 1.0)
    held = np.arange(len(label)) % HELD_OUT == 0
    if label[held].min() == label[held].max() or label[~held].min() == label[~held].max():
        held = np.zeros(len(label), bool)  # too few rows to hold any out
    views, own = (content, metadata), label[~held]
    models = (Logistic().fit(content[~held], own), Logistic().fit(metadata[~held], own))
    in_class = [float((own == c).sum()) for c in (0.0, 1.0)]
    for _ in range(rounds):
        teachers = tuple(Logistic(m.middle, m.scale, m.weights) for m in models)
        for _ in range(STEPS):
            sums = _unpacked(taught(teachers, models), models)
            if not any(n for found in sums for n, _, _ in found):
                break
            for model, x, found in zip(models, views, sums, strict=True):
                parts = [(min(1.0, most / s[0]), s) for most, s in zip(in_class, found, strict=True) if s[0]]
                model.step([(1.0, model.sums(x[~held], own)), *parts])
    judge = held if held.any() else ~held
    logits = [m.logit(x[judge])[:, None] for m, x in zip(models, views, strict=True)]
    calibrators = tuple(Logistic().fit(z, label[judge]) for z in logits)
    calibrated = np.column_stack([c.logit(z) for c, z in zip(calibrators, logits, strict=True)])
    return CoTrained(models[0], models[1], calibrators, Logistic().fit(calibrated, label[judge]))


def co_train(content: np.ndarray, metadata: np.ndarray, label: np.ndarray,
             pool_content: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS) -> CoTrained:
    """``train`` with the unlabelled rows at hand."""
    return train(content, metadata, label, lambda *models: _taught(pool_content, pool_metadata, *models), rounds)


def _matrices(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The stored numbers of both views, a row per document."""
    return [np.array([np.frombuffer(v, np.float32) for v in batch.column(c).to_pylist()], np.float64) for c in ("content", "metadata")]


def _taught_by(pool: DataFrame, teachers: Models, learners: Models) -> np.ndarray:
    """``_taught`` over a table: a vector for each task, then for each group of tasks, in a fixed order."""
    size = sum(2 * (1 + len(m.weights) + len(m.weights) ** 2) for m in learners)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += _taught(*_matrices(batch), teachers, learners)
        yield row(TaskContext.get().partitionId(), total)

    def row(part: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    def of_group(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([row(rows.column("part")[0].as_py() % SUM_GROUPS, added(rows))])

    def added(rows: pa.Table) -> np.ndarray:
        ordered = rows.sort_by("part").column("sums")
        return sum((np.frombuffer(v.as_buffer(), np.float64) for v in ordered), np.zeros(size))

    kind = "part int, sums binary"
    parts = pool.select("content", "metadata").mapInArrow(of_task, kind)
    return added(parts.groupBy((F.col("part") % SUM_GROUPS).alias("of")).applyInArrow(of_group, kind).toArrow())


def view_table(docs: DataFrame) -> DataFrame:
    """doc_id and the numbers of both views of every row, written."""
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
                       F.col("n_chars").cast("long").alias("n_chars"))
    return materialise(slim.mapInArrow(_view_rows, "doc_id long, content binary, metadata binary"), "views")


def fit(views: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> CoTrained:
    """Fit on at most ``labelled_rows`` labelled rows and all others of a ``view_table``.

    The sample is drawn by a hash of the id from the labels that have a document; it is
    broadcast and comes to the driver (two short rows of numbers each). All other rows
    take part without labels, those without id or beyond the sample too. Null labels
    are ignored; an id with several labels takes the majority, good on a tie, and one
    with several rows counts once, with the smallest. If the rows held out, or those
    left, are of one class, none are held out and the views are calibrated on the rows
    they were fitted on. An empty table, or labels of one
    class only, give the share of good labels (1 without labels) to every row.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    )
    with_rows = known.join(views.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = materialise(with_rows.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(labelled_rows), "labelled")
    rows = (
        views.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id").agg(F.max("good").alias("good"), F.min(F.struct("content", "metadata")).alias("row"))
        .select("doc_id", "good", "row.content", "row.metadata").toArrow().sort_by("doc_id").combine_chunks()
    )
    if rows.num_rows == 0:
        return CoTrained()
    content, metadata = _matrices(rows.to_batches()[0])
    pool = views.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti")
    label = rows.column("good").to_numpy().astype(float)
    return train(content, metadata, label, lambda *models: _taught_by(pool, *models))


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Numbers of both views, a row per document, rounded as they are stored."""
    text, lang, source, n = (batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
    rows = [content_features(t or "") for t in text], [metadata_features(*x) for x in zip(lang, source, n, strict=True)]
    return [np.array(r, np.float32) for r in rows]


def _view_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sub_batches(batches):
        stored = [pa.array([x.tobytes() for x in view], pa.binary()) for view in _views(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *stored], ["doc_id", "content", "metadata"])


def with_scores(docs: DataFrame, model: CoTrained, names: tuple[str, str, str]) -> DataFrame:
    """``docs`` with three columns more: the two views' probabilities and the combined one.

    Null texts count as empty, null metadata is a value of its own; rows are scored one
    by one, so repeated rows get the same scores. There is no shuffle.
    """
    schema = StructType([*docs.schema.fields, *[StructField(n, DoubleType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            if batch.num_rows:
                yield _scored(batch, model, [v.astype(float) for v in _views(batch)], names)

    return docs.mapInArrow(run, schema)


def _scored(batch: pa.RecordBatch, model: CoTrained, views: list[np.ndarray], names: tuple[str, ...]) -> pa.RecordBatch:
    p = model.scores(*views)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *[pa.array(np.ascontiguousarray(p[:, k])) for k in range(3)]], [*batch.schema.names, *names]
    )


def quality_scores(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, content_score, metadata_score, score (probability of good) and kept of every row.

    Rows are scored as by ``with_scores``; an empty table gives no rows.
    """
    names = ("content_score", "metadata_score", "score")
    views = view_table(docs)
    model = fit(views, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _scored(batch.select(["doc_id"]), model, _matrices(batch), names)

    scored = views.mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double")
    return scored.withColumn("kept", F.col("score") >= accept)


def drop_low_quality(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` with their columns that the classifier accepts."""
    names = tuple(free_name(docs, n) for n in ("view_text", "view_metadata", "quality_probability"))
    scored = with_scores(docs, fit(view_table(docs), labels), names)
    return scored.where(F.col(names[2]) >= accept).select([named(c) for c in docs.columns])
