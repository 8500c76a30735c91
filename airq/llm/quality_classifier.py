"""Quality of whole texts by votes of their nearest labelled neighbours.

Terms are hashed character trigrams and a few terms for a text's shape (share of repeated
words and lines, of marks, digits and capitals, in steps). A bounded sample of labelled rows gives the
terms' weights and, by a singular value decomposition, a latent space; the sample's
vectors are sent to every task (at most about SAMPLE x LATENT numbers). For every document
all cosines are computed exactly, block by block, and the nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.chargrams import code_points, counted, hashed, unit_rows
from airq.llm.tables import held_out
from airq.llm.words import slices

SAMPLE, LATENT, NEIGHBOURS, BLOCK = 4000, 48, 15, 1024
DIMS, STEPS = 1024, 8
OUT = "doc_id long, held_out boolean, score double, predicted int"

_KIND = np.zeros(128, dtype=np.uint8)  # of ASCII characters: 1 mark, 2 digit, 3 capital
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-"]] = 1
_KIND[48:58] = 2
_KIND[65:91] = 3


def shape(text: str, points: np.ndarray) -> list[float]:
    """Shares in 0..1: repeated words, repeated lines, marks, digits, capitals; and the length on a log scale."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    kinds = np.bincount(_KIND[np.minimum(points, 127)], minlength=4) if len(points) else np.zeros(4)
    n = max(1, len(points))
    return [
        1 - len(set(words)) / max(1, len(words)), 1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, 8 * kinds[1] / n), min(1.0, 8 * kinds[2] / n), min(1.0, 2 * kinds[3] / n), min(1.0, np.log10(1 + len(words)) / 5),
    ]


def terms(texts: list[str]) -> np.ndarray:
    """Rows of term values: square roots of trigram counts as a unit vector, then the shape's steps, linear between two steps."""
    parts, shapes = [], []
    for t in texts:
        p = code_points(t)
        parts.append(hashed(p, 3, DIMS))
        shapes.append(shape(t, p))
    grams = unit_rows(np.sqrt(counted(parts, DIMS)))
    at = np.array(shapes, dtype=np.float32) * (STEPS - 1)
    low = np.minimum(at.astype(int), STEPS - 2)
    steps = np.zeros((len(texts), at.shape[1], STEPS), dtype=np.float32)
    rows, cols = np.indices(at.shape)
    steps[rows, cols, low] = 1 - (at - low)
    steps[rows, cols, low + 1] = at - low
    return np.concatenate([grams, 0.5 * steps.reshape(len(texts), -1)], axis=1)


@dataclass
class Neighbours:
    weights: np.ndarray  # of the terms
    axes: np.ndarray  # terms x latent
    vectors: np.ndarray  # labelled documents, unit rows
    labels: np.ndarray

    def latent(self, x: np.ndarray) -> np.ndarray:
        return unit_rows((x * self.weights) @ self.axes)

    def vote(self, x: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, each with its similarity above the farthest of them as weight."""
        if not len(self.labels):
            return np.full(len(x), 0.5)
        v, k = self.latent(x), min(NEIGHBOURS, len(self.labels))
        best = np.full((len(v), 0), -2.0, dtype=np.float32)
        label = np.zeros((len(v), 0), dtype=np.float32)
        for i in range(0, len(self.vectors), BLOCK):
            cos = v @ self.vectors[i : i + BLOCK].T
            best = np.concatenate([best, cos], axis=1)
            label = np.concatenate([label, np.broadcast_to(self.labels[i : i + BLOCK], cos.shape)], axis=1)
            if best.shape[1] > k:
                top = np.argpartition(-best, k - 1, axis=1)[:, :k]
                best, label = np.take_along_axis(best, top, 1), np.take_along_axis(label, top, 1)
        weight = np.maximum(best, 0) ** 4 + 1e-6
        return (weight * label).sum(axis=1) / weight.sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> Neighbours:
    if not len(x):
        return Neighbours(np.ones(x.shape[1], np.float32), np.zeros((x.shape[1], LATENT), np.float32), np.zeros((0, LATENT), np.float32), np.zeros(0, np.float32))
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    z = x * weights
    _, vectors = np.linalg.eigh((z.T @ z).astype(np.float64))
    axes = vectors[:, ::-1][:, : min(LATENT, z.shape[1])].astype(np.float32)
    return Neighbours(weights, axes, unit_rows(z @ axes), y.astype(np.float32))


def learn(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Neighbours:
    """Fits on an expected ``limit`` of labelled rows that are not held out, chosen by a hash of doc_id. A document with several labels has its lowest."""
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("quality").alias("quality"))
    n = known.count()
    own = known.filter(F.pmod(F.xxhash64("_doc"), F.lit(1 << 30)) < min(1.0, limit / max(1, n)) * (1 << 30))
    # the same filter on the documents before the join, so that only the sample's texts move
    picked = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 30)) < min(1.0, limit / max(1, n)) * (1 << 30))

    def rows(frames):
        import pyarrow as pa

        for b in frames:
            for at, texts in slices(b):
                x = terms(texts).astype(np.float32)
                yield pa.RecordBatch.from_arrays([b.column("quality").slice(at, len(texts)), pa.array([r.tobytes() for r in x], pa.binary())], ["quality", "x"])

    joined = picked.join(own, F.col("doc_id").cast("long") == F.col("_doc")).select(F.col("quality").cast("int").alias("quality"), "text")
    got = joined.mapInArrow(rows, "quality int, x binary").toPandas()
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float32).reshape(len(got), -1) if len(got) else terms([""])[:0]
    order = np.lexsort([got["x"].to_numpy(), got["quality"].to_numpy()]) if len(got) else np.zeros(0, int)
    return fit(x[order], got["quality"].to_numpy()[order])


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    NULL counts as empty; an empty text has no trigrams and is compared by its shape alone.
    Without labels every score is 0.5. A NULL ``doc_id`` is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, limit))

    def run(frames):
        import pyarrow as pa

        model = shared.value
        for b in frames:
            for at, texts in slices(b):
                s = np.clip(model.vote(terms(texts)), 0, 1).astype(float)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(texts)), b.column("held_out").slice(at, len(texts)), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text"))
    return rows.mapInArrow(run, OUT)
