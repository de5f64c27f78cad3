"""Quality by vote of the nearest labelled documents in a latent-semantic space.

A document's terms are its words and their shapes: letters, capitals and digits each folded to
one sign, punctuation kept. Terms are hashed into ``DIMS`` columns and weighted by log frequency
and rarity; a truncated SVD of labelled documents gives the latent space. The labelled vectors,
bounded by ``SAMPLE`` per label, are broadcast, and every document's cosine with all of them is a
block product. Its nearest ``NEIGHBOURS`` vote with weights that grow with similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labelled documents per label that are used at most; more are left out by a hash of their id.
SAMPLE = 2000
DIMS = 1 << 13
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 8
_BLOCK = 512
_CACHED = 200_000

_SHAPE = bytes(
    ord("A") if 65 <= c <= 90 else ord("9") if 48 <= c <= 57 else ord("a") if 97 <= c <= 122 or c >= 128 else c
    for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class _Columns(dict):
    """Hashed column of a term; forgets all when full, so memory is bounded."""

    def __init__(self, prefix: bytes, fold: bool):
        super().__init__()
        self.prefix, self.fold = prefix, fold

    def __missing__(self, term: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        folded = _RUN.sub(rb"\1", term) if self.fold else term
        column = self[term] = zlib.crc32(self.prefix + folded) % DIMS
        return column


class Terms:
    """(columns, weights) of a whole text."""

    def __init__(self):
        self.words, self.shapes = _Columns(b"w:", False), _Columns(b"s:", True)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        by_word, by_shape = Counter(words), Counter(text.translate(_SHAPE).split())
        repeated = int(10 * len(by_word) / len(words))
        columns = [self.words[w] for w in by_word]
        columns += [self.shapes[s] for s in by_shape]
        columns.append(zlib.crc32(b"distinct:%d" % repeated) % DIMS)
        counts = np.fromiter([*by_word.values(), *by_shape.values(), len(words)], np.float64, len(columns))
        used, at = np.unique(np.array(columns), return_inverse=True)
        return used, 1 + np.log(np.bincount(at, counts))


@dataclass
class Model:
    """The latent space and the labelled vectors in it; at most ``2 * SAMPLE`` rows."""

    space: np.ndarray  # DIMS x RANK, rarity included
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors of documents; zero where nothing is known of a document."""
        rows = np.stack([w @ self.space[c] for c, w in features]) if features else np.zeros((0, self.space.shape[1]))
        length = np.linalg.norm(rows, axis=1, keepdims=True)
        return (rows / np.where(length > 0, length, 1)).astype(np.float32)

    def vote(self, rows: np.ndarray) -> np.ndarray:
        """Share of the neighbours' weight that has label 1; a half for documents without terms."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        k = min(NEIGHBOURS, len(self.labels))
        cosine = rows @ self.vectors.T
        near = np.argpartition(cosine, len(self.labels) - k, axis=1)[:, -k:] if k < len(self.labels) else None
        near = np.broadcast_to(np.arange(k), (len(rows), k)) if near is None else near
        weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 1e-12, voted / np.where(total > 1e-12, total, 1), 0.5)


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK) -> Model:
    """Latent-semantic analysis of the labelled sample by randomised subspace iteration."""
    n = len(features)
    df = np.zeros(DIMS)
    for columns, _ in features:
        df[columns] += 1
    rarity = np.log((1 + n) / (1 + df)).clip(0) * (df > 1)
    rows = np.zeros((n, DIMS), dtype=np.float32)
    for row, (columns, weights) in zip(rows, features):
        row[columns] = weights * (0.1 + rarity[columns]) * (df[columns] > 1)
        row /= np.linalg.norm(row) or 1
    basis = np.random.default_rng(0).standard_normal((DIMS, rank + 16)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    axes = basis @ turn.T[:, :rank]
    model = Model(((0.1 + rarity) * (df > 1))[:, None] * axes, np.zeros((0, axes.shape[1]), np.float32), labels)
    model.vectors = model.place(features)
    return model


def _pack(text: Column) -> Column:
    """Columns and weights of a text as two binary values."""

    @F.arrow_udf("struct<columns: binary, weights: binary>")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = Terms()
        for batch in batches:
            found = [terms(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([c.astype("<i8").tobytes() for c, _ in found], pa.binary()),
                 pa.array([w.astype("<f8").tobytes() for _, w in found], pa.binary())],
                ["columns", "weights"],
            )

    return packed(text)


def labelled_sample(labels: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """(key, label) of at most ``per_label`` ids of each label 0 and 1, chosen by a hash of the id."""
    plain = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    place = F.xxhash64(key)
    # Only the lowest hashes are ranked: a few more than are wanted, whatever the number of labels. Where
    # chance leaves too few below the bound, all are ranked.
    bounds = {}
    for row in plain.groupBy(label).count().collect():
        share = min(1.0, (per_label + 8 * per_label**0.5 + 64) / row["count"])
        bounds[row[label]] = (row["count"], min((1 << 63) - 1, round(share * (1 << 64)) - (1 << 63)))
    low = F.lit(False)
    for value, (_, bound) in bounds.items():
        low = low | ((F.col(label) == value) & (place <= bound))
    found = {row[label]: row["count"] for row in plain.filter(low).groupBy(label).count().collect()}
    if all(found.get(value, 0) >= min(per_label, n) for value, (n, _) in bounds.items()):
        plain = plain.filter(low)
    order = Window.partitionBy(label).orderBy(place, key)
    return plain.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= per_label).drop("__n")


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = SAMPLE,
) -> Model:
    """A model of at most ``per_label`` documents of each label; their terms reach the driver.

    Null labels, null ids and labels other than 0 and 1 are passed over. With no labelled
    document every score is a half.
    """
    sample = labelled_sample(labels, key, label, per_label)
    rows = (
        docs.select(key, text).join(F.broadcast(sample), key)
        .select(key, label, _pack(F.col(text)).alias("t")).select(key, label, "t.columns", "t.weights")
        .toPandas().sort_values([key, label, "columns", "weights"]).drop_duplicates(key)
    )
    features = [(np.frombuffer(c, "<i8"), np.frombuffer(w, "<f8")) for c, w in zip(rows["columns"], rows["weights"])]
    if not features:
        return Model(np.zeros((DIMS, 1)), np.zeros((0, 1), np.float32), np.zeros(0))
    return fit(features, rows[label].to_numpy().astype(np.float64))


def quality_score(spark, model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1. Null texts are empty; texts without a known term score 0.5."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, known = Terms(), shared.value
        for batch in batches:
            scores = []
            for start in range(0, len(batch), _BLOCK):
                block = batch.slice(start, _BLOCK)
                rows = known.place([terms(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in block])
                scores.append(known.vote(rows))
            yield pa.array(np.concatenate(scores) if scores else np.zeros(0))

    return score(text)
