"""Quality scores by nearest-neighbour votes among labelled latent-semantic vectors.

A text becomes counts of terms of two kinds: hashed lower-case words, and form terms (trigrams of character classes,
and how each word relates to the one before: equal, sorting behind it, sorting before it). Counts are turned into
square roots of shares, weighted by inverse document frequency, and projected on the leading singular vectors of a
labelled sample. Every document is compared by exact cosine with all labelled vectors, block by block, and its
nearest ones vote with their similarity.

Only the labelled vectors and the projection are broadcast. Their size is fixed by the parameters below.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, slices, utf8

WORDS = 4096
CLASSES = 16
RELATIONS = 3
TERMS = WORDS + CLASSES ** 3 + RELATIONS
#: Labelled documents that are learnt from: at most so many of each label, by smallest hash of the id.
PER_LABEL = 1000
DIMENSIONS = 96
NEIGHBOURS = 15
#: Similarities are raised to this power before they vote.
SHARPNESS = 8
#: Weight of the base rate among the votes; it decides where nothing is alike, as for empty texts.
PRIOR_WEIGHT = 1e-3
THRESHOLD = 0.3
BLOCK = 512


def _classes() -> np.ndarray:
    """Class of each byte: letters, digits, blanks, sentence marks, other marks, bytes beyond ASCII."""
    of = np.full(256, 12, np.uint16)
    groups = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".", b",;:", b"!?",
              b"#*$%&", b"|<>{}[]", b"\"'()-", b"_/\\=+~^@`"]
    for number, group in enumerate(groups):
        of[np.frombuffer(group, np.uint8)] = number
    of[128:] = 13
    return of


_CLASS = _classes()


def term_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and their shares within their kind, for the whole text."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    tally: Counter[int] = Counter()
    for word, n in Counter(text.lower().split()).items():
        tally[zlib.crc32(word) % WORDS] += n
    kind = _CLASS[np.frombuffer(text, np.uint8)]
    shapes = np.bincount((kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:], minlength=CLASSES ** 3)
    seen = np.flatnonzero(shapes)
    low = [w.lower() for w in words]
    same = sum(map(bytes.__eq__, low[1:], low))
    behind = sum(map(bytes.__gt__, low[1:], low))
    relation = np.array([same, behind, len(low) - 1 - same - behind])
    ids = np.concatenate([np.fromiter(tally, np.int32, len(tally)), WORDS + seen,
                          WORDS + CLASSES ** 3 + np.arange(RELATIONS)]).astype(np.int32)
    shares = np.concatenate([np.fromiter(tally.values(), np.float64, len(tally)) / len(words),
                             shapes[seen] / max(1, shapes.sum()), relation / max(1, len(words) - 1)])
    return ids, shares.astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray  # per term
    projection: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled documents x dimensions, of length one
    labels: np.ndarray
    base_rate: float

    def embed(self, text: bytes) -> np.ndarray:
        ids, shares = term_counts(text)
        vector = (np.sqrt(shares) * self.weights[ids]) @ self.projection[ids]
        norm = np.linalg.norm(vector)
        return vector / norm if norm > 0 else np.zeros(self.projection.shape[1], np.float32)

    def scores(self, texts: list[bytes], neighbours: int) -> np.ndarray:
        out = np.empty(len(texts))
        for at in range(0, len(texts), BLOCK):
            block = np.stack([self.embed(t) for t in texts[at:at + BLOCK]]).astype(np.float32)
            cosine = block @ self.vectors.T
            k = min(neighbours, cosine.shape[1])
            # ties at the last place: all neighbours as near as it take part
            floor = -np.partition(-cosine, k - 1, axis=1)[:, k - 1:k]
            votes = np.where(cosine >= floor, np.maximum(cosine, 0), 0).astype(np.float64) ** SHARPNESS
            out[at:at + BLOCK] = ((votes @ self.labels + PRIOR_WEIGHT * self.base_rate)
                                  / (votes.sum(1) + PRIOR_WEIGHT))
        return out


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text is divisible by 5. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """(text, label) of at most `per_label` documents of each label 0 and 1, those with the smallest hash of the id.

    Only ids and labels are compared first; the chosen ids, 2 * per_label at most, are then broadcast to the texts.
    """
    marks = (labels.select("doc_id", F.col(label).alias("label"))
             .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).dropDuplicates()
             .join(docs.filter(F.col("text").isNotNull()).select("doc_id").distinct(), "doc_id", "left_semi"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (marks.filter(F.col("label") == 0).orderBy(*order).limit(per_label)
              .unionByName(marks.filter(F.col("label") == 1).orderBy(*order).limit(per_label)))
    return (docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
            .dropDuplicates(["doc_id", "label"]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL,
        dimensions: int = DIMENSIONS) -> Model:
    """Learn from the documents that `labels` marks with 0 or 1; other marks and null texts are left out.

    The driver gets at most 2 * per_label lists of term shares, and the model has a fixed size. Without any labelled
    document one neutral vector stands in, and all scores are 0.5.
    """
    sample = labelled_sample(docs, labels, label, per_label)
    totals = {int(r.label): r["count"] for r in labels.select(F.col(label).alias("label"), "doc_id")
              .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("label").count().collect()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [term_counts(t) for t in utf8(batch.column(0))]
        return pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array([i.tolist() for i, _ in found], pa.list_(pa.int32())),
                                           pa.array([s.tolist() for _, s in found], pa.list_(pa.float32()))],
                                          ["label", "ids", "shares"])

    learnt = map_batches(sample.select("text", "label"), work, "label int, ids array<int>, shares array<float>").collect()
    if not learnt:
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((1, 1), np.float32),
                     np.full(1, 0.5), 0.5)
    counts = np.zeros((len(learnt), TERMS), np.float32)
    for row, doc in enumerate(learnt):
        counts[row, doc.ids] = np.sqrt(np.array(doc.shares, np.float32))
    weights = np.log((1 + len(learnt)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    counts *= weights
    # right singular vectors by way of the small matrix of products between documents
    values, left = np.linalg.eigh((counts @ counts.T).astype(np.float64))
    keep = np.flatnonzero(values > 1e-9 * max(values[-1], 1e-300))[::-1][:dimensions]
    if not len(keep):  # only empty texts
        keep = np.array([len(values) - 1])
    projection = (counts.T @ (left[:, keep] / np.sqrt(np.maximum(values[keep], 1e-12))).astype(np.float32)).astype(np.float32)
    vectors = counts @ projection
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Model(weights, projection, vectors, np.array([d.label for d in learnt], np.float64),
                 totals.get(1, 0) / max(1, sum(totals.values())))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
          neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, score) for every row: the share of votes for label 1. Null counts as an empty text.

    Empty texts are like nothing and get the base rate of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(utf8(batch.column(1)), neighbours))],
                                          ["doc_id", "score"])

    return map_batches(docs.select(doc_id, text), work,
                       f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")



def kept(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD,
         neighbours: int = NEIGHBOURS) -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(shared.value.scores(utf8(batch.column(place)), neighbours) >= threshold))

    return docs.mapInArrow(work, docs.schema)
