"""Text quality by votes of the nearest labelled documents in a latent semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import WordHashes, held_out, map_rows, name, ready, slices, type_of, utf8, word_bounds
from siltstone.llm.grams import gram_counts

#: Byte n-grams, case and signs included, and the number of buckets as a power of two.
GRAM, BITS = 3, 12
DIMENSIONS = 48
#: At most so many labelled documents per label are learned from, those with the smallest hash of their id.
PER_LABEL = 1500
NEIGHBOURS = 25
#: Documents compared with all labelled vectors at once.
BLOCK = 256
#: Weight of the shares of repetition beside the n-grams, whose row has length 1.
STYLE = 1.5
#: From this score on a document is taken to be good.
GOOD = 0.3


_HASHES = WordHashes(31)


def repetition(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row, in thousandths: words equal to the word before, and lines that repeat an earlier line."""
    starts, ends, rows = word_bounds(data, offsets)
    words = _HASHES(data, starts, ends)
    same = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.append(False, words[1:] == words[:-1])[: len(words)])))
    out = np.zeros((len(rows) - 1, 2), np.float32)
    for k, (a, b) in enumerate(zip(rows[:-1], rows[1:])):
        if b - a > 1:
            out[k, 0] = 1000 * (same[b] - same[a + 1]) // (b - a - 1)
    breaks = np.flatnonzero(data == 10)
    lines = _HASHES(
        data, np.sort(np.concatenate((offsets[:-1], breaks + 1))), np.sort(np.concatenate((breaks, offsets[1:])))
    )
    first = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b - a > 1:
            out[k, 1] = 1000 * (b - a - len(np.unique(lines[a:b]))) // (b - a)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of n-grams, then the shares of repetition, of each row."""
    return np.hstack((gram_counts(data, offsets, GRAM, BITS), repetition(data, offsets)))


def term_weights(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped term frequencies times inverse document frequencies, rows of length 1 (or 0), and style."""
    rows = np.log1p(found[:, : len(idf)]) * idf
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return np.hstack((rows, found[:, len(idf) :] * np.float32(STYLE / 1000)))


@dataclass
class QualityModel:
    """The space and the labelled vectors in it, both of bounded size."""

    idf: np.ndarray
    axes: np.ndarray  # features x dimensions
    vectors: np.ndarray  # labelled documents x dimensions, unit length
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        rows = term_weights(counts, self.idf) @ self.axes
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def votes(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by cosine; 0.5 without any."""
        out = np.full(len(rows), 0.5)
        if not len(self.labels):
            return out
        n = min(NEIGHBOURS, len(self.labels))
        for k in range(0, len(rows), BLOCK):
            cosine = rows[k : k + BLOCK] @ self.vectors.T
            top = np.argpartition(-cosine, n - 1, axis=1)[:, :n]
            weight = np.maximum(np.take_along_axis(cosine, top, axis=1), 0).astype(np.float64)
            total = weight.sum(1)
            share = (weight * self.labels[top]).sum(1) / np.maximum(total, 1e-12)
            out[k : k + BLOCK] = np.where(total > 1e-9, share, 0.5)
        return np.clip(out, 0, 1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores of whole texts; a text without n-grams has no neighbours and scores 0.5."""
        found = []
        for _, part, bounds in slices(data, offsets):
            for k in range(0, len(bounds) - 1, BLOCK):
                cut = bounds[k : k + BLOCK + 1]
                counts = features(part[cut[0] : cut[-1]], cut - cut[0])
                found.append(self.votes(self.project(counts)))
        return np.concatenate(found) if found else np.zeros(0)


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(label, text) of at most PER_LABEL ids per label, none of them held out, with one text each: of several
    rows of an id the text with the smallest hash."""
    own = docs.select(name(doc_id).alias("id"), name(text).alias("text")).where(~held_out(name(doc_id)))
    marks = labels.select(name(doc_id).alias("id_"), name(label).cast("int").alias("label"))
    parts = []
    for value in (0, 1):
        some = marks.where(F.col("label") == value).distinct()
        # The smallest hashes are found by id alone, so few texts are joined.
        some = some.where(~held_out(F.col("id_"))).orderBy(F.xxhash64("id_"), "id_").limit(PER_LABEL)
        parts.append(some)
    few = parts[0].union(parts[1])
    texts = own.join(few, F.col("id") == F.col("id_")).where(F.col("text").isNotNull())
    one = texts.groupBy("label", "id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("label", "text")


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> QualityModel:
    """Fit the space on a bounded balanced sample; the driver gets its n-gram counts, 4,096 per document."""
    ready(docs.sparkSession)

    def count(batches):
        for batch in batches:
            counts = [features(part, bounds) for _, part, bounds in slices(*utf8(batch.column("text")))]
            flat = [np.minimum(row, 65_535).astype(np.uint16).tobytes() for block in counts for row in block]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(flat, pa.binary())], ["label", "counts"])

    rows = training_rows(docs, labels, doc_id, text, label).mapInArrow(count, "label int, counts binary").collect()
    size = 1 << BITS
    if not rows:
        return QualityModel(np.ones(size), np.zeros((size + 2, 1)), np.zeros((0, 1)), np.zeros(0))
    rows.sort(key=lambda r: (r.label, r.counts))
    counts = np.stack([np.frombuffer(r.counts, np.uint16) for r in rows]).astype(np.float32)
    idf = (np.log((1 + len(rows)) / (1 + (counts[:, :size] > 0).sum(0))) + 1).astype(np.float32)
    weighted = term_weights(counts, idf)
    axes = leading_axes(weighted, DIMENSIONS)
    model = QualityModel(idf, axes, np.zeros((0, 1)), np.array([r.label for r in rows], np.float64))
    model.vectors = model.project(counts)
    return model


def leading_axes(rows: np.ndarray, n: int) -> np.ndarray:
    """The first n right singular vectors, by subspace iteration."""
    n = min(n, *rows.shape)
    axes = np.random.default_rng(3).standard_normal((rows.shape[1], n)).astype(np.float32)
    for _ in range(6):
        axes, _ = np.linalg.qr(rows.T @ (rows @ axes))
    return axes.astype(np.float32)


def scored(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) per row, by exact cosines with every labelled vector.

    NULL, empty and shorter than three bytes: score 0.5. Only the text decides. Repeated rows give
    repeated results; ids may be NULL (then not held out).
    """
    spark = ready(docs.sparkSession)
    kind = type_of(docs, doc_id)
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            found = shared.value.scores(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(found, pa.float64())],
                ["id", "held_out", "score"],
            )

    own = docs.select(
        name(doc_id).alias("id"), held_out(name(doc_id)).alias("held_out"), name(text).alias("text")
    )
    out = own.mapInArrow(score, f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int")).withColumnRenamed("id", doc_id)


def good_only(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are taken to be good, in one pass."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(batches):
        for batch in batches:
            good = shared.value.scores(*utf8(batch.column(at))) >= GOOD
            yield batch.filter(pa.array(good, pa.bool_()))

    return map_rows(docs, keep, docs.columns)
