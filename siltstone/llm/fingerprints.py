"""Bottom-k sketches of word shingles: mergeable fingerprints that estimate overlap."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import LOWER, WordHashes, mixed, name, ready, slices, type_of, utf8, word_bounds

#: Hashes lie in 0..2**63-1, so they sort alike as signed and unsigned numbers.
SPAN = 2.0**63
K = 256


class Sketcher:
    """The k smallest distinct hashes of the shingles of texts, words apart at ASCII white space, A-Z as a-z.

    A text of fewer words than a shingle has one shingle, all its words; a text without words has none.
    """

    def __init__(self, k: int = K, shingle: int = 5):
        self.k, self.shingle = k, shingle
        self.words = WordHashes(21)
        self.weights = np.random.default_rng(22).integers(0, 2**62, (shingle + 1, shingle), dtype=np.uint64) * 2 + 1

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [s for _, part, bounds in slices(data, offsets) for s in self.of_slice(LOWER[part], bounds)]

    def of_slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        starts, ends, rows = word_bounds(data, offsets)
        word = mixed(self.words(data, starts, ends))
        n = self.shingle
        total = np.zeros(max(len(word) - n + 1, 0), np.uint64)
        for j in range(n):
            total += word[j : j + len(total)] * self.weights[n][j]
        full = mixed(total) >> np.uint64(1)
        found = []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            if b - a >= n:
                found.append(self.least(full[a : b - n + 1]))
            else:
                whole = (word[a:b] * self.weights[b - a][: b - a]).sum(dtype=np.uint64)
                found.append((mixed(np.array([whole])) >> np.uint64(1))[: b - a])
        return found

    def least(self, hashes: np.ndarray) -> np.ndarray:
        if len(hashes) > 16 * self.k:
            few = np.unique(np.partition(hashes, 4 * self.k)[: 4 * self.k])
            if len(few) >= self.k:
                return few[: self.k]
        return np.unique(hashes)[: self.k]


def text_of(sketch: np.ndarray) -> str:
    """A sketch as text: base64 of its hashes, ascending, big-endian."""
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def sketch_of(text: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text or ""), ">u8").astype(np.uint64)


def union(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts together, from their sketches alone."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of common shingles among all, estimated; 1 for two empty texts. Exact for up to k shingles."""
    both = np.sort(np.concatenate((a, b)))
    again = np.concatenate((both[1:] == both[:-1], [False])) if len(both) else np.zeros(0, bool)
    kept = np.cumsum(~again) <= k  # a hash counts where it stands last
    n = int((kept & ~again).sum())
    return float((again[:-1] & kept[1:]).sum() / n) if n else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Number of different shingles: exact below k, else from the k-th smallest hash."""
    return float(len(a)) if len(a) < k else (k - 1) * SPAN / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the shingles of a that b has, estimated; 1 for an empty a."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(union(a, b, k), k) / distinct(a, k))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, shingle: int = 5) -> DataFrame:
    """(id, fingerprint, n_shingles) per row. NULL text: empty. Ids may be NULL or repeat."""
    ready(docs.sparkSession)
    kind = type_of(docs, doc_id)

    def compute(batches):
        sketcher = Sketcher(k, shingle)
        for batch in batches:
            found = sketcher(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([text_of(s) for s in found], pa.string()),
                    pa.array([distinct(s, k) for s in found], pa.float64()),
                ],
                ["id", "fingerprint", "n_shingles"],
            )

    own = docs.select(name(doc_id).alias("id"), name(text).alias("text"))
    out = own.mapInArrow(compute, f"id {kind}, fingerprint string, n_shingles double")
    return out.withColumnRenamed("id", doc_id)


def merged(parts: DataFrame, key: str, fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """(key, fingerprint) of parts together. Each task keeps k hashes of a key, however many parts it has."""
    ready(parts.sparkSession)
    kind = type_of(parts, key)

    def apart(batches):
        for batch in batches:
            sketches = [sketch_of(x) for x in batch.column("f").to_pylist()]
            rows = np.repeat(np.arange(len(sketches)), [max(len(s), 1) for s in sketches])
            hashes = [h for s in sketches for h in (s.tolist() or [None])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), pa.array(hashes, pa.int64())], ["id", "h"]
            )

    def together(batches):
        for batch in batches:
            found = [text_of(np.array(x, np.uint64)) for x in batch.column("hs").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], ["id", "fingerprint"])

    own = parts.select(name(key).alias("id"), name(fingerprint).alias("f"))
    hashes = own.mapInArrow(apart, f"id {kind}, h bigint").distinct()
    first = Window.partitionBy("id").orderBy(F.col("h").asc_nulls_last())
    few = hashes.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    lists = few.groupBy("id").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    return lists.mapInArrow(together, f"id {kind}, fingerprint string").withColumnRenamed("id", key)


def beside_next(docs: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """(bucket, ghost, id, text) by descending id within partitions that hold whole buckets.

    Buckets are ranges of ids. Each ends with a ghost: the rows that come next, first those of the next
    bucket, and after the last bucket those of the first. So every row that is no ghost has its successor
    right behind it, and nothing is ordered in one place. Only cuts between buckets and the largest id of
    each reach the driver. NULL ids come last; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    own = docs.select(name(doc_id).alias("id"), F.coalesce(name(text), F.lit("")).alias("text"))
    ids = own.select(F.col("id").cast("double").alias("id")).where("id is not null")
    cuts = sorted(set(ids.approxQuantile("id", [k / buckets for k in range(1, buckets)], 0.25 / buckets)))
    splits = [-np.inf, *(cuts or [0.0]), np.inf]
    own = own.withColumn("at_", F.col("id").cast("double"))
    own = Bucketizer(splits=splits, inputCol="at_", outputCol="b_", handleInvalid="keep").transform(own)
    # Buckets count downwards, so that ascending buckets are descending ids; NULL ids are the last one.
    bucket = F.when(F.col("id").isNull(), F.lit(len(splits))).otherwise(F.lit(len(splits)) - 2 - F.col("b_"))
    own = own.select(bucket.cast("int").alias("bucket"), "id", "text")
    heads = own.select("bucket", "id").groupBy("bucket").agg(F.max("id").alias("head")).orderBy("bucket").collect()
    target = [(h.bucket, h.head, heads[k - 1].bucket) for k, h in enumerate(heads)]
    kind = type_of(docs, doc_id)
    heads_df = F.broadcast(spark.createDataFrame(target, f"bucket_ int, head {kind}, to int"))
    joined = own.join(heads_df, F.col("bucket") == F.col("bucket_"))
    own_place = F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g"))
    ghost = F.struct(F.col("to").alias("b"), F.lit(True).alias("g"))
    is_head = F.col("id").eqNullSafe(F.col("head"))
    places = F.explode(F.when(is_head, F.array(own_place, ghost)).otherwise(F.array(own_place))).alias("p")
    rows = joined.select(places, "id", "text").select(
        F.col("p.b").alias("bucket"), F.col("p.g").alias("ghost"), "id", "text"
    )
    ordered = rows.repartitionByRange(max(len(heads), 1), "bucket")
    return ordered.sortWithinPartitions("bucket", "ghost", F.col("id").desc_nulls_last(), "text")


def edited_fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, shingle: int = 5, buckets: int | None = None
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    Edited: the last half (floor) of the code points gives way to the first as many of the next document
    by descending id; after the last comes the first. A single document is its own successor. NULL text:
    empty. Equal ids are ordered by text. Ids must be numbers; an empty table gives no rows.
    """
    spark = ready(docs.sparkSession)
    kind = type_of(docs, doc_id)
    # Four buckets per task at most, so that the tasks are even.
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)

    def compute(batches):
        sketcher = Sketcher(k, shingle)
        last = None  # bucket, id, text, sketch, ghost
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sketches = sketcher(*utf8(batch.column("text")))
            rows = list(
                zip(
                    batch.column("bucket").to_pylist(),
                    batch.column("id").to_pylist(),
                    texts,
                    sketches,
                    batch.column("ghost").to_pylist(),
                )
            )
            if last is not None:
                rows.insert(0, last)
            last = rows[-1] if rows else last
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[4]]
            if not pairs:
                continue
            halves = [len(a[2]) // 2 for a, _ in pairs]
            edited = [a[2][: len(a[2]) - h] + b[2][:h] for (a, b), h in zip(pairs, halves)]
            others = sketcher(*utf8(pa.array(edited, pa.string())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[1] for a, _ in pairs], batch.schema.field("id").type),
                    pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                    pa.array([text_of(a[3]) for a, _ in pairs]),
                    pa.array([text_of(o) for o in others]),
                    pa.array([resemblance(a[3], o, k) for (a, _), o in zip(pairs, others)]),
                    pa.array([resemblance(a[3], b[3], k) for a, b in pairs]),
                    pa.array([containment(a[3], o, k) for (a, _), o in zip(pairs, others)]),
                    pa.array([distinct(a[3], k) for a, _ in pairs]),
                ],
                names,
            )

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next", "kept_in_edited", "n_shingles"]
    kinds = [kind, "bigint", "string", "string", "string", "double", "double", "double", "double"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, kinds))
    out = beside_next(docs, doc_id, text, buckets).mapInArrow(compute, schema)
    return out.withColumnRenamed("id", doc_id)
