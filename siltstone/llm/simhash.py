"""Near duplicates by SimHash fingerprints, linked through multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready, settled, type_of
from siltstone.llm.components import roots

BITS = 64
#: Hashes counted at once, so that a very long text needs no more memory than a long one.
HASHES_AT_ONCE = 1 << 16
#: Buckets up to this size are compared as pairs in one vector step, larger ones by search.
SMALL_BUCKET = 32


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Bit i is set if it is set in over half of the XXH64 hashes of all shingles; no word: 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(len(words) - shingle + 1, 1)
    last = ends[min(shingle, len(words)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, HASHES_AT_ONCE):
        spans = zip(starts[k : min(k + HASHES_AT_ONCE, n)].tolist(), last[k : k + HASHES_AT_ONCE].tolist())
        hashes = np.array([digest(line[a:b], 42) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, sig, fp) per row: id, hash of the text, and fingerprint as a signed long. NULL text: empty."""
    ready(docs.sparkSession)
    kind = type_of(docs, doc_id)

    def compute(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("sig"), pa.array(fps.view(np.int64))], ["id", "sig", "fp"]
            )

    own = docs.select(
        name(doc_id).alias("id"), F.xxhash64(name(text)).alias("sig"), F.coalesce(name(text), F.lit("")).alias("text")
    )
    return own.mapInArrow(compute, f"id {kind}, sig bigint, fp bigint")


def segments(distance: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of segments such that two fingerprints within ``distance`` agree up to
    the radius in one of them: the radii plus one add up to distance + 1."""
    radii = [1] * ((distance + 1) // 2) + [0] * ((distance + 1) % 2)
    cuts = [BITS * k // len(radii) for k in range(len(radii) + 1)]
    return [(a, b - a, r) for a, b, r in zip(cuts, cuts[1:], radii)]


def bucket_rows(distinct: DataFrame, distance: int) -> DataFrame:
    """(key, fp, own): each fingerprint under its own segment values and, as a visitor, under every
    value within the radius of the segment."""
    rows: list[Column] = []
    for k, (first, bits, radius) in enumerate(segments(distance)):
        mask = (1 << bits) - 1
        part = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(mask))
        table = k << bits if bits < 59 else 0
        for flip in [0, *(1 << b for b in range(bits * radius))]:
            key = part.bitwiseXOR(F.lit(flip)).bitwiseOR(F.lit(table)) if bits < 59 else part.bitwiseXOR(F.lit(flip))
            rows.append(F.struct(key.cast("long").alias("key"), F.lit(flip == 0).alias("own"), F.lit(k).alias("k")))
    row = F.explode(F.array(*rows)).alias("row")
    return distinct.select("fp", row).select("row.k", "row.key", "row.own", "fp")


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= distance  # of signed numbers it counts the absolute value


def bucket_links(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one bucket: breadth first, each fingerprint compared only with
    those not reached yet. A dense group of n is left after few passes, not n squared comparisons."""
    rest = np.unique(fp)
    ends, hubs = [], []
    while len(rest):
        hub, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            hit = near(rest, queue.pop(), distance)
            if hit.any():
                reached, rest = rest[hit], rest[~hit]
                ends.append(reached)
                hubs.append(np.full(len(reached), hub))
                queue.extend(reached)
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ends), np.concatenate(hubs)


def links_of(batches, distance: int):
    """Links found in buckets that arrive one after the other."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(parts, final):
        k, key, own, fp = (np.concatenate(x) for x in zip(*parts))
        change = np.flatnonzero((key[1:] != key[:-1]) | (k[1:] != k[:-1])) + 1
        cuts = np.concatenate(([0], change, [len(key)]))
        if not final:
            cuts = cuts[:-1]  # the last bucket may go on
        end = cuts[-1]
        out = []
        if len(cuts) > 1:
            sizes, n_own = np.diff(cuts), np.add.reduceat(own[:end].astype(np.int64), cuts[:-1])
            useful = (sizes > 1) & (n_own > 0)
            small = useful & (sizes <= SMALL_BUCKET)
            # Every own fingerprint of a small bucket beside every row of the bucket.
            bucket = np.repeat(np.arange(len(sizes)), sizes)
            mine = np.flatnonzero(own[:end] & small[bucket])
            n = sizes[bucket[mine]]
            left = np.repeat(fp[mine], n)
            first = cuts[bucket[mine]]
            right = fp[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)]
            good = near(left, right, distance) & (left != right)
            out.append((left[good], right[good]))
            out += [bucket_links(fp[cuts[i] : cuts[i + 1]], distance) for i in np.flatnonzero(useful & ~small)]
        return out, (k[end:], key[end:], own[end:], fp[end:])

    def made(out):
        u, v = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
        pairs = np.unique(np.stack((np.maximum(u, v), np.minimum(u, v))), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "key", "own", "fp")))
        rows += batch.num_rows
        if rows >= 1 << 16:
            out, rest = flush(held, False)
            held, rows = [rest], 0
            yield made(out)
    if held:
        yield made(flush(held, True)[0])


def fingerprint_links(distinct: DataFrame, distance: int) -> DataFrame:
    """(u, v) links that connect the same fingerprints as all pairs within ``distance`` bits do.

    Of two fingerprints so near, one visits the bucket of the other; whole distances are then compared.
    In a bucket only a spanning forest of the links is kept: what it leaves out joins nothing new.
    """
    rows = bucket_rows(distinct, distance)
    rows = rows.repartition("k", "key").sortWithinPartitions("k", "key")
    return rows.mapInArrow(lambda batches: links_of(batches, distance), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) per row, with ``sig_`` (hash of the text) and ``root_`` besides.

    Documents are linked when their fingerprints differ in at most ``distance`` bits; component_id is
    the smallest id reachable, NULL if all ids of the component are NULL. Texts without words have
    fingerprint zero and are linked like any other. Equal texts share a fingerprint; links are sought
    between different fingerprints, so copies cost nothing. Repeated rows give repeated results.
    """
    found = settled(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    classes = settled(found.groupBy("fp").agg(F.min("id").alias("first_id")), "fingerprint-classes")
    root_of = roots(fingerprint_links(classes.select("fp"), distance))
    # Fingerprints without links are their own component.
    rooted = classes.join(root_of, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root_")
    )
    least = rooted.groupBy("root_").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root_", "r")
    labels = rooted.join(least, F.col("root_") == F.col("r")).select(F.col("fp").alias("f"), "root_", "component_id")
    return found.join(labels, F.col("fp") == F.col("f")).select(
        F.col("id").alias(doc_id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("sig").alias("sig_"),
        "root_",
    )


def one_of_each(
    docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id.

    Ties go to the smallest hash of the text, then to one of the equal rows. A NULL id stays only where
    all ids of its component are NULL.
    """
    from pyspark.sql import Window

    groups = near_duplicates(docs, shingle, distance, doc_id, text)
    first = Window.partitionBy("root_").orderBy("sig_")
    kept = (
        groups.where(name(doc_id).eqNullSafe(F.col("component_id")))
        .withColumn("rank_", F.row_number().over(first))
        .where("rank_ = 1")
        .select(name(doc_id).alias("id_"), "sig_")
    )
    own = docs.select(F.struct(*(name(c) for c in docs.columns)).alias("row"))
    own = own.select("row", F.col("row").getField(doc_id).alias("id"), F.xxhash64(F.col("row").getField(text)).alias("sig"))
    joined = own.join(kept, F.col("id").eqNullSafe(F.col("id_")) & (F.col("sig") == F.col("sig_")), "left_semi")
    copies = Window.partitionBy("id", "sig").orderBy(F.xxhash64("row"))
    return joined.withColumn("copy", F.row_number().over(copies)).where("copy = 1").select("row.*")
