"""Approximate nearest neighbours by multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready, settled, type_of

#: Tables, projections per table, width of a cell in standard deviations, and cells visited per table.
TABLES, PROJECTIONS, WIDTH, PROBES = 10, 6, 1.6, 112
#: At most so many vectors fix the scale of the cells.
SAMPLE = 1000
#: Vectors of a bucket compared at once; a larger bucket is split into blocks of about this many.
BLOCK = 2048
#: Rows of one task's stream looked at together.
ROWS = 1 << 14


@dataclass
class Hashing:
    """Random projections onto Gaussian directions, which are 2-stable, cut into cells of one width.

    Directions follow from the seed and the number of dimensions, so vectors of any length have buckets.
    """

    width: float
    seed: int = 0

    def __post_init__(self):
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=PROJECTIONS)))
        self.steps = steps[np.argsort(np.abs(steps).sum(1), kind="stable")]
        self.drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and place in the cell, rows x tables x projections."""
        n = rows.shape[1]
        if n not in self.drawn:
            rng = np.random.default_rng([self.seed, n])
            directions = rng.standard_normal((n, TABLES * PROJECTIONS))
            self.drawn[n] = directions, rng.uniform(0, 1, TABLES * PROJECTIONS)
        directions, shift = self.drawn[n]
        at = (rows @ directions / self.width + shift).reshape(len(rows), TABLES, PROJECTIONS)
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def buckets(self, cell: np.ndarray, dims: int) -> np.ndarray:
        """One number per cell of all projections; the length of the vectors is part of it."""
        h = np.full(cell.shape[:-1], (dims + 1) * 0xD6E8FEB86659FD93 % 2**64, np.uint64)
        for k in range(cell.shape[-1]):
            h = (h ^ cell[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        return h.view(np.int64)

    def home(self, rows: np.ndarray) -> np.ndarray:
        return self.buckets(self.cells(rows)[0], rows.shape[1])

    def probes(self, rows: np.ndarray) -> np.ndarray:
        """rows x tables x PROBES: the buckets most likely to hold neighbours, the likeliest first.

        A step over a border at distance x from the row, in cells, costs x squared; a bucket costs the
        sum of its steps, and cheap ones are likely.
        """
        cell, place = self.cells(rows)
        below, above = place**2, (1 - place) ** 2
        cost = below @ (self.steps == -1).T.astype(float) + above @ (self.steps == 1).T.astype(float)
        n = min(PROBES, len(self.steps))
        best = np.argsort(cost, axis=-1, kind="stable")[..., :n]
        return self.buckets(cell[..., None, :] + self.steps[best], rows.shape[1])


def matrices(column: pa.Array):
    """(positions, matrix of doubles) for the vectors of each length in a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


def usable(vector: Column) -> Column:
    """Neither NULL nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """(cid, vec, members): different vectors, with the k+1 smallest ids of each. Equal vectors are
    searched once, however many rows have them."""
    first = Window.partitionBy("vec").orderBy("id")
    few = vectors.distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k + 1)
    return few.groupBy("vec").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("members"))


def scale_of(classes: DataFrame) -> float:
    """Root of the total variance of a bounded sample of vectors."""
    sample = classes.orderBy(F.xxhash64("cid")).limit(SAMPLE).select("vec").collect()
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.vec), []).append(row.vec)
    found = []
    for vectors in by_length.values():
        rows = np.array(vectors, np.float64)
        unit = np.abs(rows).max()  # squares of the components themselves might leave the range of doubles
        found.append(unit * np.sqrt((rows / unit).var(axis=0).sum()))
    return float(max(found, default=0)) or 1.0


def bucketed(rows: DataFrame, hashing: Hashing, probing: bool, vec_type: str) -> DataFrame:
    """(t, b, cid, vec): every vector in its bucket of each table, or in all that it visits."""

    def place(batches):
        for batch in batches:
            for at, rows_ in matrices(batch.column("vec")):
                found = hashing.probes(rows_) if probing else hashing.home(rows_)[..., None]
                n, per = len(at), found.shape[2]
                for t in range(TABLES):
                    take = pa.array(np.repeat(at, per))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n * per, t, np.int32)),
                            pa.array(found[:, t].reshape(-1)),
                            batch.column("cid").take(take),
                            batch.column("vec").take(take),
                        ],
                        ["t", "b", "cid", "vec"],
                    )

    return rows.select("cid", "vec").mapInArrow(place, f"t int, b bigint, cid bigint, vec {vec_type}")


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances by direct differences, scaled where squares would leave the range of doubles."""
    apart = np.abs(vectors - query)
    most = apart.max(axis=1, initial=0)
    scale = np.where((most > 1e150) | ((most < 1e-150) & (most > 0)), most, 1.0)
    return np.sqrt(((apart / scale[:, None]) ** 2).sum(axis=1)) * scale


def rough_squares(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances of all queries and vectors in some unit, and by how much two of them may stand in
    the wrong order.

    The products are taken of centred vectors with components up to one, so that neither a common offset
    nor their size costs digits. Rounding moves a square by some units of the last place of its terms,
    and centring by one of the components.
    """
    unit = max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0)) or 1.0
    vectors, queries = vectors / unit, queries / unit
    centre = vectors.mean(axis=0)
    vectors, queries = vectors - centre, queries - centre
    own, other = (queries**2).sum(1), (vectors**2).sum(1)
    most = own.max(initial=0) + other.max(initial=0)
    dims = vectors.shape[1]
    slack = 8 * np.finfo(float).eps * dims * (most + np.sqrt(most) + np.finfo(float).eps)
    return own[:, None] + other - 2 * queries @ vectors.T, float(slack)


def nearest_in(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
    """For each query the k nearest vectors: row numbers of the queries, ids and exact distances."""
    rows, found, scores = [], [], []
    rough, slack = rough_squares(vectors, queries)
    for q in range(len(queries)):
        at = np.arange(len(ids))
        if len(ids) > k:
            at = np.flatnonzero(rough[q] <= np.partition(rough[q], k - 1)[k - 1] + 2 * slack)
        exact = distances(vectors[at], queries[q])
        order = np.lexsort((ids[at], exact))[:k]
        rows.append(np.full(len(order), q))
        found.append(ids[at][order])
        scores.append(exact[order])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def search_stream(batches, k: int):
    """Compare in a stream sorted by bucket, block and kind: the vectors of a block, then its queries."""
    held_key, vectors, ids = None, [], []

    def made(parts):
        q, c, s = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.float64())], ["q", "c", "score"]
        )

    for batch in batches:
        columns = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("t", "b", "blk", "kind", "cid"))
        t, b, blk, kind, cid = columns
        if not len(t):
            continue
        row = np.zeros(len(t), np.int64)
        blocks = {}
        for at, rows in matrices(batch.column("vec")):
            row[at] = np.arange(len(at))
            blocks[rows.shape[1]] = rows
        dims = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
        change = np.flatnonzero(
            (t[1:] != t[:-1]) | (b[1:] != b[:-1]) | (blk[1:] != blk[:-1]) | (kind[1:] != kind[:-1])
        ) + 1
        cuts = np.concatenate(([0], change, [len(t)]))
        out = []
        for low, high in zip(cuts, cuts[1:]):
            key, rows = (t[low], b[low], blk[low]), blocks[dims[low]][row[low:high]]
            if kind[low] == 0:
                if key != held_key:
                    held_key, vectors, ids = key, [], []
                vectors.append(rows)
                ids.append(cid[low:high])
            elif key == held_key:
                vectors, ids = [np.concatenate(vectors)], [np.concatenate(ids)]
                for k0 in range(0, len(rows), 64):
                    q, c, s = nearest_in(vectors[0], ids[0], rows[k0 : k0 + 64], k)
                    out.append((cid[low + k0 : high][q], c, s))
        if out:
            yield made(out)


def searched(index: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(q, c, score): the k nearest of each query in each bucket it visits.

    A large bucket is split into blocks by a hash of the vector; a query that visits it meets all blocks.
    """
    sizes = index.groupBy("t", "b").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    sizes = sizes.select(F.col("t").alias("t_"), F.col("b").alias("b_"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"))
    same = (F.col("t") == F.col("t_")) & (F.col("b") == F.col("b_"))
    count = F.coalesce("nb", F.lit(1))
    own = index.join(sizes, same, "left").select(
        "t", "b", F.pmod(F.xxhash64("cid"), count).cast("int").alias("blk"), F.lit(0).alias("kind"), "cid", "vec"
    )
    asked = visits.join(sizes, same, "left").select(
        "t", "b", F.explode(F.sequence(F.lit(0), count - 1)).alias("blk"), F.lit(1).alias("kind"), "cid", "vec"
    )
    both = own.union(asked).repartition("t", "b", "blk").sortWithinPartitions("t", "b", "blk", "kind")
    return both.mapInArrow(lambda batches: search_stream(batches, k), "q bigint, c bigint, score double")


def best(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(q, near): for each query class the k+1 nearest (score, id), its own members among them."""
    merged = found.groupBy("q", "c").agg(F.min("score").alias("score"))
    nearest = Window.partitionBy("q").orderBy("score", "c")
    few = merged.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1)
    each = few.join(members, F.col("c") == F.col("cid")).select("q", "score", F.explode("members").alias("id"))
    by_row = Window.partitionBy("q").orderBy("score", "id")
    top = each.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k + 1)
    return top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))


def nearest_neighbours(
    vectors: DataFrame, every: int = 100, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 0
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k nearest others.

    Every vector is hashed into TABLES tables. A query visits PROBES buckets of each, in the order of
    estimated success; candidates of all tables are merged and ranked by exact distances in double
    precision, ties to the smaller id. A query that finds fewer than k is compared with all vectors, in
    blocks, so it gets all there are. Recall depends on how far neighbours stand out, not on table size.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows with a
    NULL id. Equal vectors are one entry of the index; exact repeats of a row count once. Vectors of
    different lengths are never neighbours. An empty table gives no rows. Other columns are ignored.
    """
    spark = ready(vectors.sparkSession)
    vec_type = type_of(vectors, vector)
    own = vectors.select(name(vec_id).cast("long").alias("id"), name(vector).alias("vec"))
    own = own.where(F.col("id").isNotNull() & usable(F.col("vec")))
    classes = settled(vector_classes(own, k), "vector-classes")
    asking = own.where(F.col("id") % every == 0).distinct()
    asking = asking.join(classes.select("vec", "cid"), "vec").select("id", "cid", "vec")
    asking = settled(asking, "vector-queries")
    distinct_asking = asking.dropDuplicates(["cid"])
    hashing = Hashing(WIDTH * scale_of(classes), seed)
    members = classes.select("cid", "members")
    index = bucketed(classes, hashing, False, vec_type)
    visits = bucketed(distinct_asking, hashing, True, vec_type)
    found = settled(best(searched(index, visits, k + 1), members, k), "neighbours")
    # Too few found: compare with everything.
    short = found.where(F.size("near") < k + 1).select(F.col("q").alias("cid_"))
    if not short.isEmpty():
        blocks = max(-(-classes.count() // BLOCK), 1)
        # The length of the vectors is the table, a hash of the vector the bucket.
        every_one = classes.select(
            F.size("vec").alias("t"), F.pmod(F.xxhash64("cid"), F.lit(blocks)).alias("b"), "cid", "vec"
        )
        few = distinct_asking.join(short, F.col("cid") == F.col("cid_"), "left_semi")
        all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b")
        asked = few.select(F.size("vec").alias("t"), all_blocks, "cid", "vec")
        exact = best(searched(every_one, asked, k + 1), members, k)
        found = found.join(short, F.col("q") == F.col("cid_"), "left_anti").union(settled(exact, "neighbours"))
    answers = asking.select(F.col("id").alias("query_id"), "cid").join(found, F.col("cid") == F.col("q"))
    others = F.slice(F.filter("near", lambda x: x.id != F.col("query_id")), 1, k)
    ranked = answers.select("query_id", F.posexplode(others).alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias(vec_id), "hit.score")
