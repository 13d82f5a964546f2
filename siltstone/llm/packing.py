"""Packing documents into sequences of fixed capacity: large-item matching, then best fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siltstone.llm.common import map_rows, name, ready, settled, type_of, utf8
from siltstone.llm.tokens import encoder


def token_pieces(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the ids of each text and ``end``, cut at every ``capacity``.

    NULL and empty text: the end id alone. Repeated rows give repeated pieces. Other columns are ignored.
    """
    ready(docs.sparkSession)
    kind = type_of(docs, doc_id)

    def cut(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            ids, bounds = encode.encode(*utf8(batch.column("text")))
            ids = np.insert(ids, bounds[1:], end).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            n = -(-np.diff(bounds) // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            low = bounds[row] + start
            high = np.minimum(low + capacity, bounds[row + 1])
            raw = memoryview(ids.tobytes())
            crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(low, high)), np.int64, len(low))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    *(pa.array(x) for x in (start, high - low, crc)),
                ],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    own = docs.select(name(doc_id).alias("id"), name(text).alias("text"))
    return own.mapInArrow(cut, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


class Plan:
    """Where the r-th item of each size goes, worked out from the number of items of each size.

    Bins that are alike form one class: so many bins with so much room. Every step moves whole classes,
    so the work depends on the capacity, never on the number of items.

    Large items are those above a third of the capacity; a bin holds two of them at most. From the
    largest down, each takes the largest partner that fits. Then the small items, from the largest down,
    go into the fullest bins that have room, and into new bins when none has.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {s: int(n) for s, n in counts.items() if n}
        self.given = dict.fromkeys(self.left, 0)
        self.rooms: list[int] = []  # sizes of room, ascending
        self.classes: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
        self.slots: dict[int, list[tuple[int, int, int, int]]] = {s: [] for s in self.left}
        self.n_bins = 0
        self.capacity = capacity
        large = sorted(s for s in self.left if 3 * s > capacity)
        self.match(large)
        for size in sorted((s for s in self.left if 3 * s <= capacity), reverse=True):
            self.best_fit(size)

    def give(self, size: int, bin_: int, per_bin: int, offset: int, n: int) -> None:
        """The next n items of a size go to bins from ``bin_`` on, so many each, from ``offset`` on."""
        self.slots[size].append((self.given[size], bin_, per_bin, offset))
        self.given[size] += n
        self.left[size] -= n

    def put_back(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.classes:
                insort(self.rooms, room)
                self.classes[room] = []
            self.classes[room].append((first, n))

    def match(self, large: list[int]) -> None:
        while large:
            size = large[-1]
            if not self.left[size]:
                large.pop()
                continue
            k = bisect_left(large, self.capacity - size + 1) - 1
            while k >= 0 and not self.left[large[k]]:
                del large[k]
                k -= 1
            partner = large[k] if k >= 0 else 0
            n = self.left[size]
            if partner == size:
                n //= 2
                if not n:  # a single one is left
                    smaller = [s for s in large[:k] if self.left[s]]
                    partner, n = (smaller[-1], 1) if smaller else (0, 1)
            elif partner:
                n = min(n, self.left[partner])
            first, self.n_bins = self.n_bins, self.n_bins + n
            self.give(size, first, 1, 0, n)
            if partner:
                self.give(partner, first, 1, size, n)
            self.put_back(self.capacity - size - partner, first, n)

    def best_fit(self, size: int) -> None:
        while self.left[size]:
            k = bisect_left(self.rooms, size)
            if k == len(self.rooms):
                each = self.capacity // size
                n = self.left[size]
                first, room, bins = self.n_bins, self.capacity, -(-n // each)
                self.n_bins += bins
            else:
                room = self.rooms[k]
                first, bins = self.classes[room].pop()
                if not self.classes[room]:
                    del self.rooms[k], self.classes[room]
                each = room // size
            full = min(bins, self.left[size] // each)
            if full:
                self.give(size, first, each, self.capacity - room, full * each)
                self.put_back(room - each * size, first, full)
            rest = self.left[size] if full < bins else 0
            if rest:
                self.give(size, first + full, each, self.capacity - room, rest)
                self.put_back(room - rest * size, first + full, 1)
            if full + bool(rest) < bins:
                self.put_back(room, first + full + bool(rest), bins - full - bool(rest))

    def tables(self) -> dict[int, tuple[np.ndarray, ...]]:
        return {s: tuple(np.array(x, np.int64) for x in zip(*slots)) for s, slots in self.slots.items()}


def placed(tables: dict[int, tuple[np.ndarray, ...]], size: np.ndarray, rank: np.ndarray):
    """Bin and offset of items by size and rank among their size, both from 0."""
    bins, offsets = np.zeros_like(size), np.zeros_like(size)
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        low, first, each, offset = tables[int(s)]
        k = np.searchsorted(low, rank[at], "right") - 1
        n = rank[at] - low[k]
        bins[at] = first[k] + n // each[k]
        offsets[at] = offset[k] + n % each[k] * s
    return bins, offsets


def packed(items: DataFrame, size: str = "length", capacity: int = 2048) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: places without gaps in sequences of ``capacity``.

    Only the number of items of each size reaches the driver, at most ``capacity`` numbers. Items get
    their rank within their size from counts per size and salt, so that no size is gathered in one
    place; ranks choose the places. Sizes must lie in 1..capacity, as pieces of documents do; others are
    refused. Items that are equal in all columns share places in any order. Empty input: no rows.
    """
    spark = ready(items.sparkSession)
    salts = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    columns = items.columns
    salted = settled(
        items.withColumn("salt_", F.pmod(F.xxhash64(*(name(c) for c in columns), F.rand(7)), F.lit(salts)).cast("int")),
        "packing-items",
    )
    cells = salted.groupBy(name(size).cast("long").alias("size_"), "salt_").agg(F.count("*").alias("n_"))
    counts = {r.size_: r.n for r in cells.groupBy("size_").agg(F.sum("n_").alias("n")).limit(capacity + 1).collect()}
    if any(s is None or not 1 <= s <= capacity for s in counts):
        raise ValueError(f"sizes must lie in 1..{capacity}")
    tables = spark.sparkContext.broadcast(Plan(counts, capacity).tables())
    before = Window.partitionBy("size_").orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select("size_", "salt_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("base_"))
    bases = bases.withColumnRenamed("salt_", "cell_")
    within = Window.partitionBy(name(size), "salt_").orderBy(*(name(c) for c in columns))
    ranked = salted.withColumn("rank_", F.row_number().over(within) - 1).join(
        bases, (name(size) == F.col("size_")) & (F.col("salt_") == F.col("cell_"))
    )
    ranked = ranked.select(*(name(c) for c in columns), (F.col("rank_") + F.col("base_")).alias("rank_"))

    def place(batches):
        for batch in batches:
            sizes = batch.column(columns.index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
            bins, offsets = placed(tables.value, sizes, batch.column(len(columns)).to_numpy())
            arrays = [batch.column(k) for k in range(len(columns))]
            arrays += [pa.array(bins), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{k}" for k in range(len(arrays))])

    places = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])
    types = StructType([*items.schema.fields, *places.fields])
    return map_rows(ranked, place, types.names, types)


def packed_documents(docs: DataFrame, tokenizer: str, end: int, capacity: int = 2048) -> DataFrame:
    """Pieces of whole documents with their places."""
    return packed(token_pieces(docs, tokenizer, end, capacity), "length", capacity).withColumnRenamed("id", "doc_id")
