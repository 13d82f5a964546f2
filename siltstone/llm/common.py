"""What several operators share: the shared folder, text buffers, words and their hashes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siltstone.session import shared_folder

#: Rows per Arrow batch. Spark bounds batches by rows only, so long texts call for few rows.
BATCH_ROWS = 1024
#: Bytes of text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21
#: Bytes whose words are hashed from one running sum.
HASH_SPAN = 1 << 18


#: The folder of the library, for Python workers on this machine where it is not installed.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """The session with batches small enough for long texts, and workers that find the library."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/siltstone-llm/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def name(column: str) -> Column:
    """A column by its exact name, also with dots or spaces in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def map_rows(df: DataFrame, function, names: list[str], types: StructType | None = None) -> DataFrame:
    """``df.mapInArrow`` for columns of any names: inside they are c0, c1, and so on.

    ``names`` are those of the result, ``types`` its types where they are not the first of ``df``.
    """
    types = types or StructType(df.schema.fields[: len(names)])
    inside = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(types.fields)])
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))).mapInArrow(function, inside).toDF(*names)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is divisible by five."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def tokenizer_file(file: str) -> str:
    """Where this machine has a public vocabulary file; asked on each executor."""
    import public_tokenizers

    return file if os.path.isabs(file) else public_tokenizers.path(file)


# ---- text buffers ------------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (NULL: empty) and the offsets of its rows, without Python strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)
    data = flat.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """Runs of rows of at most ``limit`` bytes together: first row, bytes, offsets from 0."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


# ---- words and hashes --------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words ``[^\\x20\\x09-\\x0D]+``, and for each row its range of words."""
    edge = np.zeros(len(data) + 1, bool)
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    np.not_equal(inside[1:], inside[:-1], out=edge)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    touching = cuts[inside[cuts] & inside[cuts + 1]]  # a word ends and another begins here
    places = np.flatnonzero(edge)
    if len(touching):
        places = np.sort(np.concatenate((places, touching, touching)))
    starts, ends = places[0::2], places[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


class WordHashes:
    """Hashes of byte ranges by a polynomial over random byte values, modulo 2**64.

    Ranges must ascend. All that begin within HASH_SPAN bytes are hashed at once from one running sum, so
    tables and sums stay small however long the buffer is; only a longer range makes them grow.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64)
        self.base = (int(rng.integers(0, 2**62)) * 8 + 5) % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            for attribute, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, np.uint64(factor))
                steps[0] = 1
                setattr(self, attribute, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            low = int(starts[i])
            j = max(int(np.searchsorted(starts, low + HASH_SPAN)), i + 1)
            part = data[low : int(ends[j - 1])]
            self.grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.powers[: len(part)], out=sums[1:])
            at = starts[i:j] - low
            out[i:j] = (sums[ends[i:j] - low] - sums[at]) * self.inverses[at]
            i = j
        return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: multiply and shift, one to one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
