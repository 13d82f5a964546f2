"""Token ids in Arrow files of equal-length sequences, and random access to them."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready, scratch_path, settled, type_of, utf8
from siltstone.llm.tokens import encoder

#: Sequences per record batch: what a reader maps or fetches at once.
BATCH_SEQUENCES = 64

MANIFEST = "path string, part int, n_docs bigint, n_tokens bigint, first_id {0}, last_id {0}"
#: Characters of a text that order equal ids; a hash of the text orders what is equal in these.
HEAD = 64


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """One Arrow file of fixed-size lists, each ``length`` long: ``ids``, and the bit masks ``mask``
    (a token, not padding) and ``last`` (the last token of a document).

    Ids take two bytes where the vocabulary allows it. Only the last sequence is padded. A file gets its
    name when it is complete, so a task that runs twice leaves one whole file.
    """

    def __init__(self, uri: str, length: int, vocabulary: int):
        self.fs, self.path = place(uri)
        self.kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        self.length = length
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.draft = f"{self.path}.{uuid.uuid4().hex}"
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(self.kind), length)),
                ("mask", pa.list_(pa.bool_(), length)),
                ("last", pa.list_(pa.bool_(), length)),
            ]
        )
        self.sink = self.fs.open_output_stream(self.draft)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0

    def write(self, ids: np.ndarray, last: np.ndarray) -> None:
        self.held.append((ids.astype(self.kind), np.ones(len(ids), bool), last))
        self.n_held += len(ids)
        step = BATCH_SEQUENCES * self.length  # every batch but the last is full, so places can be computed
        if self.n_held >= step:
            self.flush(self.n_held // step * step)

    def flush(self, n: int) -> None:
        held = [np.concatenate(x) for x in zip(*self.held)]
        step = BATCH_SEQUENCES * self.length
        for at in range(0, n, step):
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x[at : min(n, at + step)]), self.length)
                for x in held
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held = [tuple(x[n:] for x in held)]
        self.n_held -= n

    def close(self) -> None:
        if self.n_held:
            pad = -self.n_held % self.length
            self.held.append((np.zeros(pad, self.kind), np.zeros(pad, bool), np.zeros(pad, bool)))
            self.n_held += pad
            self.flush(self.n_held)
        self.writer.close()
        self.sink.close()
        self.fs.move(self.draft, self.path)


class SequenceFile:
    """Random access to the sequences of a file; a local file is mapped, not copied."""

    def __init__(self, uri: str):
        system, path = place(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, mask and last tokens of record batch ``k``. The matrix of ids shares the file's memory;
        the masks are unpacked from the bits that do."""
        batch = self.reader.get_batch(k)
        flat = [batch.column(c).flatten() for c in ("ids", "mask", "last")]
        return tuple(x.to_numpy(zero_copy_only=not k).reshape(-1, self.length) for k, x in enumerate(flat))

    def sequence(self, n: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``n``, found by arithmetic alone, both without a copy."""
        batch = self.reader.get_batch(n // BATCH_SEQUENCES)
        ids, mask = (batch.column(c).slice(n % BATCH_SEQUENCES, 1).flatten() for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def documents(self):
        """The ids of each document in turn, with one batch in memory."""
        rest: list[np.ndarray] = []
        for k in range(self.reader.num_record_batches):
            ids, mask, last = (x.reshape(-1) for x in self.batch(k))
            at = 0
            for end in np.flatnonzero(last) + 1:
                yield np.concatenate([*rest, ids[at:end]]) if rest else ids[at:end]
                rest, at = [], int(end)
            tail = ids[at : len(ids) - int((~mask).sum())]
            if len(tail):
                rest.append(tail.copy())

    def close(self) -> None:
        self.source.close()


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int,
    length: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Encode whole texts, add the id ``end`` to each, and write them in ascending order of ids.

    Documents are dealt by ranges of ids, each range to one pair of files below ``folder``: ``.arrow``
    with the sequences, ``.docs`` with the ids of its documents in order. Returns the manifest, one row
    per range, numbered in ``part``. NULL and empty text: the end id alone. NULL ids come first; equal ids are
    ordered by the first HEAD characters of the text, then by a hash of it, and may spread over several
    files, as may equal rows. An empty table gives no file. Other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    kind = type_of(docs, doc_id)
    own = docs.select(name(doc_id).alias("id"), name(text).alias("text"))
    files = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def write(batches):
        encode, out, ids_out, first, last, n_docs, n_tokens = encoder(tokenizer), None, None, None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                stem = f"{folder}/{uuid.uuid4().hex}"
                out = SequenceWriter(f"{stem}.arrow", length, encode.tokenizer.get_vocab_size())
                index_fs, index_path = place(f"{stem}.docs")
                index = index_fs.open_output_stream(index_path)
                ids_out = pa.ipc.new_file(index, pa.schema([batch.schema.field("id")]))
                first = batch.column("id").slice(0, 1)
            last = batch.column("id").slice(batch.num_rows - 1, 1)
            ids, bounds = encode.encode(*utf8(batch.column("text")))
            with_end = np.insert(ids, bounds[1:], end).astype(np.uint32)
            final = np.zeros(len(with_end), bool)
            final[bounds[1:] + np.arange(batch.num_rows)] = True
            out.write(with_end, final)
            ids_out.write_batch(pa.RecordBatch.from_arrays([batch.column("id")], names=["id"]))
            n_docs, n_tokens = n_docs + batch.num_rows, n_tokens + len(with_end)
        if out is not None:
            out.close()
            ids_out.close()
            index.close()
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            counts = [pa.array([stem]), part, pa.array([n_docs]), pa.array([n_tokens])]
            yield pa.RecordBatch.from_arrays(
                [*counts, first, last], ["path", "part", "n_docs", "n_tokens", "first_id", "last_id"]
            )

    keys = [F.col("id").asc_nulls_first(), F.substring("text", 1, HEAD).asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = own.repartitionByRange(files, *keys, F.rand(7)).sortWithinPartitions(*keys)
    manifest = settled(ordered.mapInArrow(write, MANIFEST.format(kind)), "sequences-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, read back from the files of a manifest."""
    spark = manifest.sparkSession
    kind = type_of(manifest, "first_id")
    n_files = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                file = SequenceFile(f"{path}.arrow")
                system, index = place(f"{path}.docs")
                with system.open_input_file(index) as source:
                    ids = pa.ipc.open_file(source).read_all().column("id").combine_chunks()
                found = [(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in file.documents()]
                n, crc = (np.array(x, np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crc)],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )
                file.close()

    # One task per range of files, whatever their number.
    spread = manifest.select("path", "start").repartition(n_files)
    found = spread.mapInArrow(read, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.withColumnRenamed("id", doc_id)


def sequence_folder(spark) -> str:
    """A new folder below the shared one, as a URI."""
    path = scratch_path(spark, "sequences")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
