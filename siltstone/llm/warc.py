"""WARC archives written in shards of a total order, committed through drafts and a manifest, and read back.

Records of equal payloads of some size are stored once: the one with the largest id is the response, the
others are revisit records that name it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready, scratch_path, settled
from siltstone.llm.order import smallest_hashes

# The profile of records that repeat a payload, and the ends of lines and records.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE, END = b"\r\n", b"\r\n\r\n"

#: Raw bytes a shard should hold: a thousandth of all, within these bounds. They depend on the data
#: alone, so the same records give the same shards whatever the cluster.
SHARD_BYTES = (8 << 20, 4 << 30)
#: Rows per shard in the sample that sets the bounds of shards.
SAMPLE_PER_SHARD = 32
#: Bytes a record takes besides its payload, for balancing.
HEADERS = 600
#: Copies made from one row at a time.
COPIES = 10_000
#: When records were made, unless the caller says so; a fixed date keeps files equal from run to run.
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(identity: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, identity)}>"


def uri(url: str | None) -> str:
    """A URL as one header value: white space, control and other than ASCII characters percent-encoded."""
    return quote(url or "", safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, the same bytes at every run."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: {base32_sha1(block)}"]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress(LINE.join(x.encode() for x in lines) + END + block + END, 6, mtime=0)


class ArchiveWriter:
    """Files of one shard, rolled at ``roll`` compressed bytes, each under a draft name of this attempt."""

    def __init__(self, folder: str, shard: int, roll: int, date: str):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.date = shard, roll, date
        self.drafts = f"{self.folder}/_drafts/{uuid.uuid4().hex}"
        self.fs.create_dir(self.drafts, recursive=True)
        self.files: list[tuple] = []
        self.sink = None

    def begin(self) -> None:
        self.name = f"part-{self.shard:06d}-{len(self.files):05d}.warc.gz"
        self.sink = self.fs.open_output_stream(f"{self.drafts}/{self.name}", compression=None)
        self.n_records, self.n_bytes, self.sum = 0, 0, hashlib.sha256()
        info = f"software: siltstone{LINE.decode()}format: WARC File Format 1.1{LINE.decode()}".encode()
        self.put(
            record(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", record_id(f"warcinfo {self.name}")),
                    ("WARC-Date", self.date),
                    ("WARC-Filename", self.name),
                    ("Content-Type", "application/warc-fields"),
                ],
                info,
            )
        )

    def put(self, data: bytes) -> None:
        self.sink.write(data)
        self.sum.update(data)
        self.n_bytes += len(data)

    def write(self, data: bytes) -> None:
        if self.sink is None:
            self.begin()
        self.put(data)
        self.n_records += 1
        if self.n_bytes >= self.roll:
            self.end()

    def end(self) -> list[tuple]:
        """Closes the open file; all files so far."""
        if self.sink is not None:
            self.sink.close()
            draft = f"{self.drafts}/{self.name}"
            self.files.append((self.name, self.n_records, self.n_bytes, self.sum.hexdigest(), draft))
            self.sink = None
        return self.files


FILES_TYPE = "name string, n_records bigint, n_bytes bigint, sha256 string"
DRAFTS_TYPE = f"{FILES_TYPE}, draft string"
FILES_SCHEMA = pa.schema(
    [("name", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("draft", pa.string())]
)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch], together: int = 64) -> Iterator[dict]:
    """The rows of all batches, a few at a time as Python values."""
    for batch in batches:
        for k in range(0, batch.num_rows, together):
            yield from batch.slice(k, together).to_pylist()


def hex_of(value: Column, digits: int = 16) -> Column:
    """Hex digits that sort as the number does."""
    return F.lpad(F.hex(value), digits, "0")


def ordering(page_id: Column, url: Column, key: Column, copy: Column) -> Column:
    """One text that sorts records by id (NULL first), then by url and payload, then by copy."""
    signed = page_id.cast("long").bitwiseXOR(F.lit(-(2**63)))
    return F.concat(
        F.coalesce(F.concat(F.lit("1"), hex_of(signed)), F.lit("0" * 17)),
        hex_of(F.xxhash64(url, key)),
        hex_of(copy.cast("long")),
    )


def shard_bounds(light: DataFrame) -> np.ndarray:
    """Where shards begin, as texts of ``ordering``: quantiles, by bytes, of the rows with the smallest
    hashes. The same rows give the same bounds. The driver gets SAMPLE_PER_SHARD rows per shard."""
    weight = F.col("n_bytes") + HEADERS
    total, rows = light.agg(F.sum(weight), F.count("*")).first()
    total = total or 0
    size = min(max(total // 1000, SHARD_BYTES[0]), SHARD_BYTES[1])
    n_shards = max(-(-total // size), 1)
    at = ordering(F.col("page_id"), F.col("url"), F.col("key"), F.lit(0))
    weighed = light.select(at.alias("at"), weight.alias("w"))
    picked = smallest_hashes(weighed, F.col("at"), SAMPLE_PER_SHARD * n_shards, rows)
    sample = sorted(tuple(r) for r in picked.collect())
    sums = np.cumsum([w for _, w in sample])
    places = np.searchsorted(sums, np.arange(1, n_shards) / n_shards * (sums[-1] if len(sums) else 0))
    return np.unique(np.array([sample[p][0] for p in places], dtype="S49"))


def copies(rows: DataFrame, first: Column) -> DataFrame:
    """Each row as often as ``n`` says, numbered in ``copy`` from ``first`` on."""
    blocks = rows.where(F.col("n") > first).withColumn(
        "low_", F.explode(F.sequence(first.cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long")))
    )
    high = F.least(F.col("low_") + COPIES, F.col("n")) - 1
    return blocks.withColumn("copy", F.explode(F.sequence("low_", high))).drop("low_")


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = 1000,
    roll: int = 256 << 20,
    date: datetime = EPOCH,
) -> DataFrame:
    """Writes a record per row below ``folder`` (a URI) and returns the manifest of its files.

    Records are sorted by id over all files; a shard is a range of them, written by one task into files of
    about ``roll`` compressed bytes. Of rows with equal payloads of at least ``revisit_from`` bytes, that
    with the largest id (then the largest url; NULLs are the smallest) is a response and the others
    are revisits. Rows equal in id, url and payload are records of their own, told apart by a number.
    NULL payloads are empty, NULL ids and urls leave their header out. Other columns are ignored; an empty
    table gives an empty manifest.

    A payload is shuffled once. Which records are revisits is worked out on digests alone; the verdicts are
    sorted into the shard just before the payload they concern. A file gets its name only after the job,
    from the manifest of the attempts that succeeded; what other attempts left is removed with the drafts.
    """
    spark = ready(pages.sparkSession)
    text = F.coalesce(name(payload), F.lit(""))
    own = pages.select(name(page_id).cast("long").alias("page_id"), name(url).alias("url"), text.alias("html"))
    data = F.encode("html", "UTF-8")
    own = own.withColumns({"key": F.sha2(data, 256), "n_bytes": F.octet_length("html").cast("long")})
    small = F.col("n_bytes") < revisit_from
    light = settled(
        own.select("page_id", "url", "key", "n_bytes", F.sha1(data).alias("sha1"), F.when(small, F.col("html")).alias("html")),
        "warc-light",
    )
    same = ["page_id", "url", "key"]
    grouped = light.groupBy(*same, "n_bytes", "sha1", "html").agg(F.count("*").alias("n"))

    groups = light.where(~small).groupBy("key").agg(
        F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("members")
    )
    members = grouped.where(~small).join(groups.where("members > 1"), "key")
    is_kept = F.col("page_id").eqNullSafe(F.col("kept.page_id")) & F.col("url").eqNullSafe(F.col("kept.url"))
    marks = copies(members.withColumn("kept_", is_kept.cast("long")), F.col("kept_"))

    large = own.where(~small)
    repeated = grouped.where(~small & (F.col("n") > 1))
    if not repeated.isEmpty():  # equal rows beyond the first are marks: only one payload is needed
        large = large.dropDuplicates(same)
    columns = ["page_id", "url", "key", "copy", "kind", "html", "n_bytes", "sha1", "kept"]
    none = F.lit(None).cast(members.schema["kept"].dataType).alias("kept")
    zero = F.lit(0).cast("long").alias("copy")
    stream = (
        large.select(*same, zero, F.lit(1).alias("kind"), "html", "n_bytes", F.lit(None).cast("string").alias("sha1"), none)
        .unionByName(copies(grouped.where(small), F.lit(0)).withColumns({"kind": F.lit(1), "kept": none}).select(*columns))
        .unionByName(marks.withColumns({"kind": F.lit(0), "html": F.lit(None).cast("string")}).select(*columns))
    )
    bounds = shard_bounds(light)
    n_shards = len(bounds) + 1

    @F.pandas_udf("int")
    def shard_of(at):
        return pd.Series(np.searchsorted(bounds, at.to_numpy().astype("S49"), "right").astype(np.int32))

    at = ordering(F.col("page_id"), F.col("url"), F.col("key"), F.col("copy"))
    ordered = stream.withColumn("at", at)
    ordered = ordered.withColumn("shard", shard_of("at") if n_shards > 1 else F.lit(0))
    ordered = ordered.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", "at", "kind")
    stamp = date.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, marked = None, None
        for row in rows_of(batches):
            if writer is None or writer.shard != row["shard"]:
                if writer is not None:
                    yield as_batch(writer.end(), FILES_SCHEMA)
                writer = ArchiveWriter(folder, row["shard"], roll, stamp)
            place = tuple(row[c] for c in (*same, "copy"))
            if row["kind"] == 0:
                marked = place
            elif place == marked:
                continue  # a revisit took its place
            writer.write(page_record(row, stamp))
        if writer is not None:
            yield as_batch(writer.end(), FILES_SCHEMA)

    made = settled(ordered.mapInArrow(write, DRAFTS_TYPE), "warc-files")
    return commit(made, folder)


def page_record(row: dict, date: str) -> bytes:
    """The response record of a payload, or the revisit record of a mark."""

    def identity(page_id, url, copy=0) -> str:
        return record_id(f"{page_id} {copy} {row['key']} {url}")

    fields = [("WARC-Type", "response" if row["kind"] else "revisit")]
    fields += [("WARC-Record-ID", identity(row["page_id"], row["url"], row["copy"])), ("WARC-Date", date)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", uri(row["url"])))
    if row["page_id"] is not None:
        fields.append(("Page-ID", str(row["page_id"])))
    payload = (row["html"] or "").encode()
    if row["kind"]:
        digest = base32_sha1(payload)
    else:
        kept = row["kept"]
        digest = "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", identity(kept["page_id"], kept["url"])),
            ("WARC-Refers-To-Target-URI", uri(kept["url"])),
            ("WARC-Refers-To-Date", date),
        ]
    fields += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {row['n_bytes']}"]
    return record(fields, LINE.join(x.encode() for x in head) + END + payload)


def commit(made: DataFrame, folder: str) -> DataFrame:
    """Gives the files of a finished job their names, then publishes the manifest and drops the drafts.

    Naming may run twice: a file that has its name already must have the size that the manifest states.
    Readers take files from the manifest, which Spark publishes as a whole, so a stopped commit shows none.
    """
    spark = made.sparkSession

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, root = fs.FileSystem.from_uri(folder)
                path = f"{root}/{row['name']}"
                if system.get_file_info(row["draft"]).type == fs.FileType.File:
                    system.move(row["draft"], path)
                if system.get_file_info(path).size != row["n_bytes"]:
                    raise OSError(f"{path} does not have {row['n_bytes']} bytes")
            yield batch.select(FILES_SCHEMA.names[:-1])

    named = made.repartition("name").mapInArrow(rename, FILES_TYPE)
    named.write.mode("overwrite").parquet(f"{folder}/_manifest")
    system, root = fs.FileSystem.from_uri(folder)
    if system.get_file_info(f"{root}/_drafts").type == fs.FileType.Directory:
        system.delete_dir(f"{root}/_drafts")
    return archives(spark, folder)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """The committed manifest of a folder: (name, n_records, n_bytes, sha256), one row per file."""
    return spark.read.schema(FILES_TYPE).parquet(f"{folder}/_manifest")


# ---- reading -----------------------------------------------------------------------------------


def records_in(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open file; digests and lengths are checked."""
    with gzip.GzipFile(fileobj=source) as data:
        while line := data.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no record begins with {line[:40]!r}")
            fields = {}
            while (line := data.readline()) != LINE:
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[key] = value
            block = data.read(int(fields["Content-Length"]))
            if data.read(4) != END or base32_sha1(block) != fields["WARC-Block-Digest"]:
                raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
            yield fields, block


RECORDS_TYPE = (
    "page_id bigint, target_uri string, record_type string, record_id string, refers_to_id string, "
    "payload_digest string, payload_bytes bigint, payload string"
)
RECORDS_SCHEMA = pa.schema(
    [(c, pa.int64() if kind == "bigint" else pa.string()) for c, kind in (x.split() for x in RECORDS_TYPE.split(", "))]
)


def page_fields(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of RECORDS_SCHEMA: what a page record says, its payload measured where it has one."""
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page_id = fields.get("Page-ID")
    common = (fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Record-ID"])
    size = text = None
    if fields["WARC-Type"] == "response":
        payload = block[block.index(END) + len(END) :]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        size, text = len(payload), payload.decode() if with_payload else None
    return (page_id and int(page_id), *common, fields.get("WARC-Refers-To"), digest, size, text)


def read_records(manifest: DataFrame, folder: str, with_payload: bool = False, together: int = 512) -> DataFrame:
    """One row per page record of the files of a manifest, file by file, with all digests checked.

    ``payload_bytes`` and ``payload`` are NULL for revisits; ``resolved`` follows them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("name").to_pylist():
                system, root = fs.FileSystem.from_uri(folder)
                rows = []
                with system.open_input_stream(f"{root}/{file}", compression=None) as source:
                    for fields, block in records_in(source):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(page_fields(fields, block, with_payload))
                        if len(rows) == together:
                            yield as_batch(rows, RECORDS_SCHEMA)
                            rows = []
                if rows:
                    yield as_batch(rows, RECORDS_SCHEMA)

    n_tasks = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return manifest.select("name").repartition(n_tasks).mapInArrow(read, RECORDS_TYPE)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits take the size, the digest
    and the page of the response they name; NULL where it is missing or has another digest."""
    whole = records.where("record_type = 'response'")
    found = whole.select(
        F.col("record_id").alias("refers_to_id"),
        F.col("payload_digest").alias("found_digest"),
        F.col("payload_bytes").alias("found_bytes"),
        F.col("page_id").alias("refers_to"),
    )
    revisits = records.where("record_type = 'revisit'").join(found, "refers_to_id", "left")
    agrees = F.col("found_digest") == F.col("payload_digest")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(
        revisits.withColumns(
            {"payload_bytes": F.when(agrees, F.col("found_bytes")), "payload_digest": F.when(agrees, F.col("found_digest"))}
        ).select(*columns)
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, as a URI."""
    path = scratch_path(spark, "archives")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
