"""Token counts of whole texts by a sentencepiece model; huge texts are counted in overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import name, ready, settled, tokenizer_file, type_of

_MODELS: dict[str, "PieceModel"] = {}


def piece_model(file: str) -> "PieceModel":
    """The model of a file, one per process."""
    if file not in _MODELS:
        _MODELS[file] = PieceModel(tokenizer_file(file))
    return _MODELS[file]


class PieceModel:
    """A sentencepiece model and the places of a text that none of its pieces can bridge.

    Merging only ever forms pieces of the vocabulary. A place between two characters that follow each
    other in no piece is therefore never merged over: what stands left and right of it is tokenized as
    if it stood alone. Such a place is *stable*, in the whole text as in every chunk that holds it.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            raw = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(raw)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=raw)
        texts = [p.piece for p in proto.pieces if p.type in (1, 4)]  # ordinary, user-defined
        self.known = {c for t in texts for c in t}
        self.pairs = {t[i : i + 2] for t in texts for i in range(len(t) - 1)}
        spec = proto.normalizer_spec
        #: Offsets can be spliced only where characters are left as they are.
        self.splits = (
            proto.trainer_spec.model_type == 2
            and not spec.precompiled_charsmap
            and not spec.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
        )
        self.by_bytes = proto.trainer_spec.byte_fallback

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.processor.encode(texts, num_threads=1)]

    def is_stable(self, left: str, right: str) -> bool:
        left, right = ("▁" if c == " " else c for c in (left, right))
        if not self.by_bytes and left not in self.known and right not in self.known:
            return False  # neighbouring unknown characters make one piece
        return left + right not in self.pairs

    def first_stable(self, text: str, low: int, high: int) -> int:
        """The first stable place p with low < p < high, -1 if there is none."""
        return next((p for p in range(low + 1, high) if self.is_stable(text[p - 1], text[p])), -1)

    def count_between(self, text: str, low: int, high: int) -> int:
        """Tokens of ``text`` from place ``low`` to ``high`` (0 and its length: the ends), -1 if they
        are no token boundaries."""
        begins = np.array([p.begin for p in self.processor.encode(text, return_type="proto").pieces])  # in bytes
        at = []
        for place in (low, high):
            byte = len(text[:place].encode())
            k = 0 if place == 0 else int(np.searchsorted(begins, byte))
            if 0 < place < len(text) and (k == len(begins) or begins[k] != byte):
                return -1
            at.append(k if place < len(text) else len(begins))
        return at[1] - at[0]


def chunk_rows(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str, int, int]]:
    """(number, text, overlap to the left, overlap to the right) of chunks that cover a text."""
    step = chunk - overlap
    n = max(1, -(-(len(text) - overlap) // step))
    for k in range(n):
        part = text[k * step :] if k == n - 1 else text[k * step : k * step + chunk]
        yield k, part, overlap if k else 0, overlap if k < n - 1 else 0


def chunk_tokens(model: PieceModel, text: str, left: int, right: int) -> int:
    """Tokens of a chunk between the stable places in its overlaps, -1 if one has none.

    Both chunks at an overlap see the same characters there and so choose the same place.
    """
    low = model.first_stable(text, 0, left) if left else 0
    high = model.first_stable(text, len(text) - right, len(text)) if right else len(text)
    if low < 0 or high < 0:
        return -1
    return model.count_between(text, low, high)


def token_counts(
    docs: DataFrame,
    model: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    chunk: int = 32_768,
    overlap: int = 1_024,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row, as the model counts the whole text.

    Texts of up to two chunks are encoded whole. Longer ones become overlapping chunks, dealt to all
    tasks; each chunk is encoded with offsets and counted between the first stable places of its two
    overlaps. Where an overlap has no such place, or a place is no token boundary, the text is done
    again with chunks and overlaps four times as wide; a chunk that holds the whole text ends this.
    NULL and empty text: 0 tokens. Repeated rows give repeated results; ids may be NULL. Other columns
    are ignored.
    """
    spark = ready(docs.sparkSession)
    kind = type_of(docs, doc_id)
    own = docs.select(name(doc_id).alias("id"), F.coalesce(name(text), F.lit("")).alias("text"))
    long = F.length("text") > 2 * chunk

    def whole(batches):
        m = piece_model(model)
        for batch in batches:
            counts = m.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    short = own.where(~long).select("id", "text", n_bytes)
    counted = [short.mapInArrow(whole, f"id {kind}, n_bytes bigint, n_tokens bigint")]

    # Rows that are equal share a key; each then gets its share of what the key gathers.
    keyed = own.where(long).select("id", "text", n_bytes, F.xxhash64("text").alias("sig"))
    while True:
        last = chunk_pass(keyed, model, kind, chunk, overlap)
        last = settled(last, "token-counts")
        good = last.where(~F.col("failed"))
        counted.append(
            good.select("id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")
        )
        failed = last.where("failed").select("id", "sig")
        if failed.isEmpty():
            break
        again = failed.withColumnsRenamed({"id": "id_", "sig": "sig_"})
        keyed = keyed.join(again, F.col("id").eqNullSafe(F.col("id_")) & (F.col("sig") == F.col("sig_")), "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result.select(
        F.col("id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def chunk_pass(keyed: DataFrame, model: str, kind: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of the texts of ``keyed`` by chunks of one size; ``failed`` where a seam did not hold."""
    chunks = "id {0}, sig bigint, n_bytes bigint, k bigint, part string, l bigint, r bigint".format(kind)

    def cut_up(batches):
        splits = piece_model(model).splits
        for batch in batches:
            ids = batch.column("id")
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("sig", "n_bytes", "text")))):
                sig, n_bytes, text = row
                cut = list(chunk_rows(text, chunk if splits else len(text) + overlap, overlap))
                k, part, left, right = (pa.array(x) for x in zip(*cut))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([i] * len(cut))),
                        pa.array([sig] * len(cut)),
                        pa.array([n_bytes] * len(cut)),
                        *(k, part, left, right),
                    ],
                    ["id", "sig", "n_bytes", "k", "part", "l", "r"],
                )

    def count(batches):
        m = piece_model(model)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "l", "r")))
            found = [chunk_tokens(m, *row) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "sig", "n_bytes", "k")] + [pa.array(found, pa.int64())],
                ["id", "sig", "n_bytes", "k", "n"],
            )

    spread = keyed.select("id", "sig", "n_bytes", "text").mapInArrow(cut_up, chunks)
    spread = spread.repartition("id", "sig", "k")
    counts = spread.mapInArrow(count, f"id {kind}, sig bigint, n_bytes bigint, k bigint, n bigint")
    copies = F.sum(F.when(F.col("k") == 0, 1).otherwise(0))
    return counts.groupBy("id", "sig", "n_bytes").agg(
        copies.alias("copies"),
        (F.sum("n") / copies).cast("long").alias("n_tokens"),
        (F.min("n") < 0).alias("failed"),
    )
