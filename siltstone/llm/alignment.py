"""Alignment of the tokens of two tokenizers on the same texts, and how often they stand for each other.

One side (A) is a byte-level model of the tokenizers library, the other (B) a sentencepiece model. Both read
a text with one space before it.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltstone.llm.common import WordHashes, name, ragged, ready, settled, slices, tokenizer_file, type_of, utf8
from siltstone.llm.token_counts import piece_model
from siltstone.llm.tokens import ASCII_LETTER, LATIN, PUNCTUATION, WordTable

#: Bytes of text whose pairs are counted together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Units aligned in one text.
TOGETHER = 256

_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


def aligner(a: str, b: str) -> "Aligner":
    """The aligner of two vocabulary files, one per process."""
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, and its byte: printable ones stand
    for themselves, the others follow U+0100 in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def refined(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The byte at which each token ends.

    A span is exact if it is not empty and the next one begins behind it. Tokens that share a
    character, or stand for bytes of one, have spans that overlap or are empty: from the start of such a
    run on, the lengths of their decoded bytes tell where each ends.
    """
    if not len(starts):
        return ends
    exact = ends > starts
    exact[:-1] &= starts[1:] >= ends[:-1]
    first = np.zeros(len(starts), np.int64)
    first[1:] = np.where(exact[:-1], np.arange(1, len(starts)), 0)
    first = np.maximum.accumulate(first)
    sums = np.cumsum(lengths)
    return np.where(exact, ends, starts[first] + sums - (sums - lengths)[first])


class Aligned:
    """Tokens of one text on both sides, and the groups between the bytes where tokens of both end."""

    def __init__(self, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        self.ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.upto_a = np.concatenate(([0], np.searchsorted(ends_a, self.ends, "right")))
        self.upto_b = np.concatenate(([0], np.searchsorted(ends_b, self.ends, "right")))

    def links(self) -> np.ndarray:
        """The pair of tokens that end each group together, as a << 32 | b."""
        last_a, last_b = (x[n[1:] - 1].astype(np.uint64) for x, n in ((self.a, self.upto_a), (self.b, self.upto_b)))
        return last_a << np.uint64(32) | last_b

    def texts(self) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        at_a, at_b = self.upto_a.tolist(), self.upto_b.tolist()
        return [
            f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:])
        ]


class Units:
    """Stretches of text between places where both sides are cut for certain.

    ``heads`` holds n_a | n_b << 31 of each, ``n_links`` the number of its groups, ``links`` the links of all in
    turn, ``texts`` their groups.
    """

    def __init__(self, n_a, n_b, n_links, links: np.ndarray, texts: list[bytes]):
        self.heads = np.asarray(n_a).astype(np.uint64) | np.asarray(n_b).astype(np.uint64) << np.uint64(31)
        self.n_links, self.links, self.texts = np.asarray(n_links, np.int64), links, texts

    @classmethod
    def whole(cls, aligned: Aligned) -> "Units":
        """A text as one unit."""
        texts = aligned.texts()
        return cls([len(aligned.a)], [len(aligned.b)], [len(texts)], aligned.links(), [";".join(texts).encode()])

    @classmethod
    def broken(cls) -> "Units":
        """One unit whose bytes do not come back from its tokens."""
        unit = cls([0], [0], [0], np.zeros(0, np.uint64), [b""])
        unit.heads[:] = BROKEN
        return unit

    @classmethod
    def joined(cls, some: list["Units"]) -> "Units":
        out = cls.__new__(cls)
        for x in ("heads", "n_links", "links"):
            setattr(out, x, np.concatenate([getattr(u, x) for u in some]))
        out.texts = [t for u in some for t in u.texts]
        return out


#: Marks units whose bytes do not come back from their tokens.
BROKEN = np.uint64(1 << 63)


class Aligner:
    """Aligns texts, unit by unit where both tokenizers provably cut them, each distinct unit once.

    Units begin at a space behind a letter, digit or sign of ASCII (or a letter up to U+00FF), and
    where such a letter meets ASCII punctuation. Side A cuts there by its pattern: a match never spans
    a letter and what is none, and white space only begins one. Side B does if no piece holds the two
    characters in turn, which is looked up for each pair. Elsewhere texts are left together.
    ``limit`` bounds the units kept, by their number.
    """

    def __init__(self, a: str, b: str, limit: int = 800_000):
        from tokenizers import Tokenizer

        path = tokenizer_file(a)
        self.a, self.b = Tokenizer.from_file(path), piece_model(b)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        size = self.b.processor.get_piece_size()
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.processor.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.processor.id_to_piece, range(size)))
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        with open(path, encoding="utf-8") as file:
            before = json.load(file).get("pre_tokenizer") or {}
        #: Whether side A splits by the usual pattern of byte-level models, and side B can be spliced.
        self.cuts = (
            before.get("type") == "ByteLevel" and before.get("use_regex") is True and self.b.splits
        )
        self.stable = self.stable_pairs()
        self.hashes = WordHashes(21), WordHashes(22)
        self.units = WordTable(limit, np.uint64)
        self.texts: list[bytes] = []

    def stable_pairs(self) -> np.ndarray:
        """Whether side B is cut between a character (U+0000 to U+00FF) and an ASCII one."""
        stable = np.zeros((256, 128), bool)
        for left in range(33, 256):
            for right in (32, *np.flatnonzero(PUNCTUATION)):
                stable[left, right] = self.b.is_stable(chr(left), chr(right))
        return stable

    def align(self, text: str) -> Aligned | None:
        """Tokens of a text that begins with a space; None if a side does not give its bytes back."""
        raw = text.encode()
        coded = self.a.encode(text, add_special_tokens=False)
        a = np.array(coded.ids, np.int64)
        pieces = self.b.processor.encode(text[1:], return_type="proto").pieces
        b, low, high = np.array([(p.id, p.begin, p.end) for p in pieces], np.int64).reshape(-1, 3).T
        for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join([table[i] for i in ids.tolist()]) != raw:
                return None
        characters = np.frombuffer(raw, np.uint8)
        place = np.append(np.flatnonzero((characters & 0xC0) != 0x80), len(raw))
        spans = place[np.array(coded.offsets, np.int64).reshape(-1, 2)]
        low = low + 1
        low[:1] = 0  # the space before the text has no place in it
        ends_a = refined(spans[:, 0], spans[:, 1], self.length_a[a])
        return Aligned(a, ends_a, b, refined(low, high + 1, self.length_b[b]))

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the units of texts that begin with a space each, and the range of each text in them."""
        begins = offsets[:-1][np.diff(offsets) > 0]
        if not self.cuts or len(data) < 2:
            return begins, np.searchsorted(begins, offsets)
        left, right = data[:-1], data[1:]
        second = np.zeros(len(data), bool)
        second[1:] = (left == 0xC3) & LATIN[right]
        letter = ASCII_LETTER[left] | second[:-1]
        plain = ((left > 32) & (left < 127)) | second[:-1]
        here = (plain & (right == 32)) | (letter & PUNCTUATION[right])
        character = np.where(second[:-1], left + np.uint8(64), left)  # C3 80 is U+00C0
        at = np.flatnonzero(here)
        at = at[self.stable[character[at], right[at]]] + 1
        here[:] = False
        here[at - 1] = True
        here[begins[begins > 0] - 1] = True
        starts = np.concatenate((begins[:1], np.flatnonzero(here) + 1))
        return starts, np.searchsorted(starts, offsets)

    def settle(self, pieces: list[tuple[str, str]]) -> Units:
        """Units by (context, text), the context being what a unit without its own space stands behind."""
        found = []
        for k in range(0, len(pieces), TOGETHER):
            some = pieces[k : k + TOGETHER]
            bounds = np.cumsum([0, *(len(x.encode()) for pair in some for x in pair)])
            aligned = self.align("".join([x for pair in some for x in pair]))
            if aligned is None or not np.isin(bounds[bounds > 0], aligned.ends).all():
                half = len(some) // 2
                found += [self.settle(some[:half]), self.settle(some[half:])] if half else [Units.broken()]
                continue
            low = np.searchsorted(aligned.ends, bounds[1::2], "right")
            high = np.searchsorted(aligned.ends, bounds[2::2], "right")
            texts, links = aligned.texts(), aligned.links()
            found.append(
                Units(
                    aligned.upto_a[high] - aligned.upto_a[low],
                    aligned.upto_b[high] - aligned.upto_b[low],
                    high - low,
                    links[ragged(low, high - low)],
                    [";".join(texts[i:j]).encode() for i, j in zip(low.tolist(), high.tolist())],
                )
            )
        return Units.joined(found)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> "Block":
        """Aligns the texts of a buffer, each with a space before it; empty ones have no tokens."""
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], 32)
        offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
        starts, rows = self.cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        codes, keys = pd.factorize(self.hashes[0](data, starts, ends))
        first = np.zeros(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        check = self.hashes[1](data, starts, ends)
        kept = self.units.make_room(len(keys))
        if kept is not None:
            self.texts = [self.texts[k] for k in kept.tolist()]
        slots = self.units.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            slots[missing] = self.learn(data, starts, ends, keys[missing], check, first[missing])
        wrong = check != self.units.check[slots[codes]]  # two units with one hash
        at, length = self.units.start[slots], self.units.length[slots].astype(np.int64)
        heads = self.units.ids[at]
        links = self.units.ids[ragged(at + 1, length - 1)]
        block = Block(codes, rows, heads & ~BROKEN, links, length - 1, [self.texts[s] for s in slots.tolist()])
        wrong |= (heads >= BROKEN)[codes]
        for row in np.unique(np.searchsorted(rows, np.flatnonzero(wrong), "right") - 1).tolist():
            aligned = self.align(data[offsets[row] : offsets[row + 1]].tobytes().decode())
            block.replace(row, aligned and Units.whole(aligned))
        return block

    def learn(self, data, starts, ends, keys, check, first) -> np.ndarray:
        """Aligns units met for the first time; their slots."""
        raw = data.tobytes()
        together, alone = [], []
        for k, i in enumerate(first.tolist()):
            low, high = int(starts[i]), int(ends[i])
            text, context = raw[low:high], b""
            if text[:1] != b" ":  # what stands before: a letter, of one byte or two
                context = b" " + raw[low - 2 + (raw[low - 1] < 128) : low]
            # The next unit must be cut off for certain: behind white space and the like it might not be.
            clear = 32 < text[-1] < 127 or (len(text) > 1 and text[-2] == 0xC3 and LATIN[text[-1]])
            (together if clear else alone).append((k, context.decode(), text.decode()))
        ordered = [k for k, *_ in together + alone]
        parts = [self.settle([x[1:] for x in together])] if together else []
        units = Units.joined(parts + [self.settle([x[1:]]) for x in alone])
        # The head of each unit, then its links.
        entries = np.insert(units.links, np.cumsum(units.n_links) - units.n_links, units.heads)
        self.texts += units.texts
        slots = np.empty(len(keys), np.int64)
        slots[ordered] = self.units.keep(keys[ordered], check[first[ordered]], entries, units.n_links + 1)
        return slots


class Block:
    """The units of some texts: what each distinct unit holds, and which units make up each text."""

    def __init__(self, codes, rows, heads, links, n_links, texts: list[bytes]):
        self.units = [codes[a:b] for a, b in zip(rows[:-1], rows[1:])]
        self.heads, self.links, self.n_links, self.texts = heads, links, n_links, texts

    def replace(self, row: int, unit: Units | None) -> None:
        """A text as one unit of its own, or without tokens."""
        if unit is None:
            self.units[row] = self.units[row][:0]
            return
        self.units[row] = np.array([len(self.heads)])
        for x in ("heads", "n_links", "links"):
            setattr(self, x, np.concatenate((getattr(self, x), getattr(unit, x))))
        self.texts += unit.texts

    def rows(self) -> list[np.ndarray | list]:
        """Per text the numbers of tokens of A and B and of groups, the digest of the groups, and its units."""
        low = np.uint64((1 << 31) - 1)
        per_unit = np.stack(((self.heads & low).astype(np.int64), (self.heads >> np.uint64(31)).astype(np.int64), self.n_links))
        flat = np.concatenate(self.units) if self.units else np.zeros(0, np.int64)
        bounds = np.cumsum([0, *map(len, self.units)])
        sums = np.zeros((3, len(flat) + 1), np.int64)
        np.cumsum(per_unit[:, flat], axis=1, out=sums[:, 1:])
        counts = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
        texts = self.texts
        digests = [
            hashlib.sha256(b";".join([texts[u] for u in own.tolist()])).hexdigest() if len(own) else "" for own in self.units
        ]
        return [*counts, digests, [own.astype("<i4").tobytes() for own in self.units]]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The linked pairs, how often each occurs in the block, and the pair of each link of each unit."""
        flat = np.concatenate(self.units) if self.units else np.zeros(0, np.int64)
        times = np.bincount(flat, minlength=len(self.heads))
        pairs, place = np.unique(self.links, return_inverse=True)
        often = np.bincount(place, np.repeat(times, self.n_links), len(pairs)).astype(np.int64)
        return pairs.astype(np.int64), often, place


BLOCKS = (
    "block bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, units binary, "
    "pair array<bigint>, n array<bigint>, links binary, n_links binary"
)


def aligned_blocks(docs: DataFrame, a: str, b: str, doc_id: str, text: str) -> DataFrame:
    """A row per document with its counts, digest and units. The first row of each block of documents also
    holds the block's linked pairs, their numbers, and the pairs of each unit."""
    kind = type_of(docs, doc_id)

    def align(batches):
        own, n_blocks = aligner(a, b), 0
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in slices(*utf8(batch.column("text")), BLOCK_BYTES):
                block = own.block(data, offsets)
                found = block.rows()
                pairs, often, place = block.pairs()
                n = len(offsets) - 1
                rest = [None] * (n - 1)
                columns = [
                    ids.slice(row, n),
                    pa.array([base + n_blocks] * n, pa.int64()),
                    *(pa.array(x) for x in found[:3]),
                    pa.array(found[3], pa.string()),
                    pa.array(found[4], pa.binary()),
                    pa.array([pairs, *rest], pa.list_(pa.int64())),
                    pa.array([often, *rest], pa.list_(pa.int64())),
                    pa.array([place.astype("<i4").tobytes(), *rest], pa.binary()),
                    pa.array([block.n_links.astype("<i4").tobytes(), *rest], pa.binary()),
                ]
                n_blocks += 1
                yield pa.RecordBatch.from_arrays(columns, ["id", *(x.split()[0] for x in BLOCKS.split(", "))])

    own = docs.select(name(doc_id).alias("id"), name(text).alias("text"))
    return settled(own.mapInArrow(align, f"id {kind}, {BLOCKS}"), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, total, best) over all documents: how many links hold a pair linked, and whether no pair with the
    same B token has more. ``pair`` is a << 32 | b."""
    pairs = blocks.where("pair IS NOT NULL").select(F.explode(F.arrays_zip("pair", "n")).alias("x"))
    totals = pairs.groupBy("x.pair").agg(F.sum("x.n").alias("total"))
    totals = settled(totals, "pair-counts")
    token = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = totals.groupBy(token.alias("token")).agg(F.max("total").alias("most"))
    joined = totals.withColumn("token", token).join(most, "token")
    return joined.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row.

    A group ends at each byte where tokens of both sides end; the two tokens that end it are linked.
    ``count_sum`` adds up how often the pair of each link is linked in all rows, ``n_best`` counts links
    whose pair is the most frequent of its B token. Texts that are NULL or empty, or that a side does not
    give back byte by byte, have no tokens: zeros and an empty digest. Repeated rows count as often as they
    occur; ids may be NULL; other columns are ignored.

    Pairs are counted per block of some BLOCK_BYTES, so a frequent pair is one row per block. Corpus-wide counts
    come back to each block by a join, and its documents are summed there. A task holds one block at a time.
    """
    ready(docs.sparkSession)
    blocks = aligned_blocks(docs, a, b, doc_id, text)
    asked = blocks.where("pair IS NOT NULL").select("block", F.posexplode("pair").alias("k", "pair"))
    answers = asked.join(pair_counts(blocks), "pair").select("block", "k", "total", F.col("best").cast("long").alias("best"))
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    id_type = docs.schema[doc_id].dataType

    def add_up(rows: pa.Table, counted: pa.Table) -> pa.Table:
        head = next(i for i, x in enumerate(rows.column("links").to_pylist()) if x is not None)
        place, n_links = (np.frombuffer(rows.column(c)[head].as_py(), "<i4") for c in ("links", "n_links"))
        k = counted.column("k").to_numpy()
        sums = []
        bounds = np.concatenate(([0], np.cumsum(n_links)))
        units = [np.frombuffer(x, "<i4") for x in rows.column("units").to_pylist()]
        flat, upto = np.concatenate(units), np.cumsum([0, *map(len, units)])
        for column in ("best", "total"):
            value = np.zeros(len(k), np.int64)
            value[k] = counted.column(column).to_numpy()
            of_link = np.concatenate(([0], np.cumsum(value[place])))
            of_unit = of_link[bounds[1:]] - of_link[bounds[:-1]]
            of_row = np.concatenate(([0], np.cumsum(of_unit[flat])))
            sums.append(pa.array(of_row[upto[1:]] - of_row[upto[:-1]]))
        held = [rows.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_groups")]
        return pa.table([*held, *sums, rows.column("groups_sha256")], ["id", *counts, "groups_sha256"])

    types = StructType(
        [StructField("id", id_type), *(StructField(c, LongType()) for c in counts), StructField("groups_sha256", StringType())]
    )
    rows = blocks.select("block", "id", "n_a", "n_b", "n_groups", "groups_sha256", "units", "links", "n_links")
    answers = settled(answers, "pair-answers")
    found = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, types)
    return found.withColumnRenamed("id", doc_id)
