"""Token counts, packing and sequence files against the tokenizer libraries themselves."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer
from llm_cases import documents, hard, no_docs  # noqa: F401

from siltstone.llm import binary_output, packing, queries, token_counts
from siltstone.llm.common import utf8
from siltstone.llm.tokens import WordEncoder, encoder

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(WORDS))


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_counts_of_all_documents(spark, small, documents, pieces):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op1_token_counts(spark, small).collect()}
    for r in documents.collect():
        n = len(pieces.encode(r.text))
        assert found[r.doc_id] == (len(r.text.encode()), n, n > 4096)


@pytest.mark.parametrize("chunk, overlap", [(32_768, 1024), (512, 16)])
def test_counts_of_hard_texts_in_chunks(hard, pieces, chunk, overlap):
    """Chunks splice exactly; a text of one letter has no stable place and widens to the whole text."""
    found = token_counts.token_counts(hard, PIECES, chunk=chunk, overlap=overlap).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(pieces.encode(r.text or ""))) for r in hard.collect()]
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in found) == Counter(want)


def test_stable_places_split_exactly(pieces):
    model = token_counts.piece_model(PIECES)
    text = "It was überall, 12 times\n你好  again; aaaaabbbb cc"
    for p in range(1, len(text)):
        if model.is_stable(text[p - 1], text[p]):
            left, whole = model.count_between(text, 0, p), len(pieces.encode(text))
            assert left + model.count_between(text, p, len(text)) == whole and left == len(pieces.encode(text[:p]))


def test_no_documents(no_docs):
    assert token_counts.token_counts(no_docs, PIECES).count() == 0
    assert packing.packed_documents(no_docs, WORDS, 0).count() == 0
    spark = no_docs.sparkSession
    manifest = binary_output.write_sequences(no_docs, binary_output.sequence_folder(spark), WORDS, 1)
    assert binary_output.read_documents(manifest).count() == 0


def test_words_encode_as_whole_texts(hard, documents, tokenizer):
    texts = [r.text for r in hard.collect()] + [r.text for r in documents.collect()]
    texts += ["É ́x", "ΣΑΣ İ's", "don't I'LL a b\x1cc", "a\x00b\n\r\x0b\x0c d"]
    for encode in (encoder(WORDS), WordEncoder(public_tokenizers.path(WORDS), limit=50)):
        ids, bounds = encode.encode(*utf8(pa.array(texts)))
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tokenizers_that_see_white_space_encode_whole_texts():
    encode = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encode.apart
    ids, bounds = encode.encode(*utf8(pa.array(["a  b", None, " x\n"])))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids.tolist() == [i for t in ("a  b", "", " x\n") for i in plain.encode(t, add_special_tokens=False).ids]
    assert bounds[1] == bounds[2]


def test_plans_are_gapless_and_tight():
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([10, 30, 64, 101])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        counts = Counter(sizes)
        plan = packing.Plan(dict(counts), capacity)
        bins = defaultdict(list)
        for size, n in counts.items():
            for b, o in zip(*packing.placed(plan.tables(), np.full(n, size), np.arange(n))):
                bins[int(b)].append((int(o), size))
        assert sum(map(len, bins.values())) == len(sizes) and len(bins) == plan.n_bins
        for items in bins.values():
            at = 0
            for offset, size in sorted(items):
                assert offset == at
                at += size
            assert at <= capacity and sum(3 * s > capacity for _, s in items) <= 2
        assert plan.n_bins <= 11 / 9 * -(-sum(sizes) // capacity) + sum(2 * s > capacity for s in sizes) + 1


def test_large_items_pair():
    assert packing.Plan({60: 10, 40: 10}, 100).n_bins == 10
    assert packing.Plan({50: 7}, 100).n_bins == 4
    assert packing.Plan({70: 4, 10: 12}, 100).n_bins == 4


def pieces_of(docs, tokenizer):
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            yield r.doc_id, k // 2048, k, len(part), crc(part)


def check_packing(found, want):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [tuple(None if x != x else x for x in r) for r in found[columns].itertuples(index=False, name=None)]
    assert Counter(rows) == Counter(want)
    ordered = found.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ordered.offset == ends - ordered.length).all() and ends.max() <= 2048


def test_packing(spark, small, documents, tokenizer):
    found = queries.op3_best_fit_packing(spark, small).toPandas()
    check_packing(found, pieces_of(documents, tokenizer))
    assert found.sequence_id.nunique() <= 1.01 * found.length.sum() / 2048 + 1


def test_packing_hard_documents(hard, tokenizer):
    check_packing(packing.packed_documents(hard, WORDS, 0).toPandas(), pieces_of(hard, tokenizer))


def test_packing_refuses_sizes_it_cannot_place(spark):
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame([(0,)], "length long"))


def expected_sequences(docs, tokenizer):
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    at = 0
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        yield r.doc_id, at, len(ids), crc(ids)
        at += len(ids)


def test_sequence_files(spark, small, documents, tokenizer):
    found = queries.op8_binary_output(spark, small).collect()
    assert Counter(map(tuple, found)) == Counter(expected_sequences(documents, tokenizer))


def test_sequence_files_of_hard_documents(hard, spark, tokenizer):
    manifest = binary_output.write_sequences(hard, binary_output.sequence_folder(spark), WORDS, 1, length=64, files=3)
    found = binary_output.read_documents(manifest).collect()
    assert Counter(map(tuple, found)) == Counter(expected_sequences(hard, tokenizer))


def test_sequences_are_found_without_reading_others(spark, documents, tokenizer):
    manifest = binary_output.write_sequences(documents, binary_output.sequence_folder(spark), WORDS, 1, files=1)
    row = manifest.first()
    file = binary_output.SequenceFile(f"{row.path}.arrow")
    stream = [
        i
        for r in documents.orderBy("doc_id").collect()
        for i in [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
    ]
    last = row.n_tokens // 2048
    for n in (0, 1, 70, last):
        ids, mask = file.sequence(n)
        real = stream[n * 2048 : (n + 1) * 2048]
        assert ids[: len(real)].tolist() == real and mask.to_pylist() == [k < len(real) for k in range(2048)]
    base = ids.__array_interface__["data"][0]
    again = file.sequence(last)[0].__array_interface__["data"][0]
    assert base == again and not ids.flags.owndata
    file.close()


NASTY = list("aZéÉÞ÷×ıİßŒœKÅ.,'’!<>|-_0 9\n\t") + [
    "'s", "'LL", "é.", "Á", "Ẹ́", "≠", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "</w>", "你", " ", "Σ", "\U0001d11e",
]


@pytest.mark.parametrize("limit", [40, 1_000_000])
def test_cut_words_encode_as_whole_texts(tokenizer, limit):
    """Also where words are cut before punctuation, lower-cased early, and forgotten and met again."""
    rng = random.Random(5)
    own = WordEncoder(public_tokenizers.path(WORDS), limit)
    assert own.finer
    for _ in range(30):
        texts = ["".join(rng.choices(NASTY, k=rng.randrange(30))) for _ in range(100)]
        ids, bounds = own.encode(*utf8(pa.array(texts)))
        for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_word_table_forgets_and_finds():
    """A table under its limit finds every word; beyond it, words met again stay."""
    from siltstone.llm.tokens import WordTable

    rng = np.random.default_rng(3)
    words, limit = WordTable(1000, np.uint16), 1000
    often = rng.integers(0, 2**63, 200, dtype=np.uint64)
    for _ in range(40):
        keys = np.unique(np.concatenate((often, rng.integers(0, 2**63, 150, dtype=np.uint64))))
        words.make_room(len(keys))
        slots = words.find(keys)
        new = keys[slots < 0]
        words.keep(new, new + np.uint64(1), (new % 60_000).astype(np.uint32), np.ones(len(new), np.int64))
        found = words.find(keys)
        assert (words.check[found] == keys + np.uint64(1)).all() and words.n <= limit
        assert (words.ids[words.start[found]] == keys % 60_000).all()
    assert (words.find(often) >= 0).all()


def test_equal_ids_and_rows_spread_over_files(spark, tokenizer):
    """A third of all rows under one id, another third equal in everything: no file holds them all."""
    rows = [(5, f"text {k} of one id", k) for k in range(300)] + [(7, "the same row", 0)] * 300
    rows += [(k, f"document {k}", 0) for k in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    manifest = binary_output.write_sequences(docs, binary_output.sequence_folder(spark), WORDS, 1, length=64, files=9)
    assert manifest.agg({"n_docs": "max"}).first()[0] < 200
    found = binary_output.read_documents(manifest).collect()
    assert Counter(map(tuple, found)) == Counter(expected_sequences(docs, tokenizer))
