"""Token alignment against a plain version that walks both token lists."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from llm_cases import documents, hard, no_docs  # noqa: F401

from siltstone.llm import alignment, queries

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
NASTY = list("aZéÉÞ÷×ıİßŒœKÅ.,'’!<>|-_0 9\n\t") + [
    "'s", " a", " the", "'LL", "é.", "Á", "▁", " ", " ", "  ", "\u0085", "\0", "\r\n", "<|endoftext|>", "<s>",
    "<0x0A>", "你好", "\U0001d11e", "  ", "  ", "   x", "hello", "World", "été", "ment",
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path(BYTES))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))


def tokens(both, text: str):
    """(ids of A, their ends, ids of B, their ends) or None; ends in bytes of a space and the text."""
    a, b = both
    letters = alignment.byte_alphabet()
    coded, pieces = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    own = [bytes(letters[c] for c in t) for t in coded.tokens]
    other = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in pieces
    ]
    if not text or any(b"".join(x) != (" " + text).encode() for x in (own, other)):
        return None
    return coded.ids, np.cumsum([len(x) for x in own]).tolist(), pieces, np.cumsum([len(x) for x in other]).tolist()


def plainly(both, rows) -> Counter:
    count, links, groups, found = Counter(), [], [], [tokens(both, t or "") for _, t in rows]
    for t in found:
        groups.append([])
        links.append([])
        if t:
            a, ends_a, b, ends_b = t
            i = j = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                groups[-1].append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
                links[-1].append((a[x - 1], b[y - 1]))
                i, j = x, y
        count.update(links[-1])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return Counter(
        (
            *(doc_id, len(t[0]) if t else 0, len(t[2]) if t else 0, len(g), len(k)),
            *(sum(count[x] == best[x[1]] for x in k), sum(count[x] for x in k)),
            hashlib.sha256(";".join(g).encode()).hexdigest() if t else "",
        )
        for (doc_id, _), t, k, g in zip(rows, found, links, groups)
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_nasty_texts(spark, both, monkeypatch, block_bytes):
    """Also texts cut into units, across many blocks, and a long text without a place to cut."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    rng = random.Random(block_bytes)
    rows = [(i, "".join(rng.choices(NASTY, k=rng.randrange(40)))) for i in range(800)]
    rows += [(7, "x" * 3000), (7, "the, the. été " * 5000), (None, " a"), (8, " a"), (8, " a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = alignment.alignments(docs, BYTES, PIECES).collect()
    assert Counter(map(tuple, found)) == plainly(both, rows)


def test_hard_rows_and_clashing_columns(hard, no_docs, both):
    found = alignment.alignments(hard, BYTES, PIECES).collect()
    assert Counter(map(tuple, found)) == plainly(both, [(r.doc_id, r.text) for r in hard.collect()])
    assert alignment.alignments(no_docs, BYTES, PIECES).count() == 0


def test_all_documents(spark, small, documents, both):
    found = queries.op11_tokenizer_alignment(spark, small).collect()
    assert Counter(map(tuple, found)) == plainly(both, [(r.doc_id, r.text) for r in documents.collect()])


def test_units_are_forgotten_and_met_again(both):
    """A small table of units gives the same as a large one."""
    rng = random.Random(9)
    few = alignment.Aligner(BYTES, PIECES, limit=60)
    for _ in range(20):
        texts = ["".join(rng.choices(NASTY, k=30)) for _ in range(20)]
        raw = [t.encode() for t in texts]
        data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        n_a, _, n_groups, digests, _ = few.block(data, bounds).rows()
        for k, text in enumerate(texts):
            want = next(iter(plainly(both, [(0, text)])))
            assert (n_a[k], n_groups[k], digests[k]) == (want[1], want[3], want[7])
        assert len(few.texts) == few.units.n


def test_shared_and_empty_spans_follow_decoded_bytes():
    """Three tokens of one character, and byte pieces whose spans are empty but for the last."""
    starts, ends = np.array([0, 2, 2, 2, 5]), np.array([2, 5, 5, 5, 6])
    assert alignment.refined(starts, ends, np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]
    starts, ends = np.array([0, 1, 1, 1, 1, 5]), np.array([1, 1, 1, 1, 5, 6])
    assert alignment.refined(starts, ends, np.array([1, 1, 1, 1, 1, 1])).tolist() == [1, 2, 3, 4, 5, 6]
