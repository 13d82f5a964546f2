"""Token ids of whole texts by the tokenizers library, with repeated words encoded once.

Where a tokenizer provably treats words between ASCII white space alone (it collapses white space,
then keeps only matches of a pattern without white space, and its added tokens neither contain nor
eat white space), the ids of a text are those of its words, one after the other. Each word is then
encoded once per process and looked up by two independent 64-bit hashes. Otherwise whole texts are
encoded.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd

from siltstone.llm.common import WordHashes, mixed, ragged, slices, tokenizer_file, word_bounds

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_ENCODERS: dict[str, "WordEncoder"] = {}


def encoder(file: str) -> "WordEncoder":
    """The encoder of a vocabulary file, one per process."""
    if file not in _ENCODERS:
        _ENCODERS[file] = WordEncoder(tokenizer_file(file))
    return _ENCODERS[file]


def parts(spec: dict | None, inner: str) -> list[dict]:
    return [] if not spec else spec.get(inner, [spec])


def words_apart(spec: dict) -> bool:
    """Whether the ids of a text are those of its words between ASCII white space."""
    collapses = any(
        p.get("type") == "Replace" and p.get("pattern") == {"Regex": "\\s+"} and p.get("content") == " "
        for p in parts(spec.get("normalizer"), "normalizers")
    )
    local = all(
        p.get("type") in ("NFC", "NFD", "NFKC", "NFKD", "Replace", "Lowercase")
        for p in parts(spec.get("normalizer"), "normalizers")
    )
    first = (parts(spec.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
    pattern = str(first.get("pattern", {}).get("Regex", " "))
    drops = (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and not any(x in pattern for x in (" ", "\\s+", "\\s*", "(?", ".", "\\W", "\\b", "^|", "$"))
    )
    added = all(
        not (t["single_word"] or t["lstrip"] or t["rstrip"]) and not any(c.isspace() for c in t["content"])
        for t in spec.get("added_tokens", [])
    )
    plain = spec.get("post_processor") is None and spec.get("truncation") is None
    return collapses and local and drops and added and plain


def letter_runs(spec: dict) -> bool:
    """Whether texts may also be cut where a letter meets ASCII punctuation, and lower-cased first.

    True for the one pattern below with lower-casing and NFC: a match never spans a letter and what is
    none, and a match that begins there does not look back. Added tokens must begin with ``<``: words
    that hold one are left as they are.
    """
    steps = [p.get("type") for p in parts(spec.get("normalizer"), "normalizers")]
    first = (parts(spec.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
    return (
        words_apart(spec)
        and steps == ["NFC", "Replace", "Lowercase"]
        and first.get("pattern", {}).get("Regex") == LETTER_PATTERN
        and all(t["content"].startswith("<") for t in spec.get("added_tokens", []))
        and bool(spec["model"].get("end_of_word_suffix"))
    )


# Fixed value: the split pattern of tokenizers whose words are runs of letters.
LETTER_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[33:127] = True
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = False
#: Bytes that, after C3, make a letter between U+00C0 and U+00FF (all but the signs of times and division).
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False
#: What may follow a capital so that it is lower-cased alone: no combining mark begins with these.
PLAIN_NEXT = np.zeros(256, bool)
PLAIN_NEXT[:128] = PLAIN_NEXT[0xC3] = True


def letter_pieces(data: np.ndarray, offsets: np.ndarray):
    """(bytes, starts, ends, rows, other): words cut before punctuation that follows a letter, capitals of
    U+0041 to U+00FF lower-cased, and how many bytes before each place belong to no such letter."""
    starts, ends, rows = word_bounds(data, offsets)
    n = len(data)
    if not n:
        return data, starts, ends, rows, np.zeros(1, np.int32)
    lead = data == 0xC3
    second = np.zeros(n, bool)
    np.logical_and(lead[:-1], LATIN[data[1:]], out=second[1:])
    lead[:-1] &= second[1:]
    last = ASCII_LETTER[data] | second  # last byte of a letter
    lowered = data.copy()
    capital = ((data >= 65) & (data <= 90)) | (second & (data <= 0x9E))
    capital[:-1] &= PLAIN_NEXT[data[1:]]
    lowered[capital] += 32
    cuts = np.flatnonzero(last[:-1] & PUNCTUATION[data[1:]]) + 1
    marked = np.flatnonzero(data == 60)
    if len(marked):
        marked = np.unique(np.searchsorted(starts, marked, "right") - 1)
        at = ragged(starts[marked], (ends - starts)[marked])
        lowered[at] = data[at]
        cuts = cuts[~np.isin(np.searchsorted(starts, cuts, "right") - 1, marked)]
    starts = np.sort(np.concatenate((starts, cuts)))
    ends = np.sort(np.concatenate((ends, cuts)))
    other = np.zeros(n + 1, np.int32)
    np.cumsum(~(last | lead), out=other[1:])
    return lowered, starts, ends, np.searchsorted(starts, offsets), other


class WordTable:
    """Ids of words by their hash, in arrays with open addressing.

    Beyond ``limit`` words the older part goes: only words met again since the last time stay, the newest
    half of the limit at most. A second hash tells words of one hash apart.
    """

    def __init__(self, limit: int, kind: type):
        self.limit, self.kind = limit, kind
        self.n = self.used = 0
        self.grow(1 << 16)
        self.ids = np.zeros(1 << 18, kind)
        self.address()

    def grow(self, size: int) -> None:
        for attribute, kind in (("key", np.uint64), ("check", np.uint64), ("start", np.int64), ("length", np.int32), ("met", bool)):
            held = np.zeros(size, kind)
            held[: self.n] = getattr(self, attribute, held)[: self.n]
            setattr(self, attribute, held)

    def address(self) -> None:
        self.table = np.full(2 * len(self.key), -1, np.int32)
        self.enter(np.arange(self.n))

    def enter(self, slots: np.ndarray) -> None:
        mask = np.uint64(len(self.table) - 1)
        at = mixed(self.key[slots]) & mask
        while len(slots):
            free = self.table[at] < 0
            self.table[at[free]] = slots[free]
            waits = self.table[at] != slots
            slots, at = slots[waits], (at[waits] + np.uint64(1)) & mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for unknown ones."""
        mask = np.uint64(len(self.table) - 1)
        found = np.full(len(keys), -1, np.int64)
        todo, at = np.arange(len(keys)), mixed(keys) & mask
        while len(todo):
            slots = self.table[at]
            same = (slots >= 0) & (self.key[slots] == keys[todo])
            found[todo[same]] = slots[same]
            more = (slots >= 0) & ~same
            todo, at = todo[more], (at[more] + np.uint64(1)) & mask
        self.met[found[found >= 0]] = True
        return found

    def make_room(self, more: int) -> np.ndarray | None:
        """Room for so many further words. Where words went, the former slots of those that stay, in their
        new order: slots found before do not hold any more."""
        kept = None
        if self.n and (self.n + more > self.limit or self.used > 8 * self.limit):
            kept = np.flatnonzero(self.met[: self.n])[-(self.limit // 2) :]
            ids = self.ids[ragged(self.start[kept], self.length[kept].astype(np.int64))]
            for attribute in ("key", "check", "length"):
                held = getattr(self, attribute)
                held[: len(kept)] = held[kept]
            self.n, self.used = len(kept), len(ids)
            self.ids = np.concatenate((ids, np.zeros(max(len(ids), 1 << 18), self.kind)))
            self.start[: self.n] = np.cumsum(self.length[: self.n]) - self.length[: self.n]
            self.met[:] = False
            self.address()
        size = len(self.key)
        while self.n + more > size:
            size *= 2
        if size > len(self.key):
            self.grow(size)
            self.address()
        return kept

    def keep(self, keys: np.ndarray, check: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Stores words that are not known, after ``make_room``; their slots."""
        slots = np.arange(self.n, self.n + len(keys))
        if self.used + len(ids) > len(self.ids):
            more = max(len(self.ids), len(ids))
            self.ids = np.concatenate((self.ids, np.zeros(more, self.kind)))
        self.key[slots], self.check[slots], self.length[slots], self.met[slots] = keys, check, counts, False
        self.start[slots] = self.used + np.cumsum(counts) - counts
        self.ids[self.used : self.used + len(ids)] = ids
        self.n, self.used = self.n + len(keys), self.used + len(ids)
        self.enter(slots)
        return slots


class WordEncoder:
    """Ids for buffers of texts. ``limit`` bounds the words kept, by their number."""

    def __init__(self, path: str, limit: int = 1_200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.apart, self.finer = words_apart(spec), letter_runs(spec)
        self.hashes = WordHashes(11), WordHashes(12)
        size = self.tokenizer.get_vocab_size()
        self.words = WordTable(limit, np.uint16 if size <= 1 << 16 else np.uint32)
        if self.finer:
            self.last = np.zeros(size, bool)
            suffix = spec["model"]["end_of_word_suffix"]
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the offsets of the rows in them."""
        found = [self.encode_slice(part, bounds) for _, part, bounds in slices(data, offsets)]
        ids = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint32)
        counts = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
        return ids, np.concatenate(([0], np.cumsum(counts)))

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.array([i for x in encoded for i in x], np.uint32), counts

    def runs(self, words: list[bytes], together: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters, many in one text: each ends with the only id that ends a word."""
        texts = [b" ".join(words[k : k + together]).decode() for k in range(0, len(words), together)]
        ids, _ = self.whole(texts)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self.whole([w.decode() for w in words])
        return ids, np.diff(ends, prepend=0)

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def by_rows() -> tuple[np.ndarray, np.ndarray]:
            raw = data.tobytes()
            return self.whole([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])

        if not self.apart:
            return by_rows()
        if self.finer:
            buffer, starts, ends, rows, other = letter_pieces(data, offsets)
        else:
            buffer, other = data, None
            starts, ends, rows = word_bounds(data, offsets)
        codes, keys = pd.factorize(self.hashes[0](buffer, starts, ends))
        first = np.zeros(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        check = self.hashes[1](buffer, starts, ends)
        self.words.make_room(len(keys))
        slots = self.words.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            raw = buffer.tobytes()
            low, high = starts[first[missing]], ends[first[missing]]
            plain = (other[low] == other[high]) & (low < high) if self.finer else np.zeros(len(missing), bool)
            for chosen, encode in ((plain, self.runs), (~plain, lambda words: self.whole([w.decode() for w in words]))):
                if chosen.any():
                    ids, counts = encode([raw[a:b] for a, b in zip(low[chosen], high[chosen])])
                    at = missing[chosen]
                    slots[at] = self.words.keep(keys[at], check[first[at]], ids, counts)
        of_word = slots[codes]
        if (check != self.words.check[of_word]).any():  # two words with one hash: leave the table aside
            return by_rows()
        lengths = self.words.length[of_word].astype(np.int64)
        ids = self.words.ids[ragged(self.words.start[of_word], lengths)].astype(np.uint32)
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(sums[rows])
