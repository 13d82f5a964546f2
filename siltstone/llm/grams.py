"""Hashed byte n-grams of many texts at once."""

from __future__ import annotations

import numpy as np

#: ASCII letters in lower case, other ASCII as white space, bytes of other letters as they are.
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]


def gram_index(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each place, the bucket (of 2**bits) of the n bytes from there on; the last n-1 places have none."""
    m = max(len(data) - n + 1, 0)
    code = np.zeros(m, np.uint32)
    for j in range(n):
        code = (code ^ data[j : j + m]) * np.uint32(0x9E3779B1)
    return (code >> np.uint32(32 - bits)).astype(np.int32)


def gram_ranges(offsets: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the range of places whose n-grams lie inside it."""
    low = np.minimum(offsets[:-1], m)
    return low, np.clip(offsets[1:] - n + 1, low, m)


def gram_counts(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Counts per row and bucket."""
    index = gram_index(data, n, bits)
    low, high = gram_ranges(offsets, n, len(index))
    out = np.zeros((len(low), 1 << bits), np.float32)
    for k, (a, b) in enumerate(zip(low, high)):
        out[k] = np.bincount(index[a:b], minlength=1 << bits)
    return out
