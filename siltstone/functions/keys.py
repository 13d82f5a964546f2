"""Deterministic surrogate keys: SHA-256 over colon-separated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ":"
DIGEST_BITS = 256


def key_text(*parts: Column | str) -> Column:
    """The non-NULL parts as one text. A NULL part is left out, so the text gets shorter."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.concat_ws(SEPARATOR, *texts)


def hashed(text: Column | str) -> Column:
    return F.sha2(F.col(text) if isinstance(text, str) else text, DIGEST_BITS)


def surrogate_key(*parts: Column | str) -> Column:
    """Hash of the non-NULL parts."""
    return hashed(key_text(*parts))


def version_key(owner: Column | str, measure: Column | str) -> Column:
    """Hash of an id and the text of a DOUBLE; NULL when either is NULL.

    The measure is cast first, so ``218`` and ``218.0`` give one key.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    measure = F.col(measure) if isinstance(measure, str) else measure
    text = F.concat(owner.cast("string"), F.lit(SEPARATOR), measure.cast("double").cast("string"))
    return hashed(text)


def packed(text: Column | str) -> Column:
    """One to one: a lower-case hex digest as bytes, half as long in a shuffle; other text as it is. NULL stays NULL.

    The first byte tells the two apart. Digests keep their order, as does other text.
    """
    text = F.col(text) if isinstance(text, str) else text
    digest = F.unhex(text)
    kept = F.concat(F.lit(bytearray(b"\0")), text.cast("binary"))
    return F.when(F.lower(F.hex(digest)) == text, F.concat(F.lit(bytearray(b"\1")), digest)).otherwise(kept)


def unpacked(key: Column | str) -> Column:
    """The text of a ``packed`` key."""
    key = F.col(key) if isinstance(key, str) else key
    rest = F.substring(key, 2, 1 << 30)
    return F.when(F.substring(key, 1, 1) == F.lit(bytearray(b"\1")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
