"""Column expressions: built-in Spark functions only, so they stay inside code generation."""

from siltstone.functions.keys import hashed, key_text, packed, surrogate_key, unpacked, version_key
from siltstone.functions.predicates import is_positive, is_required
from siltstone.functions.times import date_from_epoch_ms, seconds_between, timestamp_from_epoch_ms
from siltstone.functions.values import (
    as_integer,
    as_long,
    distance,
    id_from_text,
    or_default,
    ratio,
    sentinel_to_null,
    share,
    translate,
)

__all__ = [
    "as_integer",
    "as_long",
    "date_from_epoch_ms",
    "distance",
    "hashed",
    "id_from_text",
    "is_positive",
    "is_required",
    "key_text",
    "or_default",
    "packed",
    "ratio",
    "seconds_between",
    "sentinel_to_null",
    "share",
    "surrogate_key",
    "timestamp_from_epoch_ms",
    "translate",
    "unpacked",
    "version_key",
]
