"""Casts, defaults and guarded arithmetic."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# A sign and digits, with the white space and control characters that a cast trims.
WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_long(value: Column | str) -> Column:
    """BIGINT, or NULL where the text is not a number (also under ANSI mode)."""
    return _col(value).try_cast("long")


def id_from_text(value: Column | str) -> Column:
    """BIGINT from an id that arrives as text or as any number, or NULL.

    JSON inference makes a column DOUBLE as soon as one id is written ``39.0``; numbers are cast as they
    are. A failed ``try_cast`` costs as much as an exception, so text that cannot be a whole number is
    sorted out by its shape first; what remains may still be too large and become NULL. The type is
    known when the query is planned, so only one of the two branches remains.
    """
    given = _col(value)
    is_text = F.typeof(given) == "string"
    text = given.cast("string")
    return F.when(~is_text, given.try_cast("long")).when(text.rlike(WHOLE_NUMBER), text.try_cast("long"))


def as_integer(value: Column | str) -> Column:
    return _col(value).try_cast("int")


def sentinel_to_null(value: Column | str, sentinel: Any = 0) -> Column:
    return F.nullif(_col(value), F.lit(sentinel))


def or_default(value: Column | str, default: Any) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def distance(left: Column | str, right: Column | str) -> Column:
    return F.abs(_col(left) - _col(right))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Floating-point quotient; the caller keeps zero away from ``whole``."""
    return _col(part).cast("double") / _col(whole)


def share(part: Column | str, total: Column | str) -> Column:
    """``part / total``, and 0.0 where the total is 0 or missing."""
    counted = or_default(total, 0)
    return F.when(counted == 0, F.lit(0.0)).otherwise(ratio(part, counted))


def translate(value: Column | str, mapping: Mapping[Any, Any]) -> Column:
    """Value lookup as a CASE without ELSE: unlisted values become NULL."""
    value = _col(value)
    result = None
    for key, target in mapping.items():
        step = F if result is None else result
        result = step.when(value == key, F.lit(target))
    if result is None:
        raise ValueError("translate needs at least one mapping entry")
    return result
