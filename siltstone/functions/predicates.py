"""Row predicates that Parquet can evaluate during the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_required(value: Column | str) -> Column:
    """Neither NULL nor the empty string. Non-text values are compared as text."""
    value = _col(value)
    return value.isNotNull() & (value.cast("string") != "")


def is_positive(value: Column | str) -> Column:
    """A number above zero; text that is no number is none. On DOUBLE columns the cast falls away."""
    value = _col(value)
    return value.isNotNull() & (value.try_cast("double") > 0)
