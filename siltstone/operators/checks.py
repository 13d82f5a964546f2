"""Data-quality checks: each returns one row with ``passed`` 1 or 0."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """A data-quality check returned 0."""


def _verdict(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).alias("passed")


def has_rows(df: DataFrame) -> DataFrame:
    return df.agg(_verdict(F.count("*") > 0))


def keys_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Is every row's key its own?

    A single NULL key fails, as it is not counted as a value. In a composite key, NULL counts as a
    value of its own.
    """
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    return df.select(key.alias("key")).agg(_verdict(F.count("*") == F.countDistinct("key")))


def arriving_keys_unique(df: DataFrame, arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Is every key among ``arrivals`` the key of one row? The verdict of ``keys_unique`` on a table whose other
    keys are known to be unique.

    Only rows with such a key are gathered by it; ``arrivals``, usually one interval, is the side of the join
    that can be broadcast.
    """
    named = arrivals.select(*(F.col(k).alias(f"{k}_") for k in keys)).distinct()
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys))
    return keys_unique(df.select(*keys).join(named, same, "left_semi"), keys)


def null_ratio_below(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Is the share of NULLs under the limit? An empty table passes."""
    total = F.count("*")
    missing = F.count_if(F.col(column).isNull())
    return df.agg(
        F.when(total == 0, 1).when(missing.cast("double") / total < limit, 1).otherwise(0).alias("passed")
    )


def enforce(check: DataFrame, label: str) -> None:
    """Raise unless the one-row check passed."""
    if check.first()["passed"] != 1:
        raise CheckFailed(label)
