"""Play statistics at a chosen grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def play_rollup(
    plays: DataFrame,
    keys: Sequence[str],
    *,
    plays_as: str,
    distinct: Mapping[str, str],
    first_as: str,
    last_as: str,
    time: str = "ts",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Row count, exact distinct counts (``{output: column}``) and time span per key.

    Spark plans the distinct counts as an aggregate per (key, value) followed by one per key, both
    with map-side combining, so one key's rows are spread over reducers by value.
    """
    return plays.groupBy(*keys).agg(
        F.count("*").alias(plays_as),
        *(F.countDistinct(column).alias(name) for name, column in distinct.items()),
        F.min(time).alias(first_as),
        F.max(time).alias(last_as),
        *extra,
    )


def count_where(condition: Column) -> Column:
    """Rows on which the condition holds, as BIGINT."""
    return F.count_if(condition)


def sum_or_zero(value: Column | str) -> Column:
    """SUM of a DOUBLE, 0.0 for a group that has only NULLs."""
    return F.coalesce(F.sum(value), F.lit(0.0))
