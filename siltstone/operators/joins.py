"""Equi joins in the shapes the layers need.

Sides are never broadcast by hand: adaptive execution broadcasts a side once its measured size is
under the configured threshold, and splits skewed partitions of sort-merge joins otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import distance, or_default


def _disjoint(left: Sequence[str], right: Sequence[str]) -> None:
    shared = sorted(set(left) & set(right))
    if shared:
        raise ValueError(f"columns on both join sides: {shared}")


def _pair_condition(pairs: Mapping[str, str]) -> Column:
    return reduce(and_, (F.col(f"l.{a}") == F.col(f"r.{b}") for a, b in pairs.items()))


def keep_known(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fact rows whose key exists in the dimension; never multiplies rows."""
    return facts.join(dimension.select(*keys), list(keys), "left_semi")


def join_pairs(left: DataFrame, right: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Inner equi join on differently named columns, given as ``{left name: right name}``."""
    _disjoint(left.columns, right.columns)
    return left.alias("l").join(right.alias("r"), _pair_condition(pairs), "inner")


def lookup(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer join that adds dimension columns to every fact row."""
    return facts.join(dimension, list(keys), "left")


def zero_fill_join(
    dimension: DataFrame, measures: DataFrame, keys: Sequence[str], defaults: Mapping[str, Any]
) -> DataFrame:
    """Every dimension row with its measures; a missing measure takes its default."""
    joined = dimension.join(measures, list(keys), "left")
    return joined.withColumns({name: or_default(name, value) for name, value in defaults.items()})


def membership(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Adds a boolean: does the key occur among ``members``? Rows are not multiplied."""
    present = members.select(*keys).distinct().withColumn(flag, F.lit(True))
    return df.join(present, list(keys), "left").withColumn(flag, or_default(flag, False))


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Mapping[str, str],
    left_value: str,
    right_value: str,
    tolerance: float,
) -> DataFrame:
    """Inner join on equal ``pairs`` and ``abs(right_value - left_value) < tolerance``.

    Values are cut into cells wider than the tolerance and the cell joins as one more equi key, so
    a key with many rows on both sides yields near matches only instead of all pairs. A right row
    is listed in the cells of both ends of its reach, which are equal or adjacent. Subtraction,
    division and floor are monotone in floating point as well, so no match falls outside them, and
    a left row has one cell, so no match is found twice.
    """
    _disjoint(left.columns, right.columns)
    width = tolerance * 8

    def cell(value: Column) -> Column:
        return F.floor(value / F.lit(width))

    reach = F.array_distinct(
        F.array(cell(F.col(right_value) - tolerance), cell(F.col(right_value) + tolerance))
    )
    celled_right = right.where(F.col(right_value).isNotNull()).withColumn(
        "_right_cell", F.explode(reach)
    )
    near = distance(f"r.{right_value}", f"l.{left_value}") < tolerance
    # The left cell is no column: it is worked out where it is needed, and not shuffled.
    same_cell = cell(F.col(f"l.{left_value}")) == F.col("r._right_cell")
    return (
        left.alias("l")
        .join(celled_right.alias("r"), _pair_condition(pairs) & same_cell & near, "inner")
        .drop("_right_cell")
    )
