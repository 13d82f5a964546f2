"""DataFrame operators: functions from DataFrames and column names to a DataFrame."""

from siltstone.operators.aggregates import play_rollup
from siltstone.operators.checks import (
    CheckFailed,
    arriving_keys_unique,
    enforce,
    has_rows,
    keys_unique,
    null_ratio_below,
)
from siltstone.operators.joins import (
    join_pairs,
    keep_known,
    lookup,
    membership,
    tolerance_join,
    zero_fill_join,
)
from siltstone.operators.rows import drop_duplicate_keys, top_row, union_tagged

__all__ = [
    "CheckFailed",
    "arriving_keys_unique",
    "drop_duplicate_keys",
    "enforce",
    "has_rows",
    "join_pairs",
    "keep_known",
    "keys_unique",
    "lookup",
    "membership",
    "null_ratio_below",
    "play_rollup",
    "tolerance_join",
    "top_row",
    "union_tagged",
    "zero_fill_join",
]
