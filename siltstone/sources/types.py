"""Fits the column types of a batch to those of its table, without losing a value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type that holds numbers of both, if they are plain numbers."""
    if isinstance(left, WHOLE) and isinstance(right, WHOLE):
        return max(left, right, key=lambda t: WHOLE.index(type(t)))
    numbers = WHOLE + FRACTIONAL
    return T.DoubleType() if isinstance(left, numbers) and isinstance(right, numbers) else None


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def changed_by_cast(df: DataFrame, casts: Mapping[str, T.DataType]) -> dict[str, int]:
    """For each column, how many of its values do not come back from a cast; one pass over ``df``."""
    if not casts:
        return {}

    def changed(name: str, kind: T.DataType) -> Column:
        value = _column(name)
        back = value.try_cast(kind).try_cast(df.schema[name].dataType)
        return F.count_if(value.isNotNull() & ~value.eqNullSafe(back)).alias(name)

    return df.agg(*(changed(name, kind) for name, kind in casts.items())).first().asDict()


def filled(df: DataFrame, names: list[str]) -> set[str]:
    """Those columns that hold a value; one pass over ``df``."""
    if not names:
        return set()
    counts = df.agg(*(F.count(_column(name)).alias(name) for name in names)).first().asDict()
    return {name for name, n in counts.items() if n}


def fitted(batch: DataFrame, target: DataFrame, table: str, widen: bool) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The batch in the types of the target, and the target columns that must become wider first.

    Columns without a value take any type. Numbers that all come back from a cast are cast, numbers go
    into text columns, and with ``widen`` a number that does not fit widens the column. Anything else
    is refused by name, so no value is ever stored changed.
    """
    held = {f.name: f.dataType for f in target.schema}
    differing = [f.name for f in batch.schema if f.name in held and f.dataType != held[f.name]]
    with_values = filled(batch, differing)
    numbers = WHOLE + FRACTIONAL

    def castable(name: str) -> bool:
        return isinstance(batch.schema[name].dataType, numbers) and isinstance(held[name], (*numbers, T.StringType))

    casts = {name: held[name] for name in differing}
    changed = changed_by_cast(batch, {n: held[n] for n in with_values if castable(n)})
    wider: dict[str, T.DataType] = {}
    for name in sorted(with_values):
        if changed.get(name) == 0:
            continue
        shared = common_type(batch.schema[name].dataType, held[name])
        if shared is None or not widen:
            kinds = (batch.schema[name].dataType.simpleString(), held[name].simpleString())
            raise ValueError(f"{table}.{name}: values of type {kinds[0]} do not fit the column's {kinds[1]}")
        wider[name] = casts[name] = shared
    for side, kinds in ((batch, wider), (target, wider)):
        for name, n in changed_by_cast(side, kinds).items():
            if n:
                raise ValueError(f"{table}.{name}: {n} values cannot become {kinds[name].simpleString()} unchanged")
    return batch.withColumns({n: _column(n).try_cast(kind) for n, kind in casts.items()}), wider


def as_variants(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of the named columns that are there, as VARIANT: each value keeps the type it came with."""
    return df.withColumns({n: _column(n).cast(T.VariantType()) for n in names if n in df.columns})


def typed(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """VARIANT columns as plain types; a value that has no such form becomes NULL."""
    return df.withColumns({n: F.try_variant_get(_column(n), "$", kind) for n, kind in kinds.items()})
