"""Row selection and union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_is_orderable(field.dataType) for field in data_type)
    if isinstance(data_type, T.ArrayType):
        return _is_orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key, first in ``order``.

    Every non-key column follows as an ascending tie-break (by column name), so the survivor does
    not depend on how the input is partitioned. Spark keeps one row per key in each map task
    before the shuffle, which also bounds what a hot key can send to one reducer.
    """
    placed = {*keys, *(item for item in order if isinstance(item, str))}
    tie_breaks = sorted(
        field.name for field in df.schema if field.name not in placed and _is_orderable(field.dataType)
    )
    window = Window.partitionBy(*keys).orderBy(*order, *tie_breaks)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def drop_duplicate_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """``dropDuplicates`` with a reproducible survivor."""
    return top_row(df, keys, order)


def union_tagged(sources: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL by column name; ``tag`` records which source a row came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    if not tagged:
        raise ValueError("union_tagged needs at least one source")
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df)
    return result
