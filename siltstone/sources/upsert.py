"""Keyed upsert into parquet catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.sources.tables import partition_columns, side_name
from siltstone.sources.types import fitted
from siltstone.sources.writers import (
    FEW_PARTITIONS,
    SIDE_COMPRESSION,
    STAGED,
    add_missing_columns,
    clustered,
    create_table,
    drop_partitions,
    quoted,
    replace_partitions,
    replace_table,
)


def merge_rows(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    matched_once: bool = False,
    gather: bool = True,
) -> DataFrame:
    """Target rows after the upsert: matched ones take all staged values, also NULLs.

    Target-only columns keep their value. A NULL key matches nothing, so such target rows stay and
    such staged rows are inserted. Staged keys must be unique; of repeated target keys every row is
    updated and kept, within one partition: a second partition with the same key is what a stopped run
    left of a row that moved. The joins have the staged side, usually one interval, as the side that can
    be broadcast, so a large target need not shuffle. Only the staged rows are clustered by
    ``partition_by``, as untouched ones already lie by partition; without ``gather`` they stay where they are.
    With ``matched_once``, no matched key repeats in the target: unless a column is kept, the staged rows arrive
    as they are.
    """
    keys = list(keys)
    staged_keys = staged.select(*keys)
    untouched = target.join(staged_keys, keys, "left_anti")
    kept = [name for name in target.columns if name not in staged.columns]
    if matched_once and not kept:
        arriving = staged.select(*target.columns)
        return untouched.select(*target.columns).unionByName(clustered(arriving, partition_by if gather else ()))
    matched = target.join(staged_keys, keys, "left_semi")
    if partition_by:
        one_place = Window.partitionBy(*keys).orderBy(*(F.col(quoted(c)) for c in partition_by))
        matched = matched.withColumn("place_", F.dense_rank().over(one_place)).where("place_ = 1")
    arriving = staged.join(matched.select(*keys, *kept), keys, "left")
    arriving = clustered(arriving.select(*target.columns), partition_by if gather else ())
    return untouched.select(*target.columns).unionByName(arriving)


def refuse_repeated_keys(staged: DataFrame, keys: Sequence[str], table: str) -> None:
    """A key that arrives twice has no one right row; keys with a NULL match nothing and may repeat."""
    named = staged.dropna(subset=list(keys))
    # Equal keys have equal marks, of eight bytes. Only if one repeats are the keys themselves gathered.
    if named.groupBy(_mark(named, keys)).count().where("count > 1").isEmpty():
        return
    repeated = named.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{table}: the staged rows repeat a key, such as {repeated[0].asDict()}")


def _mark(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash that is equal for equal keys; keys under a collation, where unlike texts are equal, all have one."""
    plain = [k for k in keys if "collate" not in df.schema[k].dataType.simpleString()]
    return F.xxhash64(F.lit(0), *(F.col(quoted(k)) for k in plain)).alias("mark_")


def touched(target: DataFrame, staged: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Partitions that hold a matched row or receive a staged one, with whether rows arrive and the most rows
    that one key has.

    Keys are compared by their marks. Should two keys share one, a partition is named in vain and its rows are
    written again as they are, or a key counts as repeated.
    """
    marks = staged.dropna(subset=list(keys)).select(_mark(staged, keys))
    held = target.dropna(subset=list(keys)).select(*partition_by, _mark(target, keys)).join(marks, "mark_", "left_semi")
    counted = held.withColumn("rows_", F.count("*").over(Window.partitionBy("mark_")))
    sources = counted.groupBy(*partition_by).agg(F.lit(0).alias("arrives_"), F.max("rows_").alias("rows_"))
    arrivals = staged.select(*partition_by).distinct()
    marked = sources.unionByName(arrivals.withColumns({"arrives_": F.lit(1), "rows_": F.lit(0)}))
    return marked.groupBy(*partition_by).agg(F.max("arrives_").alias("arrives_"), F.max("rows_").alias("rows_"))


def upsert(
    staged: DataFrame,
    table: str,
    keys: Sequence[str],
    before: Callable[[DataFrame], None] | None = None,
    after: Callable[[DataFrame], None] | None = None,
) -> None:
    """Merges into an existing table; columns new in ``staged`` are added to it first.

    The table keeps its types: staged values that do not fit them are refused by column. ``before`` is
    called with the partitions that are about to be written again, ``after`` with the rows that came.
    """
    spark = staged.sparkSession
    # Written once: it is read several times below, and must not differ between reads.
    holding = side_name(table, STAGED)
    create_table(staged, holding, (), SIDE_COMPRESSION)
    try:
        held, _ = fitted(spark.table(holding), spark.table(table), table, widen=False)
        refuse_repeated_keys(held, keys, table)
        add_missing_columns(held, table)
        partition_by = partition_columns(spark, table)
        if partition_by:
            _upsert_partitions(spark, table, held, keys, partition_by, before)
        else:
            replace_table(merge_rows(spark.table(table), held, keys), table)
        if after:
            after(held)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {holding}")


def _upsert_partitions(
    spark: SparkSession,
    table: str,
    staged: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    before: Callable[[DataFrame], None] | None = None,
) -> None:
    """Rewrites only partitions that hold a matched row or receive a staged one.

    Keys match across all partitions, so a row can move. The touched partitions are a small table; only
    values of the leading partition column, for pruning, and partitions left empty reach the driver. Staged
    rows of few partitions are not gathered by them.
    """
    target = spark.table(table)
    staged_keys = staged.select(*keys)
    places_table = side_name(table, STAGED)
    create_table(touched(target, staged, keys, partition_by), places_table)
    try:
        places = spark.table(places_table)
        if before:
            before(places.select(*partition_by))
        vacated = places.where("arrives_ = 0").select(*partition_by)
        emptied = []
        if not vacated.isEmpty():
            rest = in_places(target, vacated, partition_by).join(staged_keys, list(keys), "left_anti")
            emptied = vacated.subtract(rest.select(*partition_by)).collect()
        arriving, most = places.agg(F.count_if(F.col("arrives_") == 1), F.max("rows_")).first()
        if most is not None:
            affected = in_places(target, places, partition_by)
            merged = merge_rows(
                affected, staged, keys, partition_by, matched_once=most <= 1, gather=arriving > FEW_PARTITIONS
            )
            replace_partitions(merged, table)
        # Last, so that a run that stops here is repaired by running it again.
        drop_partitions(spark, table, [place.asDict() for place in emptied])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {places_table}")


def remove_keys(gone: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Removes the rows of a partitioned table whose key is among ``gone``, which names their partitions too.

    Only these partitions are written again; those left without rows are dropped, last, so that running
    it again repairs a run that stopped.
    """
    spark = gone.sparkSession
    partition_by = partition_columns(spark, table)
    holding = side_name(table, STAGED)
    create_table(gone.select(*keys, *partition_by).distinct(), holding)
    try:
        held = spark.table(holding)
        places = held.select(*partition_by).distinct()
        rest = in_places(spark.table(table), places, partition_by).join(held.select(*keys), list(keys), "left_anti")
        emptied = places.subtract(rest.select(*partition_by)).collect()
        if not places.isEmpty():
            replace_partitions(rest, table)
        drop_partitions(spark, table, [place.asDict() for place in emptied])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {holding}")


def in_places(target: DataFrame, places: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the target in the given partitions; the leading column prunes, a join decides."""
    lead = quoted(partition_by[0])
    values = [row[0] for row in places.select(lead).distinct().collect()]
    pruned = F.col(lead).isin([v for v in values if v is not None])
    if None in values:
        pruned = pruned | F.col(lead).isNull()
    if len(partition_by) == 1:
        return target.where(pruned)
    named = places.select(*(F.col(quoted(c)).alias(f"place_{k}") for k, c in enumerate(partition_by)))
    same: list[Column] = [F.col(quoted(c)).eqNullSafe(F.col(f"place_{k}")) for k, c in enumerate(partition_by)]
    return target.where(pruned).join(named, reduce(and_, same), "left_semi")
