"""Places of rows in a total order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import settled

#: ``monotonically_increasing_id`` holds the partition above these bits.
ROW_BITS = 33


def with_place(
    df: DataFrame, keys: list[Column], place: str, label: str, order: list[Column] | None = None
) -> DataFrame:
    """``df`` with the number of each row, from 0, in the order of ``keys``, written to the shared folder.

    Rows are dealt by ranges of the keys and of a random number, so that rows with equal keys need not
    meet in one task; these take places among themselves in any order. With ``order``, a finer order that agrees
    with ``keys``, rows are dealt by the keys alone and sorted by it. The driver gets one count per task.
    """
    spark = df.sparkSession
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = df.withColumn("tie_", F.rand(7))
    by = keys if order else [*keys, F.col("tie_")]
    dealt = dealt.repartitionByRange(n_parts, *by).sortWithinPartitions(*(order or by)).drop("tie_")
    numbered = settled(dealt.withColumn("inside_", F.monotonically_increasing_id()), label)
    part = F.shiftright("inside_", ROW_BITS)
    counts = numbered.groupBy(part.alias("part_")).agg(F.count("*").alias("n_")).collect()
    bases, before = [], 0
    for row in sorted(counts, key=lambda r: r.part_):
        bases.append(f"({row.part_}L, {before}L)")
        before += row.n_
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(bases or ['(0L, 0L)'])} AS t(part_, base_)")
    low = F.col("inside_").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = numbered.withColumn("part_", part).join(table, "part_")
    return joined.withColumn(place, low + F.col("base_")).drop("part_", "base_", "inside_")


def smallest_hashes(df: DataFrame, key: Column, n: int, rows: int) -> DataFrame:
    """The n rows of ``df``, of about ``rows``, with the smallest hashes of a key; ties by the key.

    A threshold leaves some four times as many before they are sorted, so all tasks together hand on a
    few times n rows, not n each.
    """
    chance = F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(float(2**53))
    few = df.where(chance * F.lit(float(rows)) < F.lit(4.0 * n + 100))
    return few.orderBy(F.shiftrightunsigned(F.xxhash64(key), 11), key).limit(n)
