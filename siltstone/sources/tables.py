"""Catalog table reads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.landing import INTERVAL


def scan(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    """A catalog table, with only the named columns when any are named."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def in_interval(df: DataFrame, interval: str) -> DataFrame:
    """Rows of one interval. The bare column is compared, so partitions are pruned."""
    return df.where(F.col(INTERVAL) == interval)


def up_to_interval(df: DataFrame, interval: str) -> DataFrame:
    """Rows of this interval and all earlier ones, in text order."""
    return df.where(F.col(INTERVAL) <= interval)


def interval_rows(df: DataFrame, interval: str) -> DataFrame:
    """Row count of one interval, as one row."""
    return in_interval(df, interval).agg(F.count("*").alias("row_count"))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def side_name(table: str, mark: str) -> str:
    """A name next to ``table`` that no other run uses; later names of one mark sort behind earlier ones."""
    return f"{table}{mark}{time.time_ns():016x}_{uuid.uuid4().hex[:8]}"


@contextmanager
def staged_view(df: DataFrame, label: str) -> Iterator[str]:
    """Registers the DataFrame under a name of its own, so parallel runs cannot collide."""
    name = side_name(label, "__view_")
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)
