"""Query registry: a Spark query and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import apply_settings
from siltstone.workload.feeds import Feeds

Build = Callable[[Feeds], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and ISO date text, which read the same in any engine and client."""
    casts = {T.TimestampType: "timestamp_ntz", T.DateType: "string"}
    return df.withColumns(
        {f.name: F.col(f.name).cast(casts[type(f.dataType)]) for f in df.schema if type(f.dataType) in casts}
    )


def query(name: str, sql: str) -> Callable[[Build], Build]:
    """Registers a query under its inventory key, with its oracle."""
    if name in QUERIES:
        raise ValueError(f"duplicate query: {name}")

    def register(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_settings(spark)
            return comparable(build(Feeds(spark, folder)))

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        ORACLES[name] = sql.strip()
        return build

    return register
