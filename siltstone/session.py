"""Session settings this library relies on, and a local session for tests and benchmarks."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps are derived from epoch values, so results depend on the session zone.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join is split at a hot key even if what follows needs the key gathered again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Fixed for the session, so that writers in several threads cannot change it for each other.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A join is planned on the size of compressed files, and no measured size takes a broadcast back. Rows took up to
    # 400 times as much (repeated values, exploded, with hashes), so only files of some 100 KB count as small
    # before a stage has run.
    "spark.sql.sources.fileCompressionFactor": "100",
}

# A broadcast is built in the driver, at several times its size, and a query may build some at once. So a session may
# allow smaller ones or none, but no larger ones, planned or measured.
LARGEST_BROADCAST = 10 << 20
BROADCAST_THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def in_bytes(size: str) -> int:
    """A size as Spark's settings give it, such as ``10MB``, ``256k`` or ``-1``."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def apply_settings(spark: SparkSession) -> None:
    """The settings this library relies on, in a session of any origin."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    for key in BROADCAST_THRESHOLDS:
        allowed = spark.conf.get(key, None)
        if allowed is not None and in_bytes(allowed) > LARGEST_BROADCAST:
            spark.conf.set(key, str(LARGEST_BROADCAST))


def local_session(cores: str | int = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A single-machine session. On a cluster, use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siltstone")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="siltstone-wh-"))
    )
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold one runtime setting for the duration of an eager write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent on a local master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="siltstone-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
