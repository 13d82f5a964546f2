"""Catalog namespaces for queries that write tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from siltstone.session import shared_folder

PREFIX = "siltstone_scratch_"
# What this process created and has not dropped yet.
_created: list[tuple[str, str]] = []


def new_namespace(spark: SparkSession) -> tuple[str, str]:
    """A fresh database in the shared folder; returns its name and folder."""
    name = f"{PREFIX}{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark)}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/tables'")
    _created.append((name, folder))
    return name, folder


def drop_namespaces(spark: SparkSession) -> None:
    """Drops the tables and files of this process's namespaces, once their results have been read."""
    while _created:
        name, folder = _created.pop()
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
