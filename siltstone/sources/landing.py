"""JSON-lines landing files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

INTERVAL = "data_interval"

# The two word-boundary rules of the column naming scheme, applied in this order.
CAPITALISED_WORD = r"(.)([A-Z][a-z]+)"
LOWER_TO_UPPER = r"([a-z0-9])([A-Z])"


def read_landing(
    spark: SparkSession, path: str, schema: StructType | None = None, **options: str
) -> DataFrame:
    """One JSON object per line, unless reader options such as ``multiLine`` say otherwise.

    A given schema saves the pass that infers it.

    A missing path is an error. Malformed lines are kept, in ``_corrupt_record``.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**options).json(path)


def has_input(df: DataFrame) -> bool:
    """Reads up to the first row only."""
    return not df.isEmpty()


def snake_case(name: str) -> str:
    for boundary in (CAPITALISED_WORD, LOWER_TO_UPPER):
        name = re.sub(boundary, r"\1_\2", name)
    return name.lower()


def normalise_columns(df: DataFrame) -> DataFrame:
    """Top-level column names in snake case; two names that become one are an error."""
    names = [snake_case(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"source columns share a normalised name: {clashes}")
    return df.toDF(*names)


def stamp_interval(df: DataFrame, interval: str) -> DataFrame:
    """Labels the batch; a source column of that name is overwritten."""
    return df.withColumn(INTERVAL, F.lit(interval))
