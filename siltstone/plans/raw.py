"""Raw layer: one landing batch into one interval of a raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from siltstone.sources import (
    add_missing_columns,
    create_table,
    finish_replacement,
    has_input,
    normalise_columns,
    read_landing,
    rename_columns,
    replace_partition,
    stamp_interval,
    widen_columns,
)
from siltstone.sources.landing import INTERVAL
from siltstone.sources.types import as_variants, fitted


def ingest(
    spark: SparkSession,
    path: str,
    table: str,
    interval: str,
    schema: StructType | None = None,
    variants: Sequence[str] = (),
    **options: str,
) -> bool:
    """Loads the batch and reports whether there was anything to load.

    The write needs no shuffle: a batch is one partition. Loading it again replaces that partition.
    A batch whose numbers do not fit their columns widens them, which rewrites the table; one that
    cannot be stored unchanged is refused. Columns named in ``variants`` are stored as VARIANT, so their
    values may change type from batch to batch, and nothing is ever rewritten for it; read them with
    ``typed``. ``options`` go to the reader.
    """
    landed = read_landing(spark, path, schema, **options)
    if not has_input(landed):
        return False
    normalised = normalise_columns(landed)
    batch = stamp_interval(as_variants(normalised, variants), interval)
    finish_replacement(spark, table)
    if not spark.catalog.tableExists(table):
        create_table(batch, table, [INTERVAL])
        return True
    rename_columns(spark, table, dict(zip(landed.columns, normalised.columns)))
    batch, wider = fitted(batch, spark.table(table), table, widen=True)
    if wider:
        widen_columns(spark, table, wider)
    add_missing_columns(batch, table)
    replace_partition(batch, table, {INTERVAL: interval})
    return True
