"""Parquet table writers: create, replace partitions, replace whole, evolve columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from siltstone.sources.tables import partition_columns, side_name, staged_view

FORMAT = "parquet"
COMPRESSION = "snappy"
#: For tables that are dropped again: keys that are digests take half the room.
SIDE_COMPRESSION = "zstd"
#: Up to so many partitions, tasks that each write a file to all of them leave files of a good size.
FEW_PARTITIONS = 8
NEXT = "__next_"
STAGED = "__staged_"
#: The table property that names the folder a table had before its last replacement.
PREVIOUS = "siltstone.previous"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gathers rows by the columns and sorts inside each task, for few files per partition.

    A rebalance rather than a plain repartition: adaptive execution splits a value too large for
    one task and packs small ones together.
    """
    if not columns:
        return df
    return df.hint("rebalance", *columns).sortWithinPartitions(*columns)


def create_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), compression: str = COMPRESSION
) -> None:
    writer = df.write.format(FORMAT).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def in_table_order(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns in the target's order; those missing here are NULL."""
    return df.select(
        *(
            F.col(quoted(field.name))
            if field.name in df.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in target.schema
        )
    )


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrites exactly the partitions that occur in ``df``; running it again changes nothing.

    Refused where the session would replace the whole table. The mode is never changed here: another
    writer of the session may rely on it.
    """
    spark = df.sparkSession
    if spark.conf.get(OVERWRITE_MODE).lower() != "dynamic":
        raise RuntimeError(f"set {OVERWRITE_MODE} to dynamic (see siltstone.session.SESSION_SETTINGS)")
    in_table_order(df, spark.table(table)).write.insertInto(table, overwrite=True)


def replace_partition(df: DataFrame, table: str, place: Mapping[str, object]) -> None:
    """Overwrites one partition, named in full, whatever the overwrite mode of the session."""
    spark = df.sparkSession
    target = spark.table(table)
    rows = in_table_order(df, target.select(*(quoted(n) for n in target.columns if n not in place)))
    with staged_view(rows, "partition") as view:
        spec = ", ".join(f"{quoted(n)} = {literal(v)}" for n, v in place.items())
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {view}")


def drop_partitions(spark: SparkSession, table: str, places: Sequence[Mapping[str, object]]) -> None:
    """Drops partitions, each named in full; those that are not there are passed over."""
    if places:
        specs = ("PARTITION (" + ", ".join(f"{quoted(n)} = {literal(v)}" for n, v in p.items()) + ")" for p in places)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first().data_type.rstrip("/")


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).first()
    return found and found.value


def set_table_property(spark: SparkSession, table: str, key: str, value: str | None) -> None:
    """Sets a property of a table, or removes it."""
    if value is None:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{key}')")
    else:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = {literal(value)})")


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def replace_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """New content and schema for the whole table.

    The rows are written once, beside the old ones, which stay readable until the new ones are
    complete. ``df`` may read the old table. A ``check`` that raises on the new rows leaves the table as it is.

    An unpartitioned table that keeps its columns, or gains some, is pointed to the new folder: it is never
    missing, and a query that has begun reads on in the old folder, which goes with the next
    replacement. Where columns go or change their type, or partitions are named in the catalog,
    a new table takes the old one's name, and for a moment there is none.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and not partition_by and _keeps_columns(df, table):
        _point_to(df, table, check)
        return
    replacement = side_name(table, NEXT)
    create_table(df, replacement, partition_by)
    if check:
        try:
            check(spark.table(replacement))
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {replacement}")
            raise
    drop_table(spark, table)
    _take_name(spark, replacement, table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drops a table with the folder it had before its last replacement, which DROP TABLE would leave behind."""
    if spark.catalog.tableExists(table):
        older = table_property(spark, table, PREVIOUS)
        spark.sql(f"DROP TABLE {table}")
        if older:
            delete_folder(spark, older)


def _keeps_columns(df: DataFrame, table: str) -> bool:
    """Whether ``df`` has every column of an unpartitioned table in its type."""
    kinds = {f.name: f.dataType for f in df.schema}
    held = df.sparkSession.table(table).schema
    return not partition_columns(df.sparkSession, table) and all(kinds.get(f.name) == f.dataType for f in held)


def _point_to(df: DataFrame, table: str, check: Callable[[DataFrame], None] | None) -> None:
    spark = df.sparkSession
    before = location(spark, table)
    names = [*spark.table(table).columns, *sorted(set(df.columns) - set(spark.table(table).columns))]
    folder = f"{before.rpartition('/')[0]}/{side_name(table.rpartition('.')[2], NEXT)}"
    rows = df.select(*(F.col(quoted(c)) for c in names))
    try:
        rows.write.format(FORMAT).option("compression", COMPRESSION).save(folder)
        if check:
            check(spark.read.schema(rows.schema).format(FORMAT).load(folder))
        add_missing_columns(rows, table)
    except Exception:
        delete_folder(spark, folder)
        raise
    older = table_property(spark, table, PREVIOUS)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(folder)}")
    spark.catalog.refreshTable(table)
    set_table_property(spark, table, PREVIOUS, before)
    if older and older not in (before, folder):
        delete_folder(spark, older)


def _take_name(spark: SparkSession, replacement: str, table: str) -> None:
    spark.sql(f"ALTER TABLE {replacement} RENAME TO {table}")
    if partition_columns(spark, table):
        # Not every catalog moves partition locations along with the table.
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def finish_replacement(spark: SparkSession, table: str) -> None:
    """Finishes a replacement by another schema that stopped between dropping the old table and taking its
    name.

    A side table is in the catalog only once it is complete; the latest one takes the name. Where the
    table stands nothing is touched: side tables may belong to runs in progress.
    """
    if spark.catalog.tableExists(table):
        return
    namespace, _, name = table.rpartition(".")
    place = f" IN {namespace}" if namespace else ""
    listed = spark.sql(f"SHOW TABLES{place} LIKE '{name}__*'").where("NOT isTemporary").collect()
    prefix = f"{namespace}." if namespace else ""
    waiting = sorted(r.tableName for r in listed if r.tableName.startswith(name.lower() + NEXT))
    if waiting:
        _take_name(spark, prefix + waiting[-1], table)


def add_missing_columns(df: DataFrame, table: str) -> list[str]:
    """Adds the columns of ``df`` the table lacks, by name; old rows read as NULL."""
    spark = df.sparkSession
    known = set(spark.table(table).columns)
    added = sorted(name for name in df.columns if name not in known)
    if added:
        declared = ", ".join(f"{quoted(n)} {df.schema[n].dataType.simpleString()}" for n in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({declared})")
    return added


def wanted_renames(columns: Sequence[str], names: Mapping[str, str]) -> dict[str, str]:
    """The renames that apply to ``columns``: the old name is there and the new one is free.

    A name is free if no column has it. Of several old names for one new name the first in column order
    takes it; the others keep theirs, as does a column whose new name is taken.
    """
    present = set(columns)
    claims: dict[str, str] = {}
    for old in columns:
        claims.setdefault(names.get(old, old), old)
    return {old: new for new, old in claims.items() if new not in present}


def rename_columns(spark: SparkSession, table: str, names: Mapping[str, str]) -> dict[str, str]:
    """Renames the columns that ``wanted_renames`` names; returns what it renamed.

    Parquet catalog tables have no RENAME COLUMN, so the table is rewritten, and only when needed.
    """
    current = spark.table(table)
    renames = wanted_renames(current.columns, names)
    if renames:
        renamed = current.select(*(F.col(quoted(c)).alias(renames.get(c, c)) for c in current.columns))
        replace_table(renamed, table, [renames.get(c, c) for c in partition_columns(spark, table)])
    return renames


def widen_columns(spark: SparkSession, table: str, kinds: Mapping[str, DataType]) -> None:
    """Rewrites the table with wider types for some columns."""
    current = spark.table(table)
    wider = current.withColumns({name: F.col(quoted(name)).cast(kind) for name, kind in kinds.items()})
    replace_table(wider, table, partition_columns(spark, table))
