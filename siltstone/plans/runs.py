"""Runs that write the layers: promote one table, one interval of silver, the gold snapshot."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.operators import (
    arriving_keys_unique,
    drop_duplicate_keys,
    enforce,
    has_rows,
    keys_unique,
    null_ratio_below,
)
from siltstone.plans import gold, kept_facts, raw, silver
from siltstone.plans.registry import GOLD_KEYS, SILVER_TABLES
from siltstone.plans.values import UNRESOLVED_LIMIT
from siltstone.sources import (
    COMPRESSION,
    clustered,
    create_table,
    finish_replacement,
    in_interval,
    partition_columns,
    remove_keys,
    replace_partition,
    replace_table,
    scan,
    set_table_property,
    stamp_interval,
    table_property,
    upsert,
)
from siltstone.sources.landing import INTERVAL

LOGS, FIRST_LEVELS, WAITING = "logs", "first_levels", "waiting_plays"
#: The table property that notes keys found unique, and the files they were found in.
KEYS_CHECKED = "siltstone.unique_keys"


def promote(
    staged: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    keys_known_unique: bool = False,
    check_keys: bool = False,
    before: Callable[[DataFrame], None] | None = None,
    gather: bool = True,
    compression: str = COMPRESSION,
) -> None:
    """Writes a staged query into its table: the first time as a new table, later as an upsert.

    Duplicate keys are dropped first, unless the query is known to yield each key once. ``before`` is
    called with the partitions that an upsert is about to write again. With ``check_keys`` the table's
    keys must be unique afterwards: ``enforce_keys``. Without ``gather``, which is for few partitions, the rows
    of a new table are not shuffled by partition; an upsert finds by itself how many it writes. A new table keeps
    its ``compression``.
    """
    spark = staged.sparkSession
    finish_replacement(spark, table)
    unique = staged if keys_known_unique else drop_duplicate_keys(staged, keys)
    if spark.catalog.tableExists(table):
        known = check_keys and keys_hold(spark, table, keys)

        def check(arrived: DataFrame) -> None:
            enforce_keys(spark, table, keys, arrived if known else None)

        upsert(unique, table, keys, before, check if check_keys else None)
    else:
        create_table(clustered(unique, partition_by if gather else ()), table, partition_by, compression)
        if check_keys:
            enforce_keys(spark, table, keys)


def content_mark(spark: SparkSession, table: str) -> str:
    """A digest of the table's list of files: it changes with every write."""
    files = spark.table(table).inputFiles()
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def keys_hold(spark: SparkSession, table: str, keys: Sequence[str]) -> bool:
    """Whether these keys were found unique after the last write to the table, whoever wrote."""
    noted = table_property(spark, table, KEYS_CHECKED)
    return noted is not None and noted == f"{','.join(keys)} {content_mark(spark, table)}"


def enforce_keys(spark: SparkSession, table: str, keys: Sequence[str], arrived: DataFrame | None = None) -> None:
    """Raises unless the keys of a table are unique, and notes that they were.

    With ``arrived``, the rows of an upsert into a table whose keys held, only their keys are looked at.
    """
    rows = spark.table(table)
    verdict = keys_unique(rows, keys) if arrived is None else arriving_keys_unique(rows, arrived, keys)
    enforce(verdict, f"{table} keys are unique")
    set_table_property(spark, table, KEYS_CHECKED, f"{','.join(keys)} {content_mark(spark, table)}")


def ingest_raw(
    spark: SparkSession,
    landing: str,
    namespace: str,
    interval: str,
    feeds: Sequence[str],
    schemas: Mapping[str, StructType] | None = None,
) -> list[str]:
    """Loads ``<landing>/<interval>/<feed>`` for each feed; returns the feeds that had rows.

    A feed with a schema is read once; without, its schema is inferred in a pass of its own.
    """
    loaded = []
    for feed in feeds:
        table = f"{namespace}.{feed}"
        schema = (schemas or {}).get(feed)
        if raw.ingest(spark, f"{landing}/{interval}/{feed}", table, interval, schema):
            enforce(has_rows(in_interval(spark.table(table), interval)), f"{table} has rows")
            if feed == LOGS:
                keep_first_levels(spark, namespace, interval)
            loaded.append(feed)
    return loaded


def keep_first_levels(spark: SparkSession, namespace: str, interval: str) -> None:
    """Writes each user's first level in one interval of the log beside the log, for ``user_levels``."""
    logs, table = spark.table(f"{namespace}.{LOGS}"), f"{namespace}.{FIRST_LEVELS}"
    if not {"user_id", "auth", "level", "ts"} <= set(logs.columns):
        return
    firsts = stamp_interval(silver.known_levels(in_interval(logs, interval)), interval)
    if spark.catalog.tableExists(table):
        replace_partition(firsts, table, {INTERVAL: interval})
    else:
        create_table(firsts, table, [INTERVAL])


def keep_all_first_levels(spark: SparkSession, namespace: str) -> None:
    """Writes the first levels of all intervals anew, in one pass over the log."""
    logs, table = spark.table(f"{namespace}.{LOGS}"), f"{namespace}.{FIRST_LEVELS}"
    firsts = clustered(silver.known_levels(logs, INTERVAL), [INTERVAL])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_table(firsts, table, [INTERVAL])


def kept_first_levels(spark: SparkSession, namespace: str, interval: str) -> DataFrame | None:
    """First levels per interval, if every interval of the log up to this one has them."""
    table = f"{namespace}.{FIRST_LEVELS}"
    if not spark.catalog.tableExists(table):
        return None

    def intervals(name: str) -> set[str]:
        listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
        return {row.partition.partition("=")[2] for row in listed}

    logs = f"{namespace}.{LOGS}"
    if partition_columns(spark, logs) != [INTERVAL]:
        return None
    missing = intervals(logs) - intervals(table)
    return None if any(place <= interval for place in missing) else spark.table(table)


def build_silver(
    spark: SparkSession, table: str, raw_namespace: str, namespace: str, interval: str
) -> DataFrame:
    """The staged query of one silver table."""
    logs = f"{raw_namespace}.logs"
    catalogue = f"{raw_namespace}.songs"
    match table:
        case "users":
            return silver.users(spark.table(logs), interval)
        case "user_levels":
            kept = kept_first_levels(spark, raw_namespace, interval)
            return silver.user_levels(spark.table(logs), interval, kept)
        case "artists" | "songs" | "song_versions":
            return getattr(silver, table)(spark.table(catalogue), interval)
        case "events":
            return silver.resolve_events(
                spark.table(logs),
                spark.table(f"{namespace}.users"),
                spark.table(f"{namespace}.songs"),
                spark.table(f"{namespace}.artists"),
                spark.table(f"{namespace}.song_versions"),
                interval,
            )
    raise ValueError(f"unknown silver table: {table}")


def promote_interval(
    spark: SparkSession, raw_namespace: str, namespace: str, interval: str, wait_for_songs: bool = False
) -> None:
    """Promotes every silver table for one interval and checks its keys, then the versions of the events.

    The dates whose events change are noted first, for ``refresh_gold``. With ``wait_for_songs``, plays that
    no version answers to wait for one (``resolve_waiting``) and count as unresolved; else they are dropped.
    """

    def note(places: DataFrame) -> None:
        kept_facts.note_changes(spark, namespace, places)

    for spec in SILVER_TABLES:
        staged = build_silver(spark, spec.name, raw_namespace, namespace, interval)
        before = note if spec.name == kept_facts.EVENTS else None
        target = f"{namespace}.{spec.name}"
        promote(staged, target, spec.keys, spec.partition_by, keys_known_unique=True, check_keys=True, before=before)
    versions = spark.table(f"{namespace}.events").select("version_id")
    if wait_for_songs:
        resolve_waiting(spark, raw_namespace, namespace, interval)
        unanswered = spark.table(f"{namespace}.{WAITING}").select(F.lit(None).cast("string").alias("version_id"))
        versions = spark.table(f"{namespace}.events").select("version_id").unionByName(unanswered)
    enforce(null_ratio_below(versions, "version_id", UNRESOLVED_LIMIT), f"{namespace}.events versions are resolved")


def resolve_waiting(spark: SparkSession, raw_namespace: str, namespace: str, interval: str) -> None:
    """Answers plays of earlier intervals by what this interval brought to the catalogue, and lets the
    unanswered plays of this one wait.

    The plays of the interval have met the whole catalogue already. Waiting ones have met all of it but
    the rows that arrived now, so only these are joined with them. An interval may be run again.
    """
    table, events = f"{namespace}.{WAITING}", f"{namespace}.events"
    logs, catalogue = spark.table(f"{raw_namespace}.{LOGS}"), spark.table(f"{raw_namespace}.songs")
    songs, artists, versions = (spark.table(f"{namespace}.{t}") for t in ("songs", "artists", "song_versions"))
    if spark.catalog.tableExists(table):
        arrived = silver.arrived_versions(
            silver.playable_versions(songs, artists, versions),
            *(getattr(silver, t)(catalogue, interval) for t in ("songs", "artists", "song_versions")),
        )
        late = silver.resolved(spark.table(table), arrived)
        promote(
            late,
            events,
            ["event_id"],
            ["event_date"],
            keys_known_unique=True,
            check_keys=True,
            before=lambda places: kept_facts.note_changes(spark, namespace, places),
        )
    known = silver.known_plays(logs, spark.table(f"{namespace}.users"), interval)
    unanswered = silver.waiting(known, spark.table(events))
    promote(unanswered, table, ["event_id"], ["event_date"], keys_known_unique=True)
    answered = spark.table(table).join(spark.table(events).select("event_id"), "event_id", "left_semi")
    remove_keys(answered, table, ["event_id"])


def build_gold(spark: SparkSession, table: str, silver_namespace: str) -> DataFrame:
    def read(name: str, *columns: str) -> DataFrame:
        return scan(spark, f"{silver_namespace}.{name}", *columns)

    match table:
        case "artist_facts":
            return gold.artist_facts(read("artists"), read("events"))
        case "session_facts":
            return gold.session_facts(read("events"), read("song_versions"))
        case "song_facts":
            return gold.song_facts(read("songs"), read("events"))
        case "user_facts":
            return gold.user_facts(
                read("users"), read("events"), read("song_versions"), read("user_levels")
            )
    raise ValueError(f"unknown gold table: {table}")


def replace_gold(
    spark: SparkSession,
    silver_namespace: str,
    namespace: str,
    tables: Sequence[str] = tuple(GOLD_KEYS),
) -> None:
    """Replaces gold tables by a fresh snapshot each, once the snapshot's keys are known to be unique."""
    for table in tables:
        snapshot = build_gold(spark, table, silver_namespace)
        finish_replacement(spark, f"{namespace}.{table}")

        def check(rows: DataFrame, name: str = table) -> None:
            enforce(keys_unique(rows, GOLD_KEYS[name]), f"{namespace}.{name} keys are unique")

        replace_table(snapshot, f"{namespace}.{table}", check=check)


def refresh_gold(
    spark: SparkSession,
    silver_namespace: str,
    namespace: str,
    tables: Sequence[str] = tuple(GOLD_KEYS),
) -> dict[str, list[str | None]]:
    """Brings gold tables up to date from the dates whose events changed since the last time, and returns
    these dates by table. The result is that of ``replace_gold``; sums of seconds may differ in the last
    digits, as they are added in another order.
    """
    done = {}
    for fact in kept_facts.FACTS:
        if fact.name in tables:
            finish_replacement(spark, f"{namespace}.{fact.name}")

            def check(rows: DataFrame, name: str = fact.name) -> None:
                enforce(keys_unique(rows, GOLD_KEYS[name]), f"{namespace}.{name} keys are unique")

            done[fact.name] = kept_facts.refresh(spark, fact, silver_namespace, namespace, check)
    return done
