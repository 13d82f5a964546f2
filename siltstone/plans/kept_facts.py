"""Gold facts kept up to date: sums and distinct values per day, and a fresh look at the keys a run touches.

For each fact the gold namespace holds, beside the fact itself,

- ``<fact>_sums``: per event date and key, what adds up (plays, seconds, first, last, ...);
- ``<fact>_combinations``: per event date and key, the distinct combinations of the values that the fact counts;
- ``<fact>_measures``: per key, the two merged over all dates;
- ``<fact>_pending``: keys whose measures are still to be merged again.

The first two depend on the events of their date alone, so a date whose events change is worked out again by
itself, whatever changed in it. Events of other dates are never read.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.aggregates import count_where
from siltstone.plans import gold
from siltstone.plans.values import PAID
from siltstone.sources import FEW_PARTITIONS, clustered, create_table, drop_partitions, replace_table, scan

DATE, EVENTS, CHANGES, PROGRESS = "event_date", "events", "events_changes", "facts_progress"
#: What a session opens with: its first play, and among equals the order of the remaining columns.
OPENING = ("ts", "item_in_session", "level", "location")


@dataclass(frozen=True)
class Fact:
    """What a fact table measures; the names of its plays, first and last play are those of the fact."""

    name: str
    keys: tuple[str, ...]
    distinct: Mapping[str, str]
    names: tuple[str, str, str]
    #: Counted columns, in groups whose values are kept together: those that nearly tell plays apart, and coarser ones.
    together: tuple[tuple[str, ...], ...]
    timed: bool = False
    paid: bool = False
    opened: bool = False


FACTS = (
    Fact(
        "user_facts",
        ("user_id",),
        {"total_sessions": "session_id", "distinct_songs_played": "song_id", "distinct_artists_played": "artist_id"},
        ("total_plays", "first_seen_at", "last_seen_at"),
        (("session_id", "song_id", "artist_id"),),
        timed=True,
    ),
    Fact(
        "session_facts",
        ("session_id", "user_id"),
        {"distinct_songs": "song_id", "distinct_artists": "artist_id"},
        ("play_count", "started_at", "ended_at"),
        (("song_id", "artist_id"),),
        timed=True,
        opened=True,
    ),
    Fact(
        "song_facts",
        ("song_id",),
        {"distinct_listeners": "user_id", "distinct_sessions": "session_id", "distinct_versions_played": "version_id"},
        ("total_plays", "first_played_at", "last_played_at"),
        (("user_id", "session_id"), ("version_id",)),
        paid=True,
    ),
    Fact(
        "artist_facts",
        ("artist_id",),
        {"distinct_listeners": "user_id", "distinct_songs_played": "song_id", "distinct_sessions": "session_id"},
        ("total_plays", "first_played_at", "last_played_at"),
        (("user_id", "session_id"), ("song_id",)),
        paid=True,
    ),
)


def on_dates(df: DataFrame, dates: Sequence[str | None]) -> DataFrame:
    """Rows of some dates, given as ISO text; the bare column is compared, so partitions are pruned."""
    named = [F.lit(d).cast("date") for d in dates if d is not None]
    chosen = F.col(DATE).isin(*named) if named else F.lit(False)
    return df.where(chosen | F.col(DATE).isNull() if None in dates else chosen)


def daily_sums(fact: Fact, events: DataFrame, versions: DataFrame) -> DataFrame:
    """What adds up, per date and key."""
    plays, first, last = fact.names
    measures = [F.count("*").alias(plays), F.min("ts").alias(first), F.max("ts").alias(last)]
    if fact.timed:
        events = gold.with_duration(events, versions)
        measures.append(F.sum("duration").alias("seconds"))
    if fact.paid:
        measures.append(count_where(F.col("level") == PAID).alias("paid_plays"))
    if fact.opened:
        measures.append(F.min(F.struct(*OPENING)).alias("opening"))
    return events.groupBy(*fact.keys, DATE).agg(*measures).select(*fact.keys, *_summed(fact), DATE)


def _summed(fact: Fact) -> list[str]:
    extra = {"seconds": fact.timed, "paid_plays": fact.paid, "opening": fact.opened}
    return [*fact.names, *(name for name, wanted in extra.items() if wanted)]


def daily_combinations(fact: Fact, events: DataFrame) -> DataFrame:
    """The distinct combinations of the values that the fact counts, per date and key; other groups' values are NULL.

    One row for a play and group, where a row per value would be as many as the fact counts.
    """
    columns = list(fact.distinct.values())
    kinds = {f.name: f.dataType for f in events.select(*columns).schema}

    def of(group: tuple[str, ...]) -> Column:
        return F.struct(*((F.col(c) if c in group else F.lit(None).cast(kinds[c])).alias(c) for c in columns))

    rows = events.select(*fact.keys, DATE, F.explode(F.array(*map(of, fact.together))).alias("x"))
    kept = rows.select(*fact.keys, *(F.col(f"x.{c}").alias(c) for c in columns), DATE)
    return kept.dropna("all", subset=columns).distinct()


def _keyed(fact: Fact, df: DataFrame) -> DataFrame:
    """The key as one value that is never NULL: NULL parts are equal, in joins as in groups, and both share a shuffle."""
    return df.select(F.struct(*fact.keys).alias("key"), *(c for c in df.columns if c not in fact.keys))


def only(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among ``keys`` (or, with ``left_anti``, is not)."""
    return df.join(keys, "key", how)


def merged(fact: Fact, sums: DataFrame, combinations: DataFrame) -> DataFrame:
    """Measures per key from those of its dates."""
    plays, first, last = fact.names
    merge = {plays: F.sum, first: F.min, last: F.max, "seconds": F.sum, "paid_plays": F.sum, "opening": F.min}
    totals = sums.groupBy("key").agg(*(merge[c](c).alias(c) for c in _summed(fact)))
    named = [F.struct(F.lit(k).alias("measure"), F.col(c).cast("string").alias("value")) for k, c in enumerate(fact.distinct.values())]
    values = combinations.select("key", F.explode(F.array(*named)).alias("x")).select("key", "x.measure", "x.value")
    distinct = values.where("value IS NOT NULL").distinct()
    counts = distinct.groupBy("key").agg(*(count_where(F.col("measure") == k).alias(c) for k, c in enumerate(fact.distinct)))
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in fact.distinct}
    joined = totals.join(counts, "key", "left").withColumns(filled)
    return joined.select("key.*", *_summed(fact), *fact.distinct)


def finished(fact: Fact, measures: DataFrame, silver: Mapping[str, DataFrame]) -> DataFrame:
    """The fact table from its measures and the silver tables that describe its keys."""
    if fact.timed:
        seconds = F.coalesce(F.col("seconds"), F.lit(0.0)).alias("total_listening_seconds")
        measures = measures.select(*(c for c in measures.columns if c != "seconds"), seconds)
    match fact.name:
        case "user_facts":
            return gold.user_facts_of(silver["users"], measures, silver["user_levels"])
        case "session_facts":
            named = reduce(and_, (F.col(k).isNotNull() for k in fact.keys))
            context = {c: F.when(named, F.col(f"opening.{c}")) for c in ("level", "location")}
            return gold.session_facts_of(measures.withColumns(context))
        case "song_facts":
            return gold.catalogue_facts_of(silver["songs"].select("song_id", "title", "artist_id"), measures, "song_id", fact.distinct)
    return gold.catalogue_facts_of(silver["artists"].select("artist_id", "artist_name"), measures, "artist_id", fact.distinct)


# ---- what changed ------------------------------------------------------------------------------


def note_changes(spark: SparkSession, silver_namespace: str, places: DataFrame) -> None:
    """Notes the dates whose events are about to be written again. A date noted in vain does no harm."""
    rows = places.select(F.col(DATE), F.lit(time.time_ns()).cast("long").alias("changed_at")).distinct()
    rows.write.format("parquet").mode("append").saveAsTable(f"{silver_namespace}.{CHANGES}")


def _dates(spark: SparkSession, table: str) -> set[str | None]:
    """The dates of a table partitioned by them, from the catalog alone."""
    found = {r.partition.partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    return {None if d == "__HIVE_DEFAULT_PARTITION__" else d for d in found}


def changed_dates(spark: SparkSession, silver_namespace: str, state: str, since: int) -> set[str | None]:
    """Dates noted as changed after ``since``, and those that only the events or only the state have."""
    noted: set[str | None] = set()
    if spark.catalog.tableExists(f"{silver_namespace}.{CHANGES}"):
        later = spark.table(f"{silver_namespace}.{CHANGES}").where(F.col("changed_at") > since)
        noted = {r[0] for r in later.select(F.col(DATE).cast("string")).distinct().collect()}
    held = _dates(spark, state) if spark.catalog.tableExists(state) else set()
    return noted | (_dates(spark, f"{silver_namespace}.{EVENTS}") ^ held)


def _progress(spark: SparkSession, namespace: str) -> dict[str, int]:
    if not spark.catalog.tableExists(f"{namespace}.{PROGRESS}"):
        return {}
    rows = spark.table(f"{namespace}.{PROGRESS}").groupBy("fact").agg(F.max("seen").alias("seen"))
    return {r.fact: r.seen for r in rows.collect()}


def _put(df: DataFrame, table: str, dates: Sequence[str | None]) -> None:
    """Puts what ``df`` has of some dates in the place of what the table has of them; gathers rows of many dates."""
    spark = df.sparkSession
    rows = clustered(df, [DATE] if len(dates) > FEW_PARTITIONS else ())
    if spark.catalog.tableExists(table):
        drop_partitions(spark, table, [{DATE: d} for d in dates])
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        create_table(rows, table, [DATE])


def refresh(spark: SparkSession, fact: Fact, silver_namespace: str, namespace: str, check=None) -> list[str | None]:
    """Brings one fact up to date and returns the dates it worked out again.

    Reads the events of changed dates only. Of the daily tables it reads the rows of the keys that those dates
    hold or held; measures of other keys are kept. The fact itself, one row per key, is
    replaced as a whole. A run that stops anywhere is repaired by the next: keys to merge are noted
    before the days are replaced, and dates count as seen last.
    """
    name = f"{namespace}.{fact.name}"
    sums, combinations, measures, pending = (f"{name}_{x}" for x in ("sums", "combinations", "measures", "pending"))
    now, seen = time.time_ns(), _progress(spark, namespace).get(fact.name, 0)
    changed = changed_dates(spark, silver_namespace, sums, seen)
    if not spark.catalog.tableExists(combinations):  # as in what was kept before there was this table
        changed |= _dates(spark, f"{silver_namespace}.{EVENTS}")
        changed |= _dates(spark, sums) if spark.catalog.tableExists(sums) else set()
    dates = sorted(changed, key=lambda d: (d is not None, d or ""))
    events = on_dates(scan(spark, f"{silver_namespace}.{EVENTS}"), dates)
    versions = spark.table(f"{silver_namespace}.song_versions")

    # Where no key has been merged, all are; else those of the dates, and those that a run which stopped has left.
    first = not spark.catalog.tableExists(measures)
    if dates:
        if not first:
            new = events.select(*fact.keys)
            if spark.catalog.tableExists(sums):
                new = new.union(on_dates(spark.table(sums), dates).select(*fact.keys))
            new.distinct().write.format("parquet").mode("append").saveAsTable(pending)
        # A date without sums counts as changed, so they go first and come back last.
        if spark.catalog.tableExists(sums):
            drop_partitions(spark, sums, [{DATE: d} for d in dates])
        _put(daily_combinations(fact, events), combinations, dates)
        _put(daily_sums(fact, events, versions), sums, dates)
    parts = (_keyed(fact, spark.table(t)) for t in (sums, combinations))
    if first:
        replace_table(merged(fact, *parts), measures)
    elif spark.catalog.tableExists(pending):
        keys = _keyed(fact, spark.table(pending)).distinct()
        fresh = merged(fact, *(only(part, keys) for part in parts))
        others = only(_keyed(fact, spark.table(measures)), keys, "left_anti")
        replace_table(others.select("key.*", *others.columns[1:]).unionByName(fresh), measures)
    spark.sql(f"DROP TABLE IF EXISTS {pending}")
    silver = {t: scan(spark, f"{silver_namespace}.{t}") for t in ("users", "user_levels", "songs", "artists")}
    replace_table(finished(fact, spark.table(measures), silver), name, check=check)
    row = spark.createDataFrame([(fact.name, now)], "fact string, seen long")
    row.write.format("parquet").mode("append").saveAsTable(f"{namespace}.{PROGRESS}")
    return dates
