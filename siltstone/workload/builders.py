"""The silver and gold tables over the whole feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.plans import gold, silver
from siltstone.plans.kept_facts import note_changes
from siltstone.plans.runs import LOGS, build_silver, keep_all_first_levels, promote, refresh_gold
from siltstone.plans.values import FREE, PAID
from siltstone.sources import SIDE_COMPRESSION, clustered, create_table
from siltstone.sources.landing import INTERVAL
from siltstone.workload.feeds import BATCH, Feeds
from siltstone.workload.registry import ORACLES, query
from siltstone.workload.sql import level_tables, with_tables


def _whole_table(name: str, sql_table: str, attribute: str) -> None:
    def build(feeds: Feeds) -> DataFrame:
        return getattr(feeds, attribute)

    query(name, with_tables(f"SELECT * FROM {sql_table}", sql_table))(build)


for _name in ("users", "artists", "songs", "song_versions", "user_levels"):
    _whole_table(_name, _name, _name)
_whole_table("resolve_events", "play_events", "events")

_ONE_DAY = "2024-01-15"


@query(
    "user_levels_interval",
    with_tables("SELECT * FROM day_user_levels", "user_logs", **level_tables(_ONE_DAY, "day_")),
)
def user_levels_interval(feeds: Feeds) -> DataFrame:
    """Changes of one day, first levels of all days up to it; of the raw log only that day is read."""
    namespace, _ = feeds.scratch()
    create_table(clustered(feeds.user_logs, [INTERVAL]), f"{namespace}.{LOGS}", [INTERVAL])
    keep_all_first_levels(feeds.spark, namespace)
    return build_silver(feeds.spark, "user_levels", namespace, namespace, _ONE_DAY)


@query(
    "user_facts",
    with_tables(
        """
        SELECT u.user_id,
               coalesce(e.total_plays, 0) AS total_plays,
               coalesce(e.total_sessions, 0) AS total_sessions,
               round(coalesce(e.total_listening_seconds, 0.0), 2) AS total_listening_seconds,
               coalesce(e.distinct_songs_played, 0) AS distinct_songs_played,
               coalesce(e.distinct_artists_played, 0) AS distinct_artists_played,
               e.first_seen_at, e.last_seen_at,
               (SELECT arg_max(new_level, changed_at) FROM user_levels l WHERE l.user_id = u.user_id)
                   AS current_level,
               u.user_id IN (SELECT user_id FROM user_levels
                             WHERE new_level = 'paid' AND source = 'transition') AS is_converted
        FROM users u
        LEFT JOIN (
            SELECT user_id, count(*) AS total_plays, count(DISTINCT session_id) AS total_sessions,
                   sum(duration) AS total_listening_seconds,
                   count(DISTINCT song_id) AS distinct_songs_played,
                   count(DISTINCT artist_id) AS distinct_artists_played,
                   min(ts) AS first_seen_at, max(ts) AS last_seen_at
            FROM play_events LEFT JOIN (SELECT version_id, duration FROM song_versions) USING (version_id)
            GROUP BY user_id) e ON e.user_id = u.user_id
        """,
        "play_events",
        "user_levels",
    ),
)
def user_facts(feeds: Feeds) -> DataFrame:
    """From the log as a table: it is read for the users, for their levels and for the plays."""
    logs = feeds.play_log_table
    users = silver.users(logs, BATCH)
    events = silver.resolve_events(logs, users, feeds.songs, feeds.artists, feeds.song_versions, BATCH)
    facts = gold.user_facts(users, events, feeds.song_versions, silver.user_levels(logs, BATCH))
    return facts.withColumn("total_listening_seconds", F.round("total_listening_seconds", 2))


@query(
    "session_facts",
    with_tables(
        """
        SELECT session_id, user_id, started_at, ended_at,
               date_diff('second', started_at, ended_at) AS duration_seconds,
               play_count, distinct_songs, distinct_artists,
               round(coalesce(listened, 0.0), 2) AS total_listening_seconds, level, location
        FROM (
            SELECT session_id, user_id, min(ts) AS started_at, max(ts) AS ended_at,
                   count(*) AS play_count, count(DISTINCT song_id) AS distinct_songs,
                   count(DISTINCT artist_id) AS distinct_artists, sum(duration) AS listened
            FROM play_events LEFT JOIN (SELECT version_id, duration FROM song_versions) USING (version_id)
            GROUP BY session_id, user_id)
        LEFT JOIN (
            SELECT session_id, user_id, level, location FROM play_events
            QUALIFY row_number() OVER (
                PARTITION BY session_id, user_id ORDER BY ts, item_in_session, level, location) = 1)
        USING (session_id, user_id)
        """,
        "play_events",
    ),
)
def session_facts(feeds: Feeds) -> DataFrame:
    """From the plays as a table: they are read for the measures and for the first play of each session."""
    facts = gold.session_facts(feeds.event_table, feeds.song_versions)
    return facts.withColumn("total_listening_seconds", F.round("total_listening_seconds", 2))


@query(
    "song_facts",
    with_tables(
        """
        SELECT s.song_id, s.title, s.artist_id, count(e.event_id) AS total_plays,
               count(DISTINCT e.user_id) AS distinct_listeners,
               count(DISTINCT e.session_id) AS distinct_sessions,
               count(DISTINCT e.version_id) AS distinct_versions_played,
               min(e.ts) AS first_played_at, max(e.ts) AS last_played_at,
               CASE WHEN count(e.event_id) = 0 THEN 0.0
                    ELSE CAST(count(*) FILTER (WHERE e.level = 'paid') AS DOUBLE) / count(e.event_id)
               END AS paid_play_share
        FROM songs s LEFT JOIN play_events e ON e.song_id = s.song_id
        GROUP BY s.song_id, s.title, s.artist_id
        """,
        "play_events",
    ),
)
def song_facts(feeds: Feeds) -> DataFrame:
    return gold.song_facts(feeds.songs, feeds.events)


@query(
    "artist_facts",
    with_tables(
        """
        SELECT a.artist_id, a.artist_name, count(e.event_id) AS total_plays,
               count(DISTINCT e.user_id) AS distinct_listeners,
               count(DISTINCT e.song_id) AS distinct_songs_played,
               count(DISTINCT e.session_id) AS distinct_sessions,
               min(e.ts) AS first_played_at, max(e.ts) AS last_played_at,
               CASE WHEN count(e.event_id) = 0 THEN 0.0
                    ELSE CAST(count(*) FILTER (WHERE e.level = 'paid') AS DOUBLE) / count(e.event_id)
               END AS paid_play_share
        FROM artists a LEFT JOIN play_events e ON e.artist_id = a.artist_id
        GROUP BY a.artist_id, a.artist_name
        """,
        "play_events",
    ),
)
def artist_facts(feeds: Feeds) -> DataFrame:
    return gold.artist_facts(feeds.artists, feeds.events)


def _refreshed(feeds: Feeds, name: str) -> DataFrame:
    """A fact brought up to date after each of two loads; the second delivers one year of the first again.

    The year takes the place of the day, so that the few loads have few partitions. The log is a table, as
    users, levels and plays are built from it, and the plays meet the tables built before.
    """
    spark = feeds.spark
    namespace, _ = feeds.scratch()
    logs = feeds.play_log_table
    staged = {
        "users": silver.users(logs, BATCH),
        "artists": feeds.artists,
        "songs": feeds.songs,
        "song_versions": feeds.song_versions,
        "user_levels": silver.user_levels(logs, BATCH),
    }
    for table, rows in staged.items():
        create_table(rows, f"{namespace}.{table}", (), SIDE_COMPRESSION)
    known = (spark.table(f"{namespace}.{table}") for table in ("users", "songs", "artists", "song_versions"))
    whole = silver.resolve_events(logs, *known, BATCH).withColumn("event_date", F.trunc("event_date", "year"))
    # Plays of one version lie together, so that its id takes room once; the loads keep this order.
    create_table(whole.sortWithinPartitions("version_id"), f"{namespace}.all_events", (), SIDE_COMPRESSION)
    whole, year = spark.table(f"{namespace}.all_events"), F.year("event_date")
    other = F.when(F.col("level") == PAID, FREE).otherwise(PAID)
    loads = (
        whole.where(year <= 1998).withColumn("level", F.when(year == 1998, other).otherwise(F.col("level"))),
        whole.where(year >= 1998),
    )
    for load in loads:
        promote(
            load, f"{namespace}.events", ["event_id"], ["event_date"], keys_known_unique=True,
            before=lambda places: note_changes(spark, namespace, places), gather=False, compression=SIDE_COMPRESSION,
        )
        refresh_gold(spark, namespace, namespace, [name])
    facts = spark.table(f"{namespace}.{name}")
    seconds = "total_listening_seconds"
    return facts.withColumn(seconds, F.round(seconds, 2)) if seconds in facts.columns else facts


def _refreshed_fact(name: str) -> None:
    def build(feeds: Feeds) -> DataFrame:
        return _refreshed(feeds, name)

    query(f"{name}_refreshed", ORACLES[name])(build)


for _name in ("user_facts", "session_facts", "song_facts", "artist_facts"):
    _refreshed_fact(_name)
