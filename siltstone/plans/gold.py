"""Gold layer: fact tables computed from the silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import packed, seconds_between, share
from siltstone.operators import lookup, play_rollup, top_row, zero_fill_join
from siltstone.operators.aggregates import count_where, sum_or_zero
from siltstone.plans.values import PAID, TRANSITION


def with_duration(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Version ids are digests, so both sides are shuffled by half as many bytes."""
    version = packed("version_id").alias("version_")
    return lookup(events.select("*", version), versions.select(version, "duration"), ["version_"]).drop("version_")


def level_state(levels: DataFrame) -> DataFrame:
    """Per user: the latest level, and whether an upgrade was ever submitted.

    Both come from one aggregation, so the level history is read and shuffled once.
    """
    recency = F.struct("changed_at", F.col("source") == TRANSITION, "new_level")
    latest = F.max_by("new_level", recency)
    upgraded = (F.col("new_level") == PAID) & (F.col("source") == TRANSITION)
    return levels.groupBy("user_id").agg(
        latest.alias("current_level"),
        F.coalesce(F.bool_or(upgraded), F.lit(False)).alias("is_converted"),
    )


def user_facts(
    users: DataFrame, events: DataFrame, versions: DataFrame, levels: DataFrame
) -> DataFrame:
    """One row per user, also without plays."""
    measures = play_rollup(
        with_duration(events, versions),
        ["user_id"],
        plays_as="total_plays",
        distinct={
            "total_sessions": "session_id",
            "distinct_songs_played": "song_id",
            "distinct_artists_played": "artist_id",
        },
        first_as="first_seen_at",
        last_as="last_seen_at",
        extra=[sum_or_zero("duration").alias("total_listening_seconds")],
    )
    return user_facts_of(users, measures, levels)


def user_facts_of(users: DataFrame, measures: DataFrame, levels: DataFrame) -> DataFrame:
    """The facts of all users from the measures of those who played."""
    counted = zero_fill_join(
        users.select("user_id"),
        measures,
        ["user_id"],
        {
            "total_plays": 0,
            "total_sessions": 0,
            "total_listening_seconds": 0.0,
            "distinct_songs_played": 0,
            "distinct_artists_played": 0,
        },
    )
    return zero_fill_join(counted, level_state(levels), ["user_id"], {"is_converted": False}).select(
        "user_id",
        "total_plays",
        "total_sessions",
        "total_listening_seconds",
        "distinct_songs_played",
        "distinct_artists_played",
        "first_seen_at",
        "last_seen_at",
        "current_level",
        "is_converted",
    )


def session_facts(events: DataFrame, versions: DataFrame) -> DataFrame:
    """One row per session and user, with level and location of that user's first play in it."""
    keys = ["session_id", "user_id"]
    measures = play_rollup(
        with_duration(events, versions),
        keys,
        plays_as="play_count",
        distinct={"distinct_songs": "song_id", "distinct_artists": "artist_id"},
        first_as="started_at",
        last_as="ended_at",
        extra=[sum_or_zero("duration").alias("total_listening_seconds")],
    )
    opening = top_row(
        events.select(*keys, "ts", "item_in_session", "level", "location"), keys, ["ts"]
    )
    return session_facts_of(measures.join(opening.select(*keys, "level", "location"), keys, "left"))


def session_facts_of(measures: DataFrame) -> DataFrame:
    """The facts of sessions from their measures, with level and location."""
    return measures.withColumn("duration_seconds", seconds_between("started_at", "ended_at")).select(
        "session_id",
        "user_id",
        "started_at",
        "ended_at",
        "duration_seconds",
        "play_count",
        "distinct_songs",
        "distinct_artists",
        "total_listening_seconds",
        "level",
        "location",
    )


def _catalogue_facts(
    dimension: DataFrame, events: DataFrame, key: str, distinct: dict[str, str]
) -> DataFrame:
    """Play statistics for every row of a catalogue dimension, also without plays."""
    measures = play_rollup(
        events.where(F.col(key).isNotNull()),
        [key],
        plays_as="total_plays",
        distinct=distinct,
        first_as="first_played_at",
        last_as="last_played_at",
        extra=[count_where(F.col("level") == PAID).alias("paid_plays")],
    )
    return catalogue_facts_of(dimension, measures, key, distinct)


def catalogue_facts_of(dimension: DataFrame, measures: DataFrame, key: str, distinct: Mapping[str, str]) -> DataFrame:
    """Every row of a catalogue dimension with its measures, zeros where it was not played."""
    filled = zero_fill_join(dimension, measures, [key], dict.fromkeys(["total_plays", *distinct], 0))
    return filled.withColumn("paid_play_share", share("paid_plays", "total_plays")).select(
        *dimension.columns,
        "total_plays",
        *distinct,
        "first_played_at",
        "last_played_at",
        "paid_play_share",
    )


def song_facts(songs: DataFrame, events: DataFrame) -> DataFrame:
    return _catalogue_facts(
        songs.select("song_id", "title", "artist_id"),
        events,
        "song_id",
        {
            "distinct_listeners": "user_id",
            "distinct_sessions": "session_id",
            "distinct_versions_played": "version_id",
        },
    )


def artist_facts(artists: DataFrame, events: DataFrame) -> DataFrame:
    return _catalogue_facts(
        artists.select("artist_id", "artist_name"),
        events,
        "artist_id",
        {
            "distinct_listeners": "user_id",
            "distinct_songs_played": "song_id",
            "distinct_sessions": "session_id",
        },
    )
