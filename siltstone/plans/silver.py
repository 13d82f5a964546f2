"""Silver layer: keyed tables built from one interval of the raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import (
    as_integer,
    as_long,
    date_from_epoch_ms,
    distance,
    hashed,
    id_from_text,
    is_positive,
    is_required,
    key_text,
    packed,
    sentinel_to_null,
    timestamp_from_epoch_ms,
    translate,
    unpacked,
    version_key,
)
from siltstone.operators import keep_known, membership, tolerance_join, top_row, union_tagged
from siltstone.plans.values import (
    DURATION_TOLERANCE,
    INITIAL,
    LEVEL_AFTER,
    PLAY_PAGE,
    SIGNED_IN,
    TRANSITION,
)
from siltstone.sources import in_interval, up_to_interval


def users(logs: DataFrame, interval: str) -> DataFrame:
    """One row per signed-in user, with the attributes of the latest log row.

    Ids become numbers before rows are grouped, so ``7`` and ``07`` are one user.
    """
    seen = in_interval(logs, interval).where(is_required("user_id") & (F.col("auth") == SIGNED_IN))
    attributes = seen.select(
        id_from_text("user_id").alias("user_id"),
        "first_name",
        "last_name",
        "gender",
        "location",
        timestamp_from_epoch_ms("registration").alias("registration"),
        timestamp_from_epoch_ms("ts").alias("last_seen_at"),
        "ts",
    )
    return top_row(attributes, ["user_id"], [F.desc("ts")]).drop("ts")


def artists(catalogue: DataFrame, interval: str) -> DataFrame:
    """One row per artist: a row with a location first, then one with coordinates."""
    credited = in_interval(catalogue, interval).where(is_required("artist_id"))
    details = credited.select(
        "artist_id",
        "artist_name",
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    has_location = F.coalesce(is_required("location"), F.lit(False))
    return top_row(details, ["artist_id"], [has_location.desc(), F.col("latitude").isNull()])


def songs(catalogue: DataFrame, interval: str) -> DataFrame:
    """One row per song, from its row with the largest year; year 0 is then read as unknown."""
    listed = in_interval(catalogue, interval).where(
        is_required("song_id") & is_required("artist_id") & F.col("title").isNotNull()
    )
    chosen = top_row(
        listed.select("song_id", "title", "artist_id", "year"),
        ["song_id"],
        [F.col("year").desc_nulls_last()],
    )
    return chosen.withColumn("year", sentinel_to_null("year"))


def song_versions(catalogue: DataFrame, interval: str) -> DataFrame:
    """One row per song and duration."""
    timed = in_interval(catalogue, interval).where(
        is_required("song_id") & is_positive("duration")
    )
    versions = timed.select("song_id", F.col("duration").try_cast("double").alias("duration")).distinct()
    return versions.select(
        version_key("song_id", "duration").alias("version_id"), "song_id", "duration"
    )


def level_changes(logs: DataFrame, interval: str) -> DataFrame:
    """Upgrades and downgrades submitted in the interval."""
    submitted = in_interval(logs, interval).where(
        is_required("user_id") & F.col("page").isin(*LEVEL_AFTER)
    )
    return submitted.select(
        id_from_text("user_id").alias("user_id"), "ts", translate("page", LEVEL_AFTER).alias("new_level")
    )


def known_levels(logs: DataFrame, *within: str) -> DataFrame:
    """The level of each user's first signed-in row of these logs, for each value of ``within``."""
    known = logs.where(is_required("user_id") & (F.col("auth") == SIGNED_IN) & F.col("level").isNotNull())
    levels = known.select(
        id_from_text("user_id").alias("user_id"), "ts", F.col("level").alias("new_level"), *within
    )
    return top_row(levels, ["user_id", *within], ["ts"])


def first_levels(logs: DataFrame, interval: str, per_interval: DataFrame | None = None) -> DataFrame:
    """The level of each user's first signed-in log row up to and including the interval.

    ``per_interval`` holds ``known_levels`` of each interval and spares reading the history again: the
    first of the firsts is the first of all.
    """
    if per_interval is None:
        return known_levels(up_to_interval(logs, interval))
    firsts = up_to_interval(per_interval, interval).select("user_id", "ts", "new_level")
    return top_row(firsts, ["user_id"], ["ts"])


def user_levels(logs: DataFrame, interval: str, per_interval: DataFrame | None = None) -> DataFrame:
    """One row per user and second of change; a submitted change outranks the first level.

    Of several changes in one second, the one with the latest millisecond counts.
    """
    firsts = first_levels(logs, interval, per_interval)
    combined = union_tagged(
        {TRANSITION: level_changes(logs, interval), INITIAL: firsts}
    ).withColumn("changed_at", timestamp_from_epoch_ms("ts"))
    chosen = top_row(
        combined,
        ["user_id", "changed_at"],
        [F.col("source") != TRANSITION, F.desc("ts")],
    )
    return chosen.select("user_id", "changed_at", "new_level", "source")


def plays(logs: DataFrame, interval: str) -> DataFrame:
    """Song plays of the interval that name user, song, artist and length.

    The play's key stays text here; it is hashed once the play is resolved, as the short text costs
    less in the shuffles on the way.
    """
    return worked_out(logged_plays(logs, interval))


#: What ``worked_out`` makes of what a play was logged with.
LOGGED = ("user_logged", "session_logged", "item_logged", "ts_logged")


def logged_plays(logs: DataFrame, interval: str) -> DataFrame:
    """The plays with key parts and moment as they were logged, which takes less room than what follows from them."""
    played = in_interval(logs, interval).where(
        (F.col("page") == PLAY_PAGE)
        & is_required("user_id")
        & F.col("song").isNotNull()
        & F.col("artist").isNotNull()
        & is_positive("length")
    )
    return played.select(
        F.col("user_id").alias("user_logged"),
        F.col("session_id").alias("session_logged"),
        F.col("item_in_session").alias("item_logged"),
        F.col("ts").alias("ts_logged"),
        id_from_text("user_id").alias("user_id"),
        F.col("song").alias("played_title"),
        F.col("artist").alias("played_artist"),
        F.col("length").try_cast("double").alias("length"),
        "level",
        "location",
        "user_agent",
    )


def worked_out(logged: DataFrame) -> DataFrame:
    """Plays with their key, moment and date, from what they were logged with; other columns stay, in their order."""
    others = [c for c in logged.columns if c not in (*LOGGED, "user_id")]
    return logged.select(
        key_text("user_logged", "session_logged", "item_logged").alias("play_key"),
        timestamp_from_epoch_ms("ts_logged").alias("ts"),
        "user_id",
        as_long("session_logged").alias("session_id"),
        as_integer("item_logged").alias("item_in_session"),
        *others,
        date_from_epoch_ms("ts_logged").alias("event_date"),
    )


def playable_versions(songs: DataFrame, artists: DataFrame, versions: DataFrame) -> DataFrame:
    """Each version with the title and artist name under which a play refers to it.

    Of versions equal in title, artist name and duration, which no play can tell apart, the first
    by artist, song and version id stands for all. It is the one that wins the tie in the end, and a
    catalogue full of copies does not multiply the plays of them.
    """
    titled = songs.select("song_id", "title", "artist_id")
    named = artists.select("artist_id", "artist_name")
    return top_row(
        versions.join(titled, "song_id").join(named, "artist_id"),
        ["title", "artist_name", "duration"],
        ["artist_id", "song_id", "version_id"],
    )


def candidate_versions(
    plays: DataFrame, songs: DataFrame, artists: DataFrame, versions: DataFrame
) -> DataFrame:
    """Every play with the versions of equal title, artist name and (nearly) equal length.

    The catalogue is joined up first, so plays meet it on title, artist and length at once. Going
    by title alone would pair a play with every song of that name before narrowing down.
    """
    return near_versions(plays, playable_versions(songs, artists, versions))


def near_versions(plays: DataFrame, playable: DataFrame) -> DataFrame:
    return tolerance_join(
        plays,
        playable,
        {"played_title": "title", "played_artist": "artist_name"},
        "length",
        "duration",
        DURATION_TOLERANCE,
    )


EVENT_COLUMNS = (
    "event_id",
    "ts",
    "user_id",
    "session_id",
    "item_in_session",
    "version_id",
    "song_id",
    "artist_id",
    "level",
    "location",
    "user_agent",
    "event_date",
)


def resolve_events(
    logs: DataFrame,
    users: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    versions: DataFrame,
    interval: str,
) -> DataFrame:
    """One row per play of a known user, resolved to the version nearest in length.

    Plays meet the catalogue before the users: one shuffle by user then serves both them and ``nearest``.
    """
    playable = playable_versions(songs, artists, with_packed_ids(versions))
    answered = answers(logged_plays(logs, interval), playable)
    return nearest(worked_out(keep_known(answered, users, ["user_id"])))


def known_plays(logs: DataFrame, users: DataFrame, interval: str) -> DataFrame:
    """Plays of the interval by users that the silver table knows."""
    return keep_known(plays(logs, interval), users, ["user_id"])


def resolved(known: DataFrame, playable: DataFrame) -> DataFrame:
    """The event of each play that a playable version answers to: the one nearest in length."""
    return nearest(answers(known, with_packed_ids(playable)))


def with_packed_ids(versions: DataFrame) -> DataFrame:
    """Version ids as ``nearest`` takes them: they are moved several times, and digests take half the room as bytes."""
    return versions.withColumn("version_id", packed("version_id"))


def answers(plays: DataFrame, playable: DataFrame) -> DataFrame:
    """Each play, logged or worked out, with each version near it and the gap in length."""
    gap = distance("duration", "length").alias("gap")
    columns = [c for c in plays.columns if c not in ("played_title", "played_artist", "length")]
    return near_versions(plays, playable).select(*columns, "version_id", "song_id", "artist_id", gap)


def nearest(answered: DataFrame) -> DataFrame:
    """Of the answers to each play, by known users and with packed ids, the event nearest in length.

    Of two plays with one key both are of one user: the text of an id that is a number has no separator, so it
    is what stands before the first one in the key. Rows that lie by user need not move again.
    """
    chosen = top_row(answered, ["user_id", "play_key"], ["gap"])
    return chosen.withColumns({"event_id": hashed("play_key"), "version_id": unpacked("version_id")}).select(*EVENT_COLUMNS)


def arrived_versions(playable: DataFrame, songs: DataFrame, artists: DataFrame, versions: DataFrame) -> DataFrame:
    """Playable versions of which the given rows, those of one interval, brought the version, its song or
    its artist."""
    news = {"version_id": versions, "song_id": songs, "artist_id": artists}
    marked = playable
    for key, rows in news.items():
        marked = membership(marked, rows, [key], f"new_{key}")
    flags = [f"new_{key}" for key in news]
    return marked.where(" OR ".join(flags)).drop(*flags)


def waiting(known: DataFrame, events: DataFrame) -> DataFrame:
    """Plays without an event, one row each."""
    unanswered = known.withColumn("event_id", hashed("play_key")).join(events.select("event_id"), "event_id", "left_anti")
    return top_row(unanswered, ["event_id"])
