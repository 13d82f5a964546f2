from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from test_plans import plan

from siltstone.plans import silver
from siltstone.session import session_setting

LOG_SCHEMA = (
    "user_id string, session_id long, item_in_session long, ts long, page string, auth string, "
    "level string, song string, artist string, length double, first_name string, last_name string, "
    "gender string, location string, registration long, user_agent string, data_interval string"
)
SONG_SCHEMA = (
    "song_id string, title string, artist_id string, year long, duration double, artist_name string, "
    "artist_location string, artist_latitude double, artist_longitude double, data_interval string"
)
DAY = "2018-11-01"
START = 1_541_030_400_000


def logs(spark, *entries):
    base = {
        "user_id": "7",
        "session_id": 1,
        "item_in_session": 0,
        "ts": START,
        "page": "NextSong",
        "auth": "Logged In",
        "level": "free",
        "song": "Song",
        "artist": "Artist",
        "length": 200.0,
        "first_name": "Ann",
        "last_name": "Lee",
        "gender": "F",
        "location": "Rome",
        "registration": START - 1,
        "user_agent": "agent",
        "data_interval": DAY,
    }
    return spark.createDataFrame([tuple({**base, **e}.values()) for e in entries], LOG_SCHEMA)


def feed(spark, *entries):
    base = {
        "song_id": "S1",
        "title": "Song",
        "artist_id": "A1",
        "year": 0,
        "duration": 200.0,
        "artist_name": "Artist",
        "artist_location": None,
        "artist_latitude": None,
        "artist_longitude": None,
        "data_interval": DAY,
    }
    return spark.createDataFrame([tuple({**base, **e}.values()) for e in entries], SONG_SCHEMA)


def test_users_takes_latest_row_of_the_interval(spark):
    df = logs(
        spark,
        {"first_name": "Old", "ts": START},
        {"first_name": "New", "ts": START + 1},
        {"first_name": "Guest", "ts": START + 2, "auth": "Logged Out"},
        {"first_name": "Later", "ts": START + 3, "data_interval": "2018-11-02"},
        {"user_id": "", "ts": START},
        {"user_id": None, "ts": START},
    )
    (user,) = silver.users(df, DAY).collect()
    assert (user.user_id, user.first_name) == (7, "New")
    assert dict(silver.users(df, DAY).dtypes)["last_seen_at"] == "timestamp"


def test_users_with_one_number_are_one_user(spark):
    df = logs(spark, {"user_id": "7"}, {"user_id": "07", "ts": START + 5, "first_name": "Seven"})
    assert [(u.user_id, u.first_name) for u in silver.users(df, DAY).collect()] == [(7, "Seven")]


def test_an_id_that_is_no_number_is_null(spark):
    assert [u.user_id for u in silver.users(logs(spark, {"user_id": "abc"}), DAY).collect()] == [None]


def test_users_of_one_moment_are_chosen_reproducibly(spark):
    entries = [{"first_name": name} for name in ("Cy", "Al", "Bo")]
    picks = {silver.users(logs(spark, *e), DAY).first().first_name for e in (entries, entries[::-1])}
    assert picks == {"Al"}


def test_songs_takes_largest_year_and_prefers_zero_to_null(spark):
    years = [0, None, 1999, 2005]
    df = feed(spark, *({"year": y, "title": f"T{y}"} for y in years))
    assert rows(silver.songs(df, DAY)) == [("S1", "T2005", "A1", 2005)]
    unknown = feed(spark, {"year": None, "title": "none"}, {"year": 0, "title": "zero"})
    assert rows(silver.songs(unknown, DAY)) == [("S1", "zero", "A1", None)]


def test_artists_prefers_location_then_coordinates(spark):
    df = feed(
        spark,
        {"artist_name": "bare"},
        {"artist_name": "point", "artist_latitude": 1.0, "artist_location": ""},
        {"artist_name": "place", "artist_location": "Rome"},
        {"artist_name": "both", "artist_location": "Rome", "artist_latitude": 2.0},
        {"artist_id": "A2", "artist_name": "point", "artist_latitude": 1.0},
        {"artist_id": "A2", "artist_name": "bare"},
        {"artist_id": ""},
    )
    assert rows(silver.artists(df, DAY).select("artist_id", "artist_name")) == [("A1", "both"), ("A2", "point")]


def test_song_versions_are_distinct_durations(spark):
    df = feed(spark, {}, {}, {"duration": 201.5}, {"duration": 0.0}, {"duration": None}, {"song_id": None})
    assert rows(silver.song_versions(df, DAY).select("song_id", "duration")) == [("S1", 200.0), ("S1", 201.5)]


def stamp(ms: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=ms // 1000)


def levels(df, day=DAY):
    naive = silver.user_levels(df, day).withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))
    return rows(naive)


def test_a_change_outranks_the_first_level_of_that_second(spark):
    df = logs(
        spark,
        {"page": "Submit Upgrade", "ts": START + 400},
        {"page": "Home", "ts": START},
        {"page": "Submit Downgrade", "ts": START + 5000, "level": "paid"},
    )
    assert levels(df) == [
        (7, stamp(START), "paid", "transition"),
        (7, stamp(START + 5000), "free", "transition"),
    ]


def test_the_last_change_of_a_second_counts(spark):
    df = logs(
        spark,
        {"page": "Submit Upgrade", "ts": START + 1100, "auth": "Logged Out"},
        {"page": "Submit Downgrade", "ts": START + 1900, "auth": "Logged Out"},
    )
    assert levels(df) == [(7, stamp(START + 1000), "free", "transition")]


def test_first_level_looks_back_over_all_intervals(spark):
    df = logs(
        spark,
        {"data_interval": "2018-10-31", "ts": START - 9000, "level": "paid"},
        {"data_interval": "2018-10-31", "ts": START - 8000, "page": "Submit Downgrade"},
        {"ts": START},
        {"data_interval": "2018-11-02", "ts": START - 99000},
    )
    assert levels(df) == [(7, stamp(START - 9000), "paid", "initial")]


def silver_inputs(spark, log_rows, song_rows):
    log, songs = logs(spark, *log_rows), feed(spark, *song_rows)
    return (
        log,
        silver.users(log, DAY),
        silver.songs(songs, DAY),
        silver.artists(songs, DAY),
        silver.song_versions(songs, DAY),
    )


def test_plays_resolve_to_the_nearest_version_of_the_named_artist(spark):
    catalogue = [
        {"song_id": "S1", "duration": 200.0},
        {"song_id": "S1", "duration": 200.006},
        {"song_id": "S2", "artist_id": "A2", "artist_name": "Other", "duration": 200.004},
    ]
    log_rows = [
        {"item_in_session": 1, "length": 200.005},
        {"item_in_session": 2, "length": 200.002},
        {"item_in_session": 3, "length": 200.5},
        {"item_in_session": 4, "artist": "Other"},
        {"item_in_session": 5, "user_id": "9", "auth": "Logged Out"},
        {"item_in_session": 6, "page": "Home"},
        {"item_in_session": 7, "length": None},
    ]
    inputs = silver_inputs(spark, log_rows, catalogue)
    events = silver.resolve_events(*inputs, DAY).join(inputs[-1].select("version_id", "duration"), "version_id")
    assert rows(events.select("item_in_session", "song_id", "artist_id", "duration")) == [
        (1, "S1", "A1", 200.006),
        (2, "S1", "A1", 200.0),
        (4, "S2", "A2", 200.004),
    ]
    assert events.where("version_id IS NULL").count() == 0


def test_a_play_without_item_number_may_share_its_key(spark):
    """A missing part shortens the key's text, so two plays can meet in one id; one row is kept."""
    log_rows = [
        {"session_id": 3, "item_in_session": None, "ts": START + 1000},
        {"session_id": None, "item_in_session": 3},
    ]
    events = silver.resolve_events(*silver_inputs(spark, log_rows, [{}]), DAY)
    assert events.count() == 1


def test_copies_in_the_catalogue_do_not_multiply_plays(spark):
    copies = [{"song_id": f"S{i:03}", "artist_id": f"A{i % 3}"} for i in range(300)]
    log_rows = [{"item_in_session": i} for i in range(40)]
    log, users, songs, artists, versions = silver_inputs(spark, log_rows, copies)
    plays = silver.plays(log, DAY)
    assert silver.candidate_versions(plays, songs, artists, versions).count() == 40
    events = silver.resolve_events(log, users, songs, artists, versions, DAY)
    assert rows(events.select("song_id", "artist_id").distinct()) == [("S000", "A0")]
    assert events.count() == 40


def test_plays_are_shuffled_by_title_and_by_user_only(spark):
    """The shuffle by user serves the known users and the nearest version of each play."""
    df, catalogue = logs(spark, {}), feed(spark, {})
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        events = silver.resolve_events(
            df, silver.users(df, DAY), silver.songs(catalogue, DAY), silver.artists(catalogue, DAY), silver.song_versions(catalogue, DAY), DAY
        )
        text = plan(events)
    assert "hashpartitioning(play_key" not in text and "_left_cell" not in text
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "played_title" in line]
    assert len(moved) == 1
    assert len(events.collect()) == 1


def test_plays_of_one_key_and_unknown_users(spark):
    """Ids 7 and 07 are one user with keys of their own; of plays with one key, the nearest in length is kept."""
    df = logs(
        spark,
        {"length": 200.006}, {"length": 200.0005, "level": "paid"}, {"user_id": "07"}, {"user_id": " 7"},
        {"user_id": "8", "auth": "Logged Out"}, {"user_id": "abc"}, {"session_id": None, "item_in_session": 1},
        {"session_id": 1, "item_in_session": None},
    )
    catalogue = feed(spark, {}, {"duration": 200.004})
    args = (silver.users(df, DAY), silver.songs(catalogue, DAY), silver.artists(catalogue, DAY), silver.song_versions(catalogue, DAY))
    events = silver.resolve_events(df, *args, DAY)
    known = silver.known_plays(df, args[0], DAY)
    slowly = silver.resolved(known, silver.playable_versions(*args[1:]))
    assert rows(events) == rows(slowly)
    assert sorted(r.level for r in events.collect()) == ["free", "free", "free", "paid"]
    assert {r.version_id for r in events.collect()} <= {r.version_id for r in args[3].collect()}
