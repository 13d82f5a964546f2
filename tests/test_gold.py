from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import keys_unique
from siltstone.plans import gold

EVENTS = (
    "event_id string, ts timestamp, user_id long, session_id long, item_in_session int, "
    "version_id string, song_id string, artist_id string, level string, location string"
)


def at(minute: int) -> dt.datetime:
    return dt.datetime(2018, 11, 1, 12, minute)


def events(spark):
    return spark.createDataFrame(
        [
            ("e1", at(0), 1, 10, 0, "v1", "S1", "A1", "free", "Rome"),
            ("e2", at(5), 1, 10, 1, "v2", "S1", "A1", "paid", "Oslo"),
            ("e3", at(2), 2, 10, 0, "v1", "S1", "A1", "paid", "Bern"),
            ("e4", at(9), 1, 11, 0, "v9", "S2", "A1", "paid", "Rome"),
        ],
        EVENTS,
    )


def versions(spark):
    return spark.createDataFrame([("v1", "S1", 100.0), ("v2", "S1", 50.5)], "version_id string, song_id string, duration double")


def naive(df):
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    )


def test_two_users_of_one_session_keep_their_own_context(spark):
    facts = gold.session_facts(events(spark), versions(spark))
    assert rows(naive(facts)) == [
        (10, 1, at(0), at(5), 300, 2, 1, 1, 150.5, "free", "Rome"),
        (10, 2, at(2), at(2), 0, 1, 1, 1, 100.0, "paid", "Bern"),
        (11, 1, at(9), at(9), 0, 1, 1, 1, 0.0, "paid", "Rome"),
    ]


def test_song_facts_include_unplayed_songs(spark):
    songs = spark.createDataFrame(
        [("S1", "One", "A1", 2000), ("S2", "Two", "A1", None), ("S3", "Three", "A2", None)],
        "song_id string, title string, artist_id string, year long",
    )
    assert rows(naive(gold.song_facts(songs, events(spark)))) == [
        ("S1", "One", "A1", 3, 2, 1, 2, at(0), at(5), 2 / 3),
        ("S2", "Two", "A1", 1, 1, 1, 1, at(9), at(9), 1.0),
        ("S3", "Three", "A2", 0, 0, 0, 0, None, None, 0.0),
    ]


def test_artist_facts_include_unplayed_artists(spark):
    artists = spark.createDataFrame([("A1", "Ann"), ("A2", "Bob")], "artist_id string, artist_name string")
    assert rows(naive(gold.artist_facts(artists, events(spark)))) == [
        ("A1", "Ann", 4, 2, 2, 2, at(0), at(9), 0.75),
        ("A2", "Bob", 0, 0, 0, 0, None, None, 0.0),
    ]


def test_user_facts_join_plays_and_levels(spark):
    users = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "user_id long, first_name string")
    levels = spark.createDataFrame(
        [
            (1, at(0), "free", "initial"),
            (1, at(1), "paid", "transition"),
            (1, at(3), "free", "transition"),
            (2, at(0), "paid", "initial"),
        ],
        "user_id long, changed_at timestamp, new_level string, source string",
    )
    facts = gold.user_facts(users, events(spark), versions(spark), levels)
    assert rows(naive(facts)) == [
        (1, 3, 2, 150.5, 2, 1, at(0), at(9), "free", True),
        (2, 1, 1, 100.0, 1, 1, at(2), at(2), "paid", False),
        (3, 0, 0, 0.0, 0, 0, None, None, None, False),
    ]
    assert keys_unique(facts, ["user_id"]).first().passed == 1
