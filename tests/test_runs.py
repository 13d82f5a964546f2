"""Landing files through raw, silver and gold, over more than one interval."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siltstone.operators import CheckFailed, keys_unique
from siltstone.plans import raw
from siltstone.plans.registry import GOLD_KEYS, SILVER_TABLES
from siltstone.plans.runs import build_gold, build_silver, ingest_raw, promote, promote_interval, replace_gold
from siltstone.sources import create_table, normalise_columns, read_landing, snake_case


@pytest.fixture()
def landing(tmp_path):
    def write(feed, interval, lines):
        folder = tmp_path / interval / feed
        folder.mkdir(parents=True, exist_ok=True)
        text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
        (folder / "part.json").write_text(text)
        return str(folder)

    write.root = str(tmp_path)
    return write


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("foo_Bar", "foo__bar"),
        ("HTTPServer", "http_server"),
        ("userID", "user_id"),
        ("itemInSession", "item_in_session"),
        ("already_snake", "already_snake"),
        ("_corrupt_record", "_corrupt_record"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_names_that_become_one_are_refused(spark):
    with pytest.raises(ValueError, match="user_id"):
        normalise_columns(spark.createDataFrame([(1, 2)], "userId int, user_id int"))


def test_ingest_creates_then_replaces_its_interval(spark, namespace, landing):
    table = f"{namespace}.logs"
    first = landing("logs", "d1", [{"userId": "1", "ts": 1}, {"userId": "2", "ts": 2}])
    assert raw.ingest(spark, first, table, "d1")
    assert raw.ingest(spark, landing("logs", "d2", [{"userId": "3", "ts": 3}]), table, "d2")
    assert raw.ingest(spark, landing("logs", "d1", [{"userId": "9", "ts": 9}]), table, "d1")
    assert rows(spark.table(table).select("user_id", "ts", "data_interval")) == [("3", 3, "d2"), ("9", 9, "d1")]


def test_new_fields_reach_an_existing_raw_table(spark, namespace, landing):
    table = f"{namespace}.logs"
    raw.ingest(spark, landing("logs", "d1", [{"userId": "1"}]), table, "d1")
    raw.ingest(spark, landing("logs", "d2", [{"userId": "2", "newField": {"innerName": 5}}]), table, "d2")
    result = spark.table(table).select("user_id", "new_field.innerName", "data_interval")
    assert rows(result) == [("1", None, "d1"), ("2", 5, "d2")]


def test_a_field_missing_from_a_batch_is_null(spark, namespace, landing):
    table = f"{namespace}.logs"
    raw.ingest(spark, landing("logs", "d1", [{"userId": "1", "level": "free"}]), table, "d1")
    raw.ingest(spark, landing("logs", "d2", [{"userId": "2"}]), table, "d2")
    assert rows(spark.table(table).select("user_id", "level")) == [("1", "free"), ("2", None)]


def test_source_names_of_an_old_table_are_migrated(spark, namespace, landing):
    table = f"{namespace}.logs"
    old = spark.createDataFrame([("1", "Ann", "d0")], "userId string, first_name string, data_interval string")
    create_table(old, table, ["data_interval"])
    raw.ingest(spark, landing("logs", "d1", [{"userId": "2", "firstName": "Bo"}]), table, "d1")
    assert rows(spark.table(table).select("user_id", "first_name", "data_interval")) == [
        ("1", "Ann", "d0"),
        ("2", "Bo", "d1"),
    ]


def test_empty_and_missing_input(spark, namespace, landing):
    table = f"{namespace}.logs"
    assert not raw.ingest(spark, landing("logs", "d1", []), table, "d1")
    assert not spark.catalog.tableExists(table)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        raw.ingest(spark, f"{landing.root}/absent", table, "d1")


def test_malformed_lines_are_kept(spark, namespace, landing):
    table = f"{namespace}.logs"
    raw.ingest(spark, landing("logs", "d1", [{"userId": "1"}, '{"userId": ']), table, "d1")
    assert rows(spark.table(table).select("user_id", "_corrupt_record")) == [(None, '{"userId": '), ("1", None)]


def test_a_source_field_named_as_the_interval_is_overwritten(spark, namespace, landing):
    table = f"{namespace}.logs"
    raw.ingest(spark, landing("logs", "d1", [{"userId": "1", "dataInterval": "x"}]), table, "d1")
    assert rows(spark.table(table)) == [("1", "d1")]


def test_a_given_schema_is_used(spark, landing):
    path = landing("logs", "d1", [{"ts": 1}])
    assert read_landing(spark, path, spark.createDataFrame([], "ts string, x int").schema).dtypes == [
        ("ts", "string"),
        ("x", "int"),
    ]


def test_feeds_without_rows_are_not_reported(spark, namespace, landing):
    landing("logs", "d1", [{"userId": "1", "ts": 5}])
    landing("songs", "d1", [])
    schemas = {"logs": spark.createDataFrame([], "userId string, ts string").schema}
    assert ingest_raw(spark, landing.root, namespace, "d1", ["logs", "songs"], schemas) == ["logs"]
    assert rows(spark.table(f"{namespace}.logs")) == [("1", "5", "d1")]


def log(user, ts, **more):
    base = {
        "userId": user,
        "sessionId": 1,
        "itemInSession": ts % 1000,
        "ts": ts,
        "page": "NextSong",
        "auth": "Logged In",
        "level": "free",
        "song": "Song",
        "artist": "Artist",
        "length": 200.004,
        "firstName": "Ann",
        "lastName": "Lee",
        "gender": "F",
        "location": "Rome",
        "registration": 1_500_000_000_000,
        "userAgent": "agent",
    }
    return {**base, **more}


SONGS = [
    {
        "song_id": "S1",
        "title": "Song",
        "artist_id": "A1",
        "year": 0,
        "duration": 200.0,
        "artist_name": "Artist",
        "artist_location": "Rome",
        "artist_latitude": 1.0,
        "artist_longitude": 2.0,
    }
]
DAY_MS = 86_400_000
T0 = 1_541_030_400_000
DAYS = ("2018-11-01", "2018-11-02")


@pytest.fixture()
def lake(spark, namespace, landing):
    first = [
        log("1", T0 + 1, firstName="Early"),
        log("2", T0 + 2, page="Home"),
        log("2", T0 + 5002, page="Submit Upgrade"),
        log("3", T0 + 9000, page="Submit Upgrade"),
    ]
    second = [
        log("1", T0 + DAY_MS + 3, firstName="Late", level="paid"),
        log("1", T0 + DAY_MS + 4, firstName="Late"),
    ]
    landing("logs", DAYS[0], first)
    landing("logs", DAYS[1], second)
    for day in DAYS:
        landing("songs", day, SONGS)

    def run(day):
        ingest_raw(spark, landing.root, namespace, day, ["logs"])
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}_silver LOCATION '{landing.root}/silver'")
        raw.ingest(spark, f"{landing.root}/{day}/songs", f"{namespace}.songs", day)
        promote_interval(spark, namespace, f"{namespace}_silver", day)

    yield run
    spark.sql(f"DROP DATABASE IF EXISTS {namespace}_silver CASCADE")


def contents(spark, namespace):
    return {t.name: rows(spark.table(f"{namespace}_silver.{t.name}")) for t in SILVER_TABLES}


def test_intervals_accumulate_and_can_be_run_again(spark, namespace, lake):
    def levels_of(user):
        levels = spark.table(f"{namespace}_silver.user_levels").where(f"user_id = {user}")
        return rows(levels.select("new_level", "source"))

    lake(DAYS[0])
    assert levels_of(3) == [("paid", "transition")]

    lake(DAYS[1])
    first = contents(spark, namespace)
    assert len(first["events"]) == 3
    assert [r[1] for r in first["users"]] == ["Late", "Ann", "Ann"]
    assert levels_of(1) == [("free", "initial")]
    assert levels_of(2) == [("free", "initial"), ("paid", "transition")]
    # Every run looks the first level up again; it has the key of a change in the first second.
    assert levels_of(3) == [("free", "initial")]

    lake(DAYS[1])
    assert contents(spark, namespace) == first

    # The last run counts, not the latest event.
    lake(DAYS[0])
    users = spark.table(f"{namespace}_silver.users").where("user_id = 1")
    assert users.first().first_name == "Early"


def test_an_earlier_interval_loaded_later_adds_a_second_first_level(spark, namespace, lake):
    for day in reversed(DAYS):
        lake(day)
    levels = spark.table(f"{namespace}_silver.user_levels").where("user_id = 1 AND source = 'initial'")
    assert levels.count() == 2


def test_gold_is_replaced_and_keyed(spark, namespace, lake):
    for day, plays in zip(DAYS, (1, 3)):
        lake(day)
        replace_gold(spark, f"{namespace}_silver", f"{namespace}_silver")
        assert spark.table(f"{namespace}_silver.song_facts").first().total_plays == plays
    facts = spark.table(f"{namespace}_silver.song_facts").first()
    assert (facts.total_plays, facts.distinct_listeners, facts.paid_play_share) == (3, 1, 1 / 3)
    for name, keys in GOLD_KEYS.items():
        assert keys_unique(spark.table(f"{namespace}_silver.{name}"), keys).first().passed == 1
    assert spark.table(f"{namespace}_silver.user_facts").where("is_converted").count() == 1


def test_promotion_drops_duplicate_keys(spark, namespace):
    table = f"{namespace}.t"
    staged = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    promote(staged, table, ["k"])
    promote(staged.withColumn("v", F.upper("v")), table, ["k"])
    assert rows(spark.table(table)) == [(1, "A"), (2, "C")]


def test_a_failed_check_stops_the_run(spark, namespace, lake):
    lake(DAYS[0])
    users = f"{namespace}_silver.users"
    spark.sql(
        f"INSERT INTO {users} SELECT NULL, first_name, last_name, gender, location, registration, "
        f"last_seen_at FROM {users}"
    )
    with pytest.raises(CheckFailed, match="users keys"):
        lake(DAYS[1])


def test_unknown_tables_are_refused(spark, namespace):
    with pytest.raises(ValueError, match="unknown gold table"):
        build_gold(spark, "other", namespace)
    with pytest.raises(ValueError, match="unknown silver table"):
        build_silver(spark, "other", namespace, namespace, "d1")


def land(spark, folder, interval, feed, lines):
    import json
    import os

    path = f"{folder}/{interval}/{feed}"
    os.makedirs(path)
    with open(f"{path}/part.json", "w") as file:
        file.write("\n".join(json.dumps(line) for line in lines))


def test_batches_of_other_types_lose_nothing(spark, namespace, tmp_path):
    from siltstone.plans.runs import ingest_raw

    batches = {
        "d1": [{"a": 5, "lat": 1.5, "t": "x"}],
        "d2": [{"a": 5.75, "lat": None, "t": 7}],
        "d3": [{"a": 6, "lat": 2, "extra": True}],
    }
    for interval, lines in batches.items():
        land(spark, str(tmp_path), interval, "logs", lines)
        ingest_raw(spark, str(tmp_path), namespace, interval, ["logs"])
    found = spark.table(f"{namespace}.logs").orderBy("data_interval")
    assert [tuple(r) for r in found.select("a", "lat", "t", "extra").collect()] == [
        (5.0, 1.5, "x", None),
        (5.75, None, "7", None),
        (6.0, 2.0, None, True),
    ]
    land(spark, str(tmp_path), "d4", "logs", [{"a": "many"}])
    with pytest.raises(ValueError, match="logs.a"):
        ingest_raw(spark, str(tmp_path), namespace, "d4", ["logs"])
    assert found.count() == 3


def test_gold_with_repeated_keys_leaves_the_old_table(spark, namespace, monkeypatch):
    from siltstone.operators.checks import CheckFailed
    from siltstone.plans import runs

    table = f"{namespace}.song_facts"
    spark.createDataFrame([("old",)], "song_id string").write.saveAsTable(table)
    twice = spark.createDataFrame([("s",), ("s",)], "song_id string")
    monkeypatch.setattr(runs, "build_gold", lambda *_: twice)
    with pytest.raises(CheckFailed):
        runs.replace_gold(spark, namespace, namespace, ["song_facts"])
    assert [r.song_id for r in spark.table(table).collect()] == ["old"]


def test_users_whose_ids_arrive_as_doubles(spark):
    from siltstone.plans import silver

    schema = (
        "user_id double, auth string, first_name string, last_name string, gender string, location string, "
        "registration long, ts long, data_interval string"
    )
    logs = spark.createDataFrame(
        [(k, "Logged In", "f", "l", "F", "here", 1, 2, "d1") for k in (39.0, 40.0, 39.0)], schema
    )
    assert sorted(r.user_id for r in silver.users(logs, "d1").collect()) == [39, 40]


def level_line(user, ts, level, page="NextSong"):
    return {"user_id": user, "ts": ts, "level": level, "auth": "Logged In", "page": page}


def test_levels_read_one_raw_interval_and_equal_those_of_the_whole_history(spark, namespace, tmp_path):
    """Late and repeated intervals included."""
    from siltstone.plans import runs, silver

    batches = {
        "d2": [level_line("1", 5000, "free"), level_line("2", 6000, "paid"), level_line("1", 7000, "paid")],
        "d3": [level_line("2", 9000, "free", "Submit Downgrade"), level_line("3", 9500, "free")],
        "d1": [level_line("1", 1000, "paid")],
    }
    for interval, lines in batches.items():
        land(spark, str(tmp_path), interval, "logs", lines)
        for _ in range(2):
            runs.ingest_raw(spark, str(tmp_path), namespace, interval, ["logs"])
        logs = spark.table(f"{namespace}.logs")
        for day in ("d1", "d2", "d3"):
            built = runs.build_silver(spark, "user_levels", namespace, namespace, day)
            assert sorted(map(str, built.collect())) == sorted(map(str, silver.user_levels(logs, day).collect()))
    kept = runs.kept_first_levels(spark, namespace, "d3")
    assert kept is not None
    raw_files = {f for f in silver.user_levels(logs, "d3", kept).inputFiles() if "/logs/" in f}
    assert raw_files and all("data_interval=d3" in f for f in raw_files)
    spark.sql(f"ALTER TABLE {namespace}.first_levels DROP PARTITION (data_interval = 'd2')")
    assert runs.kept_first_levels(spark, namespace, "d3") is None
    assert runs.kept_first_levels(spark, namespace, "d1") is not None


def test_plays_wait_for_their_songs(spark, namespace, landing):
    """A play is resolved when its song, artist or version arrives later; too many waiting plays fail the check."""
    from siltstone.plans import kept_facts

    other = {**SONGS[0], "song_id": "S2", "title": "Other", "duration": 100.0}
    plays = [log("1", T0 + k) for k in range(1, 9)]
    plays += [log("1", T0 + 11, song="Other", length=100.0), log("1", T0 + 12, song="Other", length=55.0)]
    landing("logs", DAYS[0], plays)
    landing("songs", DAYS[0], SONGS)
    landing("logs", DAYS[1], [log("1", T0 + DAY_MS + 21), log("1", T0 + DAY_MS + 22, song="Never")])
    landing("songs", DAYS[1], [other])
    spark.sql(f"CREATE DATABASE {namespace}_silver LOCATION '{landing.root}/silver'")
    silver = f"{namespace}_silver"

    def run(day):
        ingest_raw(spark, landing.root, namespace, day, ["logs", "songs"])
        promote_interval(spark, namespace, silver, day, wait_for_songs=True)

    def waiting():
        return sorted(r.played_title for r in spark.table(f"{silver}.waiting_plays").collect())

    try:
        run(DAYS[0])
        assert spark.table(f"{silver}.events").count() == 8 and waiting() == ["Other", "Other"]
        for _ in range(2):  # a run may be repeated
            run(DAYS[1])
            events = spark.table(f"{silver}.events")
            assert events.count() == 10 and events.where("song_id = 'S2'").count() == 1
            assert waiting() == ["Never", "Other"]  # one of another length still waits
        changed = {str(r[0]) for r in spark.table(f"{silver}.{kept_facts.CHANGES}").select("event_date").collect()}
        assert "2018-11-01" in changed  # the day of the late play
        landing("logs", DAYS[1], [log("1", T0 + DAY_MS + k, song="Never") for k in range(31, 39)])
        with pytest.raises(CheckFailed, match="versions are resolved"):
            run(DAYS[1])
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {silver} CASCADE")


def test_variants_keep_every_value_and_every_file(spark, namespace, tmp_path):
    """Numbers, fractions, texts and NULLs in one column; earlier files stay as they are."""
    from siltstone.plans import raw
    from siltstone.sources.types import typed

    table, files = f"{namespace}.drift", set()
    batches = {"d1": [{"v": 2**60 + 1}, {"v": None}], "d2": [{"v": 0.5}], "d3": [{"v": "n/a", "w": 3}], "d4": [{"w": "x"}]}
    for interval, lines in batches.items():
        land(spark, str(tmp_path), interval, "drift", lines)
        raw.ingest(spark, f"{tmp_path}/{interval}/drift", table, interval, variants=["v", "w"])
        now = set(spark.table(table).inputFiles())
        assert files < now
        files = now
    read = typed(spark.table(table), {"v": "bigint"})
    assert rows(read.select("v", "data_interval").where("v IS NOT NULL")) == [(0, "d2"), (2**60 + 1, "d1")]
    texts = typed(spark.table(table), {"v": "string", "w": "string"}).select("v", "w")
    assert rows(texts.dropna(how="all")) == [(None, "x"), ("0.5", None), (str(2**60 + 1), None), ("n/a", "3")]
