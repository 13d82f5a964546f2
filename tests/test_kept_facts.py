"""Facts refreshed day by day against facts computed from all events; checks of arriving keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import CheckFailed, arriving_keys_unique, keys_unique
from siltstone.plans import kept_facts, runs
from siltstone.plans.registry import GOLD_KEYS
from siltstone.sources import create_table

EVENTS = (
    "event_id string, ts timestamp, user_id long, session_id long, item_in_session int, version_id string, "
    "song_id string, artist_id string, level string, location string, event_date date"
)
DAYS = [dt.date(2018, 11, k) for k in range(1, 6)]


def event(rng: random.Random, key: int, day: dt.date | None) -> tuple:
    """An event of few users, sessions and songs; any of them may be NULL."""
    song = rng.choice(["S1", "S2", "S3", None])
    at = dt.datetime.combine(day or DAYS[0], dt.time(12, rng.randrange(3)))
    return (
        f"e{key}", at, rng.choice([1, 2, 3, None]), rng.choice([10, 11, None]), rng.randrange(3), song and f"v{song}",
        song, song and "A" + song[1:], rng.choice(["free", "paid", None]), rng.choice(["Rome", "Oslo", None]), day,
    )


@pytest.fixture()
def silver(spark, namespace):
    def put(name, data, schema):
        create_table(spark.createDataFrame(data, schema), f"{namespace}.{name}")

    put("users", [(k, f"u{k}") for k in (1, 2, 9)], "user_id long, first_name string")
    put("songs", [(s, f"Song {s}", "A" + s[1:], None) for s in ("S1", "S2", "S8")], "song_id string, title string, artist_id string, year long")
    put("artists", [(a, f"Artist {a}") for a in ("A1", "A2", "A8")], "artist_id string, artist_name string")
    put("song_versions", [("vS1", "S1", 100.5), ("vS2", "S2", 60.25)], "version_id string, song_id string, duration double")
    put("user_levels", [(1, dt.datetime(2018, 11, 1), "paid", "transition")], "user_id long, changed_at timestamp, new_level string, source string")
    return namespace


def load(spark, namespace, data) -> None:
    staged = spark.createDataFrame(data, EVENTS)

    def note(places):
        kept_facts.note_changes(spark, namespace, places)

    runs.promote(staged, f"{namespace}.events", ["event_id"], ["event_date"], before=note)


def refreshed(spark, namespace, *facts: str) -> dict:
    return runs.refresh_gold(spark, namespace, namespace, facts or tuple(GOLD_KEYS))


def compare(spark, namespace, *facts: str) -> None:
    for name in facts or GOLD_KEYS:
        table, whole = spark.table(f"{namespace}.{name}"), runs.build_gold(spark, name, namespace)
        assert table.columns == whole.columns and rows(table) == rows(whole), name


def test_refreshed_facts_equal_snapshots(spark, silver):
    """Days loaded in any order, again with other events, moved to other days, emptied, and without a date."""
    rng = random.Random(4)
    batches = [[(DAYS[1], range(12)), (DAYS[0], range(12, 20))], [(DAYS[2], range(6, 15))], [(None, range(24))]]
    for loads in batches:
        for day, keys in loads:
            load(spark, silver, [event(rng, k, day) for k in keys])
        refreshed(spark, silver)
        compare(spark, silver)
    assert refreshed(spark, silver, "song_facts") == {"song_facts": []}  # nothing changed, nothing read
    compare(spark, silver, "song_facts")


def test_a_refresh_reads_the_events_of_changed_days_only(spark, silver, monkeypatch):
    rng, read = random.Random(5), []
    sums = kept_facts.daily_sums
    monkeypatch.setattr(kept_facts, "daily_sums", lambda fact, events, versions: read.append(events) or sums(fact, events, versions))
    load(spark, silver, [event(rng, k, DAYS[0]) for k in range(30)])
    refreshed(spark, silver, "user_facts")
    load(spark, silver, [event(rng, k, DAYS[1]) for k in range(30, 40)])
    del read[:]
    assert refreshed(spark, silver, "user_facts") == {"user_facts": ["2018-11-02"]}
    files = [f for events in read for f in events.inputFiles()]
    assert len(read) == 1 and files and all("event_date=2018-11-02" in f for f in files)


@pytest.mark.parametrize("step", ["_put", "merged", "finished"])
def test_a_refresh_that_stopped_is_repaired_by_the_next(spark, silver, monkeypatch, step):
    rng = random.Random(6)
    load(spark, silver, [event(rng, k, DAYS[0]) for k in range(20)])
    refreshed(spark, silver, "session_facts")
    load(spark, silver, [event(rng, k, DAYS[1]) for k in range(5, 25)])

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(kept_facts, step, stop)
        with pytest.raises(RuntimeError):
            refreshed(spark, silver, "session_facts")
    refreshed(spark, silver, "session_facts")
    compare(spark, silver, "session_facts")


def test_what_is_kept_grows_with_the_plays(spark, silver):
    """A combination of values is one row, and no row is kept of keys to merge where no key was merged before."""
    rng = random.Random(8)
    load(spark, silver, [event(rng, k, DAYS[k % 5]) for k in range(200)])
    refreshed(spark, silver)
    compare(spark, silver)
    for name, groups in (("user_facts", 1), ("session_facts", 1), ("song_facts", 2), ("artist_facts", 2)):
        kept = spark.table(f"{silver}.{name}_combinations")
        assert 0 < kept.count() <= 200 * groups and "measure" not in kept.columns
        assert not spark.catalog.tableExists(f"{silver}.{name}_pending")


def test_days_kept_without_combinations_are_worked_out_again(spark, silver):
    """As in what was kept before there was that table; nothing has changed since."""
    rng = random.Random(9)
    load(spark, silver, [event(rng, k, DAYS[k % 3]) for k in range(30)])
    refreshed(spark, silver, "user_facts")
    spark.sql(f"DROP TABLE {silver}.user_facts_combinations")
    assert refreshed(spark, silver, "user_facts") == {"user_facts": [d.isoformat() for d in DAYS[:3]]}
    compare(spark, silver, "user_facts")


@pytest.mark.parametrize("days", [2, 10])
def test_many_dates_are_gathered_and_few_are_not(spark, silver, days):
    """The rows are those of a snapshot either way, also after an upsert."""
    rng, dates = random.Random(10), [dt.date(2018, 12, k + 1) for k in range(days)]
    for keys in (range(40), range(20, 60)):
        load(spark, silver, [event(rng, k, dates[k % days]) for k in keys])
        refreshed(spark, silver)
        compare(spark, silver)


# ---- arriving keys -----------------------------------------------------------------------------


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_arriving_keys_give_the_verdict_of_the_whole_check(spark, keys):
    """For every table whose other keys are unique."""
    rng = random.Random(7)
    for _ in range(6):
        held = [(k, None, "old") for k in range(20, 24)]
        arrived = [(rng.choice([1, 2, 3, None]), rng.choice([1, None]), "new") for _ in range(rng.randrange(1, 4))]
        schema = "a int, b int, v string"
        table = spark.createDataFrame(held + arrived, schema)
        some = spark.createDataFrame(arrived, schema)
        assert arriving_keys_unique(table, some, keys).first() == keys_unique(table, keys).first()


def test_keys_are_checked_whole_after_a_foreign_write(spark, namespace):
    table = f"{namespace}.t"

    def put(data):
        runs.promote(spark.createDataFrame(data, "k int, v string"), table, ["k"], check_keys=True)

    put([(1, "a"), (2, "b")])
    assert runs.keys_hold(spark, table, ["k"]) and not runs.keys_hold(spark, table, ["v"])
    put([(2, "B"), (3, "c")])
    assert runs.keys_hold(spark, table, ["k"])
    spark.sql(f"INSERT INTO {table} VALUES (1, 'again')")
    assert not runs.keys_hold(spark, table, ["k"])
    with pytest.raises(CheckFailed):
        put([(4, "d")])
    with pytest.raises(CheckFailed):  # what was not found unique is looked at whole again
        put([(5, "e")])


def test_known_keys_are_not_gathered(spark, namespace):
    """A small batch is broadcast; the rows of the table that share no key with it are not shuffled."""
    create_table(spark.range(10_000).select(F.col("id").alias("k")), f"{namespace}.t")
    table = spark.table(f"{namespace}.t")
    found = arriving_keys_unique(table, spark.range(5).select(F.col("id").alias("k")), ["k"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert text.index("LeftSemi") > text.index("hashpartitioning")  # the exchange stands above the join
