"""Physical plans: what is read, what is shuffled, and what happens to hot keys."""

from __future__ import annotations

import contextlib
import io
from contextlib import ExitStack

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from siltstone import operators as op
from siltstone.plans import gold, silver
from siltstone.session import session_setting
from siltstone.sources import create_table, in_interval, merge_rows
from siltstone.sources.upsert import touched
from siltstone.workload import QUERIES
from siltstone.workload.feeds import Feeds
from siltstone.workload.scratch import drop_namespaces


def plan(df) -> str:
    text = io.StringIO()
    whole = session_setting(df.sparkSession, "spark.sql.maxMetadataStringLength", "10000")
    with whole, contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


@pytest.fixture()
def raw_logs(spark, namespace):
    logs = Feeds(spark, SMALL).play_logs.withColumn("data_interval", F.col("data_interval").substr(1, 4))
    create_table(logs, f"{namespace}.logs", ["data_interval"])
    return spark.table(f"{namespace}.logs")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    drop_namespaces(spark)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Limit "):
        assert unwanted not in text.replace("WindowGroupLimit ", "")


def test_intervals_prune_partitions_and_predicates_reach_the_scan(raw_logs):
    text = plan(silver.plays(raw_logs, "1998"))
    assert "PartitionFilters: [isnotnull(data_interval" in text
    for pushed in ("EqualTo(page,NextSong)", "GreaterThan(length,0.0)", "IsNotNull(user_id)", "IsNotNull(song)"):
        assert pushed in text
    schema = text.split("ReadSchema: ")[1]
    assert "auth" not in schema and "length" in schema
    assert "Exchange" not in text


def test_an_interval_reads_only_its_files(raw_logs):
    assert len(in_interval(raw_logs, "1998").inputFiles()) >= 1
    text = plan(in_interval(raw_logs, "1998").select("user_id"))
    assert "ReadSchema: struct<user_id:string>" in text


@pytest.mark.parametrize("table", ["users", "artists", "songs", "user_levels", "events"])
def test_one_row_per_key_is_taken_before_the_shuffle(spark, table):
    text = plan(getattr(Feeds(spark, SMALL), table))
    assert "row_number(), 1, Partial" in text


def test_versions_are_deduplicated_without_a_sort(spark):
    text = plan(Feeds(spark, SMALL).song_versions)
    assert "Window" not in text and "Sort" not in text


def test_gold_reads_the_needed_event_columns_only(spark, namespace):
    feeds = Feeds(spark, SMALL)
    create_table(feeds.events, f"{namespace}.events")
    text = plan(gold.artist_facts(feeds.artists, spark.table(f"{namespace}.events")))
    scan = next(line for line in text.splitlines() if "events" in line and "ReadSchema" in line)
    assert "location" not in scan and "event_id" not in scan and "user_agent" not in scan


def test_level_history_is_read_once(spark, namespace):
    feeds = Feeds(spark, SMALL)
    create_table(feeds.user_levels, f"{namespace}.levels")
    text = plan(gold.level_state(spark.table(f"{namespace}.levels")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_session_facts_resolve_plays_once(spark):
    """Both passes over the events start from one shuffle."""
    feeds = Feeds(spark, SMALL)
    facts = gold.session_facts(feeds.events, feeds.song_versions)
    facts.collect()
    final = plan(facts).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("lineitem.parquet") == 2  # plays, users


def test_a_small_batch_merges_without_shuffling_the_target(spark, namespace):
    create_table(spark.range(1000).select("id", F.lit("x").alias("v")), f"{namespace}.target")
    create_table(spark.range(10).select("id", F.lit("y").alias("v")), f"{namespace}.staged")
    merged = merge_rows(spark.table(f"{namespace}.target"), spark.table(f"{namespace}.staged"), ["id"])
    text = plan(merged)
    assert "LeftAnti, BuildRight" in text
    assert "hashpartitioning" not in text


def test_clustering_an_upsert_shuffles_the_staged_rows_only(spark, namespace):
    for name, count, partition_by in (("target", 1000, ["day"]), ("staged", 10, [])):
        rows = spark.range(count).select("id", F.lit("x").alias("v"), (F.col("id") % 3).alias("day"))
        create_table(rows, f"{namespace}.{name}", partition_by)
    target, staged = (spark.table(f"{namespace}.{name}") for name in ("target", "staged"))
    text = plan(merge_rows(target, staged, ["id"], ["day"]))
    # The staged rows are clustered, matched ones gathered by key; nothing that reads the target alone.
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1 and text.count("hashpartitioning") == 3
    assert text.index("LeftAnti, BuildRight") < text.index("REBALANCE_PARTITIONS_BY_COL")
    assert "row_number(), 1, Partial" not in text and "LeftSemi, BuildRight" in text
    assert "target" in text[: text.index("REBALANCE_PARTITIONS_BY_COL")]


def test_an_upsert_of_few_partitions_shuffles_no_staged_row(spark, namespace):
    """Where no matched key repeats and no column is kept, staged rows are only read; keys are compared by marks."""
    for name, count in (("target", 1000), ("staged", 10)):
        rows = spark.range(count).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), (F.col("id") % 3).alias("day"))
        create_table(rows, f"{namespace}.{name}", ["day"] if name == "target" else [])
    target, staged = (spark.table(f"{namespace}.{name}") for name in ("target", "staged"))
    text = plan(merge_rows(target, staged, ["id"], ["day"], matched_once=True, gather=False))
    assert "Exchange" not in text.replace("BroadcastExchange", "") and "LeftAnti, BuildRight" in text
    places = plan(touched(target, staged, ["id"], ["day"]))
    assert "xxhash64" in places and "hashpartitioning(id" not in places


SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("shape", ["known", "known_top_row", "lookup", "membership", "tolerance"])
def test_a_key_with_a_third_of_the_rows_is_split(spark, no_broadcast, shape):
    """The plan that ran splits the hot partition, and the result is whole."""
    with ExitStack() as stack:
        for key, value in SKEW.items():
            stack.enter_context(session_setting(spark, key, value))
        facts = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.lit(1.0).alias("length"),
        )
        dimension = spark.range(0, 5000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = {
            "known": lambda: op.keep_known(facts, dimension, ["k"]),
            "known_top_row": lambda: op.keep_known(facts, op.top_row(dimension, ["k"]), ["k"]),
            "lookup": lambda: op.lookup(facts, dimension.groupBy("k").agg(F.max("w").alias("w")), ["k"]),
            "membership": lambda: op.membership(facts, dimension, ["k"], "known"),
            "tolerance": lambda: op.tolerance_join(
                facts,
                dimension.select(F.col("k").alias("rk"), F.lit(1.001).alias("duration")),
                {"k": "rk"},
                "length",
                "duration",
                0.01,
            ),
        }[shape]()
        counted = joined.groupBy(F.abs(F.hash(*joined.columns) % 50).alias("part")).count()
        assert sum(row["count"] for row in counted.collect()) == 120_000
        assert "skew=true" in plan(counted)


def test_a_hot_key_is_split_where_the_join_is_followed_by_a_ranking(spark, no_broadcast):
    """Join and ranking share the key; the join is split all the same."""
    with ExitStack() as stack:
        for key, value in SKEW.items():
            stack.enter_context(session_setting(spark, key, value))
        facts = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        dimension = spark.range(0, 5000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        nearest = op.top_row(op.lookup(facts, dimension, ["k"]), ["k"], ["v"])
        assert len(nearest.collect()) == 5000
        assert "skew=true" in plan(nearest)


def test_rows_are_sorted_inside_partitions(spark):
    from siltstone.workload import QUERIES

    name = "sort_within_partitions"
    assert "Sort [" in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize(
    "name", ["interval_scan", "cumulative_interval_scan", "parameterised_query", "check_has_rows"]
)
def test_registered_interval_queries_prune_partitions(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    drop_namespaces(spark)
    assert "PartitionFilters: [isnotnull(data_interval" in text


def test_an_upsert_reads_the_target_twice(spark, namespace):
    """Once for the rows that stay, once for the kept columns of those that change."""
    create_table(spark.createDataFrame([(1, "a", "b")], "k int, v string, own string"), f"{namespace}.t")
    target = spark.table(f"{namespace}.t")
    text = plan(merge_rows(target, spark.createDataFrame([(1, "c")], "k int, v string"), ["k"]))
    assert text.count("FileScan parquet") == 2
