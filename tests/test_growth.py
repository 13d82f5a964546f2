"""Tables whose files are small and whose rows are many: what is broadcast, and how often the log is built."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from siltstone import session
from siltstone.session import BROADCAST_THRESHOLDS, session_setting
from siltstone.workload import QUERIES, builders, feeds
from siltstone.workload.scratch import drop_namespaces

PARTS, ORDERS = 120_000, 40


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Far more parts than order lines; their file is small, as most values repeat."""
    at, k = str(tmp_path_factory.mktemp("tables")), F.col("id")
    tables = {
        "part": spark.range(0, PARTS, 1, 1).selectExpr(
            "id AS p_partkey", "'ring' AS p_name", "concat('Brand#', id % 5) AS p_brand", "'LARGE' AS p_type",
            "int(id % 50) AS p_size", "900.0D + id % 100 AS p_retailprice",
        ),
        "customer": spark.range(0, 10, 1, 1).selectExpr(
            "id AS c_custkey", "concat('C', id) AS c_name", "'AUTO' AS c_mktsegment", "double(id) - 3 AS c_acctbal"
        ),
        "orders": spark.range(0, ORDERS, 1, 1).selectExpr(
            "id AS o_orderkey", "id % 10 AS o_custkey", "if(id % 7 = 0, 'P', 'O') AS o_orderstatus"
        ),
        "lineitem": spark.range(0, 6 * ORDERS, 1, 1).select(
            (k % ORDERS).alias("l_orderkey"), (k * 37 % PARTS).alias("l_partkey"), (k % 9).alias("l_suppkey"),
            F.expr(f"int(id div {ORDERS}) + 1 AS l_linenumber"), F.expr("(id % 10) / 100D AS l_discount"),
            F.expr("if(id % 3 = 0, 'N', 'A') AS l_returnflag"), F.lit("O").alias("l_linestatus"),
            F.expr("timestamp'1997-06-01' + make_interval(0, 0, 0, int(id * 5)) AS l_shipdate"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{at}/{name}.parquet")
    return at


def broadcast(text: str) -> str:
    """The parts of a plan that stand below a broadcast."""
    kept, depth = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-*"))
        if depth is not None and indent <= depth:
            depth = None
        if depth is None and "BroadcastExchange" in line:
            depth = indent
        elif depth is not None:
            kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize(
    "name", ["left_join_lookup", "tolerance_join", "star_resolution", "session_facts", "user_facts"]
)
def test_many_rows_of_a_small_file_are_not_broadcast_unmeasured(spark, folder, name):
    """A measured size does not take a broadcast back, so none may rest on the size of the file of parts."""
    df = QUERIES[name](spark, folder)
    text = plan(df)
    assert "part.parquet" in text and "part.parquet" not in broadcast(text)
    # A small file is broadcast all the same.
    assert "BroadcastExchange" in plan(QUERIES["left_join_latest"](spark, folder))
    drop_namespaces(spark)


@pytest.mark.parametrize("name", ["tolerance_join", "session_facts"])
def test_a_session_that_allows_large_broadcasts_gets_small_ones(spark, folder, monkeypatch, name):
    planned, measured = BROADCAST_THRESHOLDS
    with session_setting(spark, planned, "1g"):
        assert "part.parquet" not in broadcast(plan(QUERIES[name](spark, folder)))
    monkeypatch.setattr(session, "LARGEST_BROADCAST", 1)
    with session_setting(spark, planned, "1"), session_setting(spark, measured, "1g"):
        df = QUERIES[name](spark, folder)
        assert df.collect()
        ran = plan(df).split("== Initial Plan ==")[0]
    assert "part.parquet" in ran and "part.parquet" not in broadcast(ran)


@pytest.mark.parametrize(
    "allowed, kept", [("-1", "-1"), ("256k", "256k"), ("10MB", "10MB"), ("11m", "10485760"), ("1g", "10485760")]
)
def test_a_session_may_allow_smaller_broadcasts_only(spark, folder, allowed, kept):
    for key in BROADCAST_THRESHOLDS:
        with session_setting(spark, key, allowed):
            QUERIES["project_rename"](spark, folder)
            assert spark.conf.get(key) == kept


@pytest.mark.parametrize("name", ["song_facts_refreshed"])
def test_the_log_is_joined_once(spark, folder, monkeypatch, name):
    """Users, levels and plays are built from the log as a table."""
    read, build = [], builders.create_table

    def create(df, *rest):
        read.append(plan(df).count("lineitem.parquet"))
        build(df, *rest)

    for module in (builders, feeds):
        monkeypatch.setattr(module, "create_table", create)
    QUERIES[name](spark, folder)
    drop_namespaces(spark)
    assert sum(read) == 1


def test_session_facts_read_the_plays_from_a_table(spark, folder, monkeypatch):
    """They are read twice, so the joins of the log would stand in one plan with those of the users, and twice."""
    read, build = [], feeds.create_table

    def create(df, *rest):
        read.append(plan(df).count("lineitem.parquet"))
        build(df, *rest)

    monkeypatch.setattr(feeds, "create_table", create)
    df = QUERIES["session_facts"](spark, folder)
    assert read == [1, 1] and "lineitem.parquet" not in plan(df)
    assert df.count()
    drop_namespaces(spark)
