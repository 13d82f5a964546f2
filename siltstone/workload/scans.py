"""Reads: landing files, catalog tables, intervals, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.plans.values import UPGRADE_PAGE
from siltstone.sources import (
    create_table,
    has_input,
    in_interval,
    interval_rows,
    normalise_columns,
    read_landing,
    replace_table,
    scan,
    staged_view,
    stamp_interval,
    up_to_interval,
)
from siltstone.workload.feeds import BATCH, Feeds, millis
from siltstone.workload.registry import query
from siltstone.workload.sql import with_tables


@query("json_scan", "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value, props FROM events")
def json_scan(feeds: Feeds) -> DataFrame:
    _, scratch = feeds.scratch()
    rows = feeds.table("events").select(
        "event_id", millis("ts").alias("ts_ms"), "user_id", "event_type", "value", "props"
    )
    rows.write.json(f"{scratch}/landing")
    return read_landing(feeds.spark, f"{scratch}/landing")


@query("empty_input_guard", "SELECT event_id, event_type, value FROM events")
def empty_input_guard(feeds: Feeds) -> DataFrame:
    """A batch without rows leaves the table as it is."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.guarded"
    batch = feeds.table("events").select("event_id", "event_type", "value")
    for landed in (batch, batch.where("event_type = 'refund'")):
        if has_input(landed):
            replace_table(landed, table)
    return feeds.spark.table(table)


@query(
    "snake_case_columns",
    """
    SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus AS http_status,
           o_totalprice AS total_price, o_orderdate AS order__date, o_orderpriority AS priority
    FROM orders
    """,
)
def snake_case_columns(feeds: Feeds) -> DataFrame:
    camel = {
        "o_orderkey": "orderKey",
        "o_custkey": "customerID",
        "o_orderstatus": "HTTPStatus",
        "o_totalprice": "TotalPrice",
        "o_orderdate": "order_Date",
        "o_orderpriority": "priority",
    }
    return normalise_columns(feeds.table("orders").withColumnsRenamed(camel))


@query("interval_stamp", "SELECT event_id, user_id, value, '2024-01-31' AS data_interval FROM events")
def interval_stamp(feeds: Feeds) -> DataFrame:
    rows = feeds.table("events").select("event_id", "user_id", "value")
    return stamp_interval(rows, BATCH)


@query("catalog_scan", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def catalog_scan(feeds: Feeds) -> DataFrame:
    """Scans an external table over the given file; three of its columns are read."""
    namespace, _ = feeds.scratch()
    feeds.spark.sql(f"CREATE TABLE {namespace}.lines USING parquet LOCATION '{feeds.folder}/lineitem.parquet'")
    return scan(feeds.spark, f"{namespace}.lines", "l_orderkey", "l_partkey", "l_quantity")


@query(
    "interval_scan",
    with_tables(
        "SELECT user_id, ts, page, data_interval FROM user_logs WHERE data_interval = '2024-01-15'",
        "user_logs",
    ),
)
def interval_scan(feeds: Feeds) -> DataFrame:
    logs = feeds.user_log_table.select("user_id", "ts", "page", "data_interval")
    return in_interval(logs, "2024-01-15")


@query(
    "cumulative_interval_scan",
    with_tables(
        "SELECT user_id, ts, page, data_interval FROM user_logs WHERE data_interval <= '2024-01-15'",
        "user_logs",
    ),
)
def cumulative_interval_scan(feeds: Feeds) -> DataFrame:
    logs = feeds.user_log_table.select("user_id", "ts", "page", "data_interval")
    return up_to_interval(logs, "2024-01-15")


@query(
    "parameterised_query",
    with_tables(
        """
        SELECT user_id, ts, level FROM user_logs
        WHERE data_interval = '2024-01-15' AND page = 'Submit Upgrade'
        """,
        "user_logs",
    ),
)
def parameterised_query(feeds: Feeds) -> DataFrame:
    """Values are bound by Spark, not pasted into the text."""
    return feeds.spark.sql(
        "SELECT user_id, ts, level FROM {logs} WHERE data_interval = :interval AND page = :page",
        args={"interval": "2024-01-15", "page": UPGRADE_PAGE},
        logs=feeds.user_log_table,
    )


@query(
    "staged_view_query",
    """
    SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest
    FROM orders GROUP BY o_orderstatus
    """,
)
def staged_view_query(feeds: Feeds) -> DataFrame:
    with staged_view(feeds.table("orders"), "orders") as view:
        return feeds.spark.sql(
            "SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest "
            "FROM IDENTIFIER(:view) GROUP BY o_orderstatus",
            args={"view": view},
        )


@query(
    "interval_row_count",
    with_tables(
        "SELECT count(*) AS row_count FROM user_logs WHERE data_interval = '2024-01-05'", "user_logs"
    ),
)
def interval_row_count(feeds: Feeds) -> DataFrame:
    """Counts a partition of a table that was just written."""
    namespace, _ = feeds.scratch()
    create_table(feeds.user_logs, f"{namespace}.logs", ["data_interval"])
    return interval_rows(feeds.spark.table(f"{namespace}.logs"), "2024-01-05")


@query(
    "parquet_snappy_roundtrip",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def parquet_snappy_roundtrip(feeds: Feeds) -> DataFrame:
    namespace, _ = feeds.scratch()
    create_table(feeds.table("part"), f"{namespace}.parts")
    return feeds.spark.table(f"{namespace}.parts")


@query(
    "cte_composition",
    with_tables(
        """
        SELECT d.user_id, d.data_interval, d.changes, d.changes - t.busiest AS below_busiest
        FROM daily d JOIN (SELECT user_id, max(changes) AS busiest FROM daily GROUP BY user_id) t
          ON t.user_id = d.user_id
        """,
        "user_logs",
        daily="""
        SELECT user_id, data_interval, count(*) AS changes FROM user_logs
        WHERE user_id <> '' AND page <> 'NextSong' GROUP BY user_id, data_interval
        """,
    ),
)
def cte_composition(feeds: Feeds) -> DataFrame:
    """Named sub-queries and a derived table in one statement."""
    return feeds.spark.sql(
        """
        WITH changes AS (
            SELECT user_id, data_interval FROM {logs}
            WHERE user_id <> '' AND page IN ('Submit Upgrade', 'Submit Downgrade')
        ),
        daily AS (
            SELECT user_id, data_interval, count(*) AS changes FROM changes
            GROUP BY user_id, data_interval
        )
        SELECT d.user_id, d.data_interval, d.changes, d.changes - t.busiest AS below_busiest
        FROM daily d
        JOIN (SELECT user_id, max(changes) AS busiest FROM daily GROUP BY user_id) t
          ON t.user_id = d.user_id
        """,
        logs=feeds.user_logs,
    )
