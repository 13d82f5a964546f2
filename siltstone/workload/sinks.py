"""Writes: each query writes tables in a scratch namespace and returns one read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators import top_row
from siltstone.plans import raw
from siltstone.plans.runs import promote
from siltstone.plans.values import DOWNGRADE_PAGE, PAID, UPGRADE_PAGE
from siltstone.sources import (
    add_missing_columns,
    clustered,
    create_table,
    rename_columns,
    replace_partitions,
    replace_table,
    snake_case,
    upsert,
)
from siltstone.sources.types import typed
from siltstone.workload.feeds import Feeds, millis
from siltstone.workload.registry import ORACLES, query
from siltstone.workload.sql import with_tables


def _logs(feeds: Feeds) -> DataFrame:
    return feeds.user_logs.select(
        "user_id", "ts", "page", "level", "first_name", "data_interval"
    )


@query(
    "create_partitioned",
    with_tables("SELECT user_id, ts, page, level, first_name, data_interval FROM user_logs", "user_logs"),
)
def create_partitioned(feeds: Feeds) -> DataFrame:
    namespace, _ = feeds.scratch()
    create_table(clustered(_logs(feeds), ["data_interval"]), f"{namespace}.logs", ["data_interval"])
    return feeds.spark.table(f"{namespace}.logs")


@query(
    "partition_overwrite",
    with_tables(
        """
        SELECT user_id, ts, page,
               CASE WHEN data_interval IN ('2024-01-03', '2024-01-20') THEN 'paid' ELSE level END AS level,
               first_name, data_interval
        FROM user_logs
        """,
        "user_logs",
    ),
)
def partition_overwrite(feeds: Feeds) -> DataFrame:
    """Two intervals are delivered again with another level, twice; the rest stays."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.logs"
    logs = _logs(feeds)
    create_table(clustered(logs, ["data_interval"]), table, ["data_interval"])
    again = logs.where(F.col("data_interval").isin("2024-01-03", "2024-01-20"))
    for _ in range(2):
        replace_partitions(again.withColumn("level", F.lit(PAID)), table)
    return feeds.spark.table(table)


@query(
    "rename_migration",
    """
    SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS event_day FROM events
    """,
)
def rename_migration(feeds: Feeds) -> DataFrame:
    """A table written with source names, its partition column included, is renamed."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.events"
    source = feeds.table("events").select(
        F.col("event_id").alias("eventId"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        "value",
        F.date_format("ts", "yyyy-MM-dd").alias("eventDay"),
    )
    create_table(clustered(source, ["eventDay"]), table, ["eventDay"])
    rename_columns(feeds.spark, table, {name: snake_case(name) for name in source.columns})
    return feeds.spark.table(table)


@query(
    "add_columns",
    """
    SELECT event_id, value,
           CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-15' THEN event_type END AS event_type,
           CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-15' THEN user_id END AS user_id,
           strftime(ts, '%Y-%m-%d') AS data_interval
    FROM events
    """,
)
def add_columns(feeds: Feeds) -> DataFrame:
    """Later intervals bring two columns the earlier ones lack."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.events"
    rows = feeds.table("events").select(
        "event_id", "value", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("data_interval")
    )
    early = rows.where(F.col("data_interval") <= "2024-01-15").drop("user_id", "event_type")
    late = rows.where(F.col("data_interval") > "2024-01-15")
    create_table(clustered(early, ["data_interval"]), table, ["data_interval"])
    add_missing_columns(late, table)
    replace_partitions(clustered(late, ["data_interval"]), table)
    return feeds.spark.table(table)


@query(
    "keyed_upsert",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderdate >= DATE '1997-01-01' THEN nullif(o_orderstatus, 'P')
                ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderdate >= DATE '1997-01-01' THEN o_totalprice + 100.0
                ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderdate < DATE '1999-01-01' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderdate >= DATE '1997-01-01' THEN 'recounted' END AS remark
    FROM orders
    """,
)
def keyed_upsert(feeds: Feeds) -> DataFrame:
    """Orders before 1999, then orders since 1997 with changed prices, some NULL states, a new
    column and without the priority."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.orders"
    orders = feeds.table("orders")
    create_table(
        orders.where(F.col("o_orderdate") < "1999-01-01").select(
            "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
        ),
        table,
    )
    staged = orders.where(F.col("o_orderdate") >= "1997-01-01").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        (F.col("o_totalprice") + 100.0).alias("o_totalprice"),
        F.lit("recounted").alias("remark"),
    )
    upsert(staged, table, ["o_orderkey"])
    return feeds.spark.table(table)


@query(
    "keyed_upsert_composite",
    with_tables(
        """
        SELECT * FROM upgrades
        UNION ALL
        SELECT * FROM downgrades d WHERE NOT EXISTS (
            SELECT 1 FROM upgrades u WHERE u.user_id = d.user_id AND u.data_interval = d.data_interval)
        """,
        "user_logs",
        upgrades="""
        SELECT user_id, data_interval, page, max(ts) AS ts FROM user_logs
        WHERE user_id <> '' AND page = 'Submit Upgrade' GROUP BY user_id, data_interval, page
        """,
        downgrades="""
        SELECT user_id, data_interval, page, max(ts) AS ts FROM user_logs
        WHERE user_id <> '' AND page = 'Submit Downgrade' GROUP BY user_id, data_interval, page
        """,
    ),
)
def keyed_upsert_composite(feeds: Feeds) -> DataFrame:
    """Each user's last downgrade of a day, overwritten by the last upgrade of that day if any."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.changes"
    keys = ["user_id", "data_interval"]
    logs = feeds.user_logs.where("user_id <> ''").select(*keys, "page", "ts")
    last = {
        page: top_row(logs.where(F.col("page") == page), keys, [F.desc("ts")])
        for page in (DOWNGRADE_PAGE, UPGRADE_PAGE)
    }
    create_table(last[DOWNGRADE_PAGE], table)
    upsert(last[UPGRADE_PAGE], table, keys)
    return feeds.spark.table(table)


@query(
    "snapshot_replace",
    """
    SELECT event_type, count(*) AS events, max(value) AS largest FROM events GROUP BY event_type
    """,
)
def snapshot_replace(feeds: Feeds) -> DataFrame:
    """The second snapshot has another schema and leaves nothing of the first."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.summary"
    events = feeds.table("events")
    replace_table(events.groupBy("user_id").agg(F.count("*").alias("events")), table)
    replace_table(
        events.groupBy("event_type").agg(F.count("*").alias("events"), F.max("value").alias("largest")),
        table,
    )
    return feeds.spark.table(table)


@query("clustered_write", "SELECT event_id, user_id, value, event_type FROM events")
def clustered_write(feeds: Feeds) -> DataFrame:
    namespace, _ = feeds.scratch()
    rows = feeds.table("events").select("event_id", "user_id", "value", "event_type")
    create_table(clustered(rows, ["event_type"]), f"{namespace}.events", ["event_type"])
    return feeds.spark.table(f"{namespace}.events")


@query("create_or_update", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def create_or_update(feeds: Feeds) -> DataFrame:
    """The first promotion creates the table, the second adds a column to it."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.customers"
    customers = feeds.table("customer")
    promote(customers.select("c_custkey", "c_mktsegment"), table, ["c_custkey"])
    promote(customers.select("c_custkey", "c_acctbal"), table, ["c_custkey"])
    return feeds.spark.table(table)


_LINE_ORDER = """
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_quantity, l_shipdate, l_suppkey, ship_year"""


@query(
    "promote_table",
    f"""
    WITH lines AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, l_suppkey, l_linestatus,
               strftime(l_shipdate, '%Y') AS ship_year
        FROM lineitem),
    first_load AS (
        SELECT * EXCLUDE (l_linestatus) FROM lines WHERE l_linestatus = 'F'
        QUALIFY row_number() OVER ({_LINE_ORDER}) = 1),
    second_load AS (
        SELECT * EXCLUDE (l_linestatus) FROM lines WHERE l_linestatus = 'O'
        QUALIFY row_number() OVER ({_LINE_ORDER}) = 1)
    SELECT * FROM second_load
    UNION ALL
    SELECT * FROM first_load f WHERE NOT EXISTS (
        SELECT 1 FROM second_load s
        WHERE s.l_orderkey = f.l_orderkey AND s.l_linenumber = f.l_linenumber)
    """,
)
def promote_table(feeds: Feeds) -> DataFrame:
    """Two loads with duplicate keys into a partitioned table; updated rows change partition."""
    namespace, _ = feeds.scratch()
    table = f"{namespace}.lines"
    lines = feeds.table("lineitem").withColumn(
        "ship_year", F.date_format("l_shipdate", "yyyy")
    )
    for status in ("F", "O"):
        staged = lines.where(F.col("l_linestatus") == status).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "l_suppkey", "ship_year"
        )
        promote(staged, table, ["l_orderkey", "l_linenumber"], ["ship_year"])
    return feeds.spark.table(table)


@query(
    "ingest_raw",
    """
    SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms,
           CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-15' THEN props END AS props,
           CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-15' THEN '2024-01-31' ELSE '2024-01-15' END
               AS data_interval
    FROM events
    """,
)
def ingest_raw(feeds: Feeds) -> DataFrame:
    """Two landing batches with source-style names, the second with a new column and loaded twice."""
    namespace, scratch = feeds.scratch()
    landing = feeds.table("events").select(
        F.col("event_id").alias("eventId"),
        F.col("user_id").alias("userID"),
        F.col("event_type").alias("EventType"),
        "value",
        millis("ts").alias("tsMs"),
        "props",
        (F.date_format("ts", "yyyy-MM-dd") > "2024-01-15").alias("late"),
    )
    landing.where("NOT late").drop("props", "late").write.json(f"{scratch}/2024-01-15")
    landing.where("late").drop("late").write.json(f"{scratch}/2024-01-31")
    for interval in ("2024-01-15", "2024-01-31", "2024-01-31"):
        raw.ingest(feeds.spark, f"{scratch}/{interval}", f"{namespace}.events", interval)
    return feeds.spark.table(f"{namespace}.events")


@query(
    "ingest_type_drift",
    """
    SELECT event_id,
           CASE WHEN day <= '2024-01-10' THEN floor(value) ELSE value END AS value,
           CASE WHEN day <= '2024-01-10' THEN event_id * CAST(0.5 AS DOUBLE) WHEN day > '2024-01-20' THEN event_id * CAST(0.25 AS DOUBLE)
           END AS lat,
           CASE WHEN day > '2024-01-20' THEN event_type END AS note,
           CASE WHEN day <= '2024-01-10' THEN '2024-01-10' WHEN day <= '2024-01-20' THEN '2024-01-20'
                ELSE '2024-01-31' END AS data_interval
    FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)
    """,
)
def ingest_type_drift(feeds: Feeds) -> DataFrame:
    """Whole numbers, then fractions and a column without values, then a new column."""
    return _drifting(feeds)


def _drifting(feeds: Feeds, *variants: str) -> DataFrame:
    namespace, scratch = feeds.scratch()
    day, events = F.date_format("ts", "yyyy-MM-dd"), feeds.table("events")
    half, quarter = F.col("event_id") * F.lit(0.5), F.col("event_id") * F.lit(0.25)
    batches = {
        "2024-01-10": events.where(day <= "2024-01-10").select(
            "event_id", F.floor("value").alias("value"), half.alias("lat")
        ),
        "2024-01-20": events.where((day > "2024-01-10") & (day <= "2024-01-20")).select(
            "event_id", "value", F.lit(None).cast("double").alias("lat")
        ),
        "2024-01-31": events.where(day > "2024-01-20").select(
            "event_id", "value", quarter.alias("lat"), F.col("event_type").alias("note")
        ),
    }
    for interval, batch in batches.items():
        batch.write.option("ignoreNullFields", "false").json(f"{scratch}/{interval}")
        raw.ingest(feeds.spark, f"{scratch}/{interval}", f"{namespace}.events", interval, variants=variants)
    return feeds.spark.table(f"{namespace}.events")


@query("ingest_variant_drift", ORACLES["ingest_type_drift"])
def ingest_variant_drift(feeds: Feeds) -> DataFrame:
    """The same batches with both drifting columns kept as they came, so no batch rewrites another."""
    kept = _drifting(feeds, "value", "lat")
    return typed(kept, {"value": "double", "lat": "double"})
