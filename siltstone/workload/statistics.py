"""Aggregations, row selection, sorts and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import distance, share
from siltstone.operators import (
    drop_duplicate_keys,
    has_rows,
    keys_unique,
    null_ratio_below,
    play_rollup,
    top_row,
    union_tagged,
)
from siltstone.operators.aggregates import count_where, sum_or_zero
from siltstone.plans.values import INITIAL, TRANSITION, UNRESOLVED_LIMIT
from siltstone.sources import in_interval
from siltstone.workload.feeds import Feeds
from siltstone.workload.registry import query
from siltstone.workload.sql import with_tables


def _events(feeds: Feeds) -> DataFrame:
    return feeds.table("events")


@query("group_count", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def group_count(feeds: Feeds) -> DataFrame:
    return _events(feeds).groupBy("event_type").agg(F.count("*").alias("events"))


@query(
    "multi_count_distinct",
    """
    SELECT l_suppkey, count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
           count(DISTINCT l_partkey) AS parts, count(DISTINCT l_linenumber) AS numbers,
           min(l_shipdate) AS first_shipped, max(l_shipdate) AS last_shipped
    FROM lineitem GROUP BY l_suppkey
    """,
)
def multi_count_distinct(feeds: Feeds) -> DataFrame:
    return play_rollup(
        feeds.table("lineitem"),
        ["l_suppkey"],
        plays_as="lines",
        distinct={"orders": "l_orderkey", "parts": "l_partkey", "numbers": "l_linenumber"},
        first_as="first_shipped",
        last_as="last_shipped",
        time="l_shipdate",
    )


@query(
    "first_last_seen",
    "SELECT user_id, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM events GROUP BY user_id",
)
def first_last_seen(feeds: Feeds) -> DataFrame:
    return (
        _events(feeds)
        .groupBy("user_id")
        .agg(F.min("ts").alias("first_seen_at"), F.max("ts").alias("last_seen_at"))
    )


@query(
    "sum_or_zero",
    """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
           round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0.0), 2) AS spent
    FROM events GROUP BY ALL
    """,
)
def sum_of_purchases(feeds: Feeds) -> DataFrame:
    """Days without a purchase sum to 0.0."""
    spent = F.when(F.col("event_type") == "purchase", F.col("value"))
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return (
        _events(feeds).groupBy("user_id", day).agg(F.round(sum_or_zero(spent), 2).alias("spent"))
    )


@query(
    "conditional_count",
    """
    SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases
    FROM events GROUP BY user_id
    """,
)
def conditional_count(feeds: Feeds) -> DataFrame:
    purchases = count_where(F.col("event_type") == "purchase").alias("purchases")
    return _events(feeds).groupBy("user_id").agg(purchases)


@query(
    "paid_share",
    """
    SELECT c_custkey AS user_id,
           CASE WHEN coalesce(seen, 0) = 0 THEN 0.0 ELSE CAST(paid AS DOUBLE) / seen END AS paid_share
    FROM customer LEFT JOIN (
        SELECT user_id, count(*) AS seen, count(CASE WHEN value > 10 THEN 1 END) AS paid
        FROM events GROUP BY user_id) e ON e.user_id = c_custkey
    """,
)
def paid_share(feeds: Feeds) -> DataFrame:
    """Customers without events have share 0.0."""
    counts = (
        _events(feeds)
        .groupBy("user_id")
        .agg(F.count("*").alias("seen"), count_where(F.col("value") > 10).alias("paid"))
    )
    customers = feeds.table("customer").select(F.col("c_custkey").alias("user_id"))
    joined = customers.join(counts, "user_id", "left")
    return joined.select("user_id", share("paid", "seen").alias("paid_share"))


@query(
    "multi_key_group",
    """
    SELECT l_returnflag, l_linestatus, l_suppkey, count(*) AS lines, max(l_extendedprice) AS dearest
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_suppkey
    """,
)
def multi_key_group(feeds: Feeds) -> DataFrame:
    return (
        feeds.table("lineitem")
        .groupBy("l_returnflag", "l_linestatus", "l_suppkey")
        .agg(F.count("*").alias("lines"), F.max("l_extendedprice").alias("dearest"))
    )


@query("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem")
def distinct_keys(feeds: Feeds) -> DataFrame:
    lines = feeds.table("lineitem")
    return lines.select("l_suppkey", "l_returnflag", "l_linenumber").distinct()


@query(
    "drop_duplicates",
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_discount, l_extendedprice, l_linestatus, l_partkey,
                 l_quantity, l_returnflag, l_suppkey, l_tax) = 1
    """,
)
def drop_duplicates(feeds: Feeds) -> DataFrame:
    """The latest shipment per order line number."""
    lines = feeds.table("lineitem")
    return drop_duplicate_keys(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query(
    "global_aggregate",
    with_tables(
        """
        SELECT count(*) AS row_count, count(DISTINCT data_interval) AS intervals, max(ts) AS latest
        FROM user_logs
        """,
        "user_logs",
    ),
)
def global_aggregate(feeds: Feeds) -> DataFrame:
    return feeds.user_logs.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("data_interval").alias("intervals"),
        F.max("ts").alias("latest"),
    )


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey, o_totalprice) = 1
    """,
)
def latest_per_key(feeds: Feeds) -> DataFrame:
    orders = feeds.table("orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return top_row(orders, ["o_custkey"], [F.desc("o_orderdate")])


@query(
    "earliest_per_key",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey, o_totalprice) = 1
    """,
)
def earliest_per_key(feeds: Feeds) -> DataFrame:
    orders = feeds.table("orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return top_row(orders, ["o_custkey"], ["o_orderdate"])


@query(
    "most_complete_per_key",
    with_tables(
        """
        SELECT song_id, artist_location, artist_latitude, year, duration FROM catalogue
        QUALIFY row_number() OVER (
            PARTITION BY song_id
            ORDER BY artist_latitude IS NULL, year IS NULL, artist_latitude NULLS FIRST,
                     artist_location NULLS FIRST, duration, year NULLS FIRST) = 1
        """,
        "catalogue",
    ),
)
def most_complete_per_key(feeds: Feeds) -> DataFrame:
    rows = feeds.catalogue.select(
        "song_id", "artist_location", "artist_latitude", "year", "duration"
    )
    flags = [F.col("artist_latitude").isNull(), F.col("year").isNull()]
    return top_row(rows, ["song_id"], flags)


@query(
    "nearest_per_key",
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice,
           abs(l_extendedprice - p_retailprice) AS gap
    FROM lineitem JOIN part ON p_partkey = l_partkey
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey ORDER BY gap, l_extendedprice, l_linenumber, l_orderkey) = 1
    """,
)
def nearest_per_key(feeds: Feeds) -> DataFrame:
    """Per part, the order line priced nearest to the list price."""
    lines = feeds.table("lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    parts = feeds.table("part").select(
        F.col("p_partkey").alias("l_partkey"), "p_retailprice"
    )
    gaps = lines.join(parts, "l_partkey").withColumn("gap", distance("l_extendedprice", "p_retailprice"))
    return top_row(gaps.drop("p_retailprice"), ["l_partkey"], ["gap"])


@query(
    "canonical_per_key",
    with_tables(
        """
        SELECT song_id, title, artist_id, year FROM catalogue
        QUALIFY row_number() OVER (
            PARTITION BY song_id ORDER BY year DESC NULLS LAST, artist_id, title) = 1
        """,
        "catalogue",
    ),
)
def canonical_per_key(feeds: Feeds) -> DataFrame:
    rows = feeds.catalogue.select("song_id", "title", "artist_id", "year")
    return top_row(rows, ["song_id"], [F.col("year").desc_nulls_last()])


@query(
    "priority_dedup",
    """
    SELECT user_id, day, source, ts, value FROM (
        SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, ts, value,
               CASE event_type WHEN 'purchase' THEN 'transition' ELSE 'initial' END AS source
        FROM events WHERE event_type IN ('purchase', 'view'))
    QUALIFY row_number() OVER (
        PARTITION BY user_id, day ORDER BY source = 'transition' DESC, source, ts, value) = 1
    """,
)
def priority_dedup(feeds: Feeds) -> DataFrame:
    """Per user and day, a purchase if there is one, otherwise a view."""
    events = _events(feeds).select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "value", "event_type"
    )
    sources = {
        source: events.where(F.col("event_type") == kind).drop("event_type")
        for source, kind in {TRANSITION: "purchase", INITIAL: "view"}.items()
    }
    first = [(F.col("source") == TRANSITION).desc()]
    return top_row(union_tagged(sources), ["user_id", "day"], first)


@query(
    "any_per_key",
    with_tables(
        """
        SELECT song_id, duration, artist_name, year FROM catalogue
        QUALIFY row_number() OVER (
            PARTITION BY song_id, duration ORDER BY artist_name, year NULLS FIRST) = 1
        """,
        "catalogue",
    ),
)
def any_per_key(feeds: Feeds) -> DataFrame:
    rows = feeds.catalogue.select("song_id", "duration", "artist_name", "year")
    return top_row(rows, ["song_id", "duration"])


@query(
    "top_one_per_group",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_suppkey
        ORDER BY l_extendedprice DESC NULLS LAST, l_linenumber, l_orderkey, l_partkey) = 1
    """,
)
def top_one_per_group(feeds: Feeds) -> DataFrame:
    lines = feeds.table("lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return top_row(lines, ["l_suppkey"], [F.desc("l_extendedprice")])


@query("sort_within_partitions", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def sort_within_partitions(feeds: Feeds) -> DataFrame:
    """Sorts each task's rows; there is no shuffle."""
    orders = feeds.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.sortWithinPartitions("o_orderdate")


def _verdicts(checks: dict[str, DataFrame]) -> DataFrame:
    return union_tagged(checks, tag="subject")


@query(
    "check_has_rows",
    with_tables(
        """
        SELECT 'present' AS subject, CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS passed
        FROM user_logs WHERE data_interval = '2024-01-15'
        UNION ALL
        SELECT 'absent' AS subject, CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS passed
        FROM user_logs WHERE data_interval = '2025-01-15'
        """,
        "user_logs",
    ),
)
def check_has_rows(feeds: Feeds) -> DataFrame:
    logs = feeds.user_log_table
    return _verdicts(
        {
            "present": has_rows(in_interval(logs, "2024-01-15")),
            "absent": has_rows(in_interval(logs, "2025-01-15")),
        }
    )


@query(
    "check_pk_single",
    """
    SELECT 'orders' AS subject,
           CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 1 ELSE 0 END AS passed FROM orders
    UNION ALL
    SELECT 'lines' AS subject,
           CASE WHEN count(*) = count(DISTINCT l_orderkey) THEN 1 ELSE 0 END AS passed FROM lineitem
    """,
)
def check_pk_single(feeds: Feeds) -> DataFrame:
    return _verdicts(
        {
            "orders": keys_unique(feeds.table("orders"), ["o_orderkey"]),
            "lines": keys_unique(feeds.table("lineitem"), ["l_orderkey"]),
        }
    )


@query(
    "check_pk_composite",
    with_tables(
        """
        SELECT 'levels' AS subject,
               CASE WHEN count(*) = count(DISTINCT (user_id, changed_at)) THEN 1 ELSE 0 END AS passed
        FROM user_levels
        UNION ALL
        SELECT 'lines' AS subject,
               CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) THEN 1 ELSE 0 END AS passed
        FROM lineitem
        """,
        "user_levels",
    ),
)
def check_pk_composite(feeds: Feeds) -> DataFrame:
    lines = feeds.table("lineitem")
    return _verdicts(
        {
            "levels": keys_unique(feeds.user_levels, ["user_id", "changed_at"]),
            "lines": keys_unique(lines, ["l_orderkey", "l_linenumber"]),
        }
    )


@query(
    "check_null_ratio",
    with_tables(
        """
        SELECT subject, CASE WHEN missing < 0.30 THEN 1 ELSE 0 END AS passed
        FROM (
            SELECT 'year' AS subject, avg(CASE WHEN year IS NULL THEN 1.0 ELSE 0.0 END) AS missing
            FROM catalogue
            UNION ALL
            SELECT 'longitude', avg(CASE WHEN artist_longitude IS NULL THEN 1.0 ELSE 0.0 END)
            FROM catalogue)
        """,
        "catalogue",
    ),
)
def check_null_ratio(feeds: Feeds) -> DataFrame:
    feed = feeds.catalogue
    return _verdicts(
        {
            "year": null_ratio_below(feed, "year", UNRESOLVED_LIMIT),
            "longitude": null_ratio_below(feed, "artist_longitude", UNRESOLVED_LIMIT),
        }
    )
