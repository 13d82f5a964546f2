"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import (
    as_integer,
    as_long,
    date_from_epoch_ms,
    distance,
    id_from_text,
    or_default,
    ratio,
    seconds_between,
    sentinel_to_null,
    surrogate_key,
    timestamp_from_epoch_ms,
    translate,
    version_key,
)
from siltstone.plans.values import LEVEL_AFTER
from siltstone.workload.feeds import Feeds, millis
from siltstone.workload.registry import query
from siltstone.workload.sql import with_tables


@query(
    "surrogate_key",
    """
    SELECT l_orderkey, l_suppkey, l_linenumber,
           sha256(concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                            CAST(nullif(l_linenumber, 1) AS VARCHAR))) AS line_id
    FROM lineitem
    """,
)
def line_keys(feeds: Feeds) -> DataFrame:
    """First lines have no number in their key."""
    lines = feeds.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    number = F.nullif("l_linenumber", F.lit(1))
    return lines.withColumn("line_id", surrogate_key("l_orderkey", "l_suppkey", number))


@query(
    "version_key",
    with_tables(
        """
        SELECT song_id, duration, year,
               sha256(song_id || ':' || CAST(duration AS VARCHAR)) AS version_id,
               sha256(song_id || ':' || CAST(CAST(year AS DOUBLE) AS VARCHAR)) AS year_id
        FROM catalogue
        """,
        "catalogue",
    ),
)
def catalogue_keys(feeds: Feeds) -> DataFrame:
    """A key from a DOUBLE and one from a BIGINT that may be NULL."""
    feed = feeds.catalogue.select("song_id", "duration", "year")
    return feed.withColumns(
        {"version_id": version_key("song_id", "duration"), "year_id": version_key("song_id", "year")}
    )


@query(
    "epoch_to_timestamp",
    "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 // 1000 * 1000000) AS seen_at FROM events",
)
def epoch_to_timestamp(feeds: Feeds) -> DataFrame:
    events = feeds.table("events").select("event_id", millis("ts").alias("ts"))
    return events.select("event_id", timestamp_from_epoch_ms("ts").alias("seen_at"))


@query("epoch_to_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_date FROM events")
def epoch_to_date(feeds: Feeds) -> DataFrame:
    events = feeds.table("events").select("event_id", millis("ts").alias("ts"))
    return events.select("event_id", date_from_epoch_ms("ts").alias("event_date"))


@query(
    "duration_seconds",
    """
    SELECT l_orderkey, date_diff('second', o_orderdate, l_shipdate) AS seconds
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def duration_seconds(feeds: Feeds) -> DataFrame:
    """From order to shipment."""
    lines = feeds.table("lineitem").select("l_orderkey", "l_shipdate")
    orders = feeds.table("orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", seconds_between("o_orderdate", "l_shipdate").alias("seconds"))


@query(
    "typed_casts",
    with_tables(
        """
        SELECT first_name, TRY_CAST(user_id AS BIGINT) AS user_id,
               TRY_CAST(level AS BIGINT) AS level_id,
               TRY_CAST(TRY_CAST(user_id AS DOUBLE) AS BIGINT) AS number_id,
               TRY_CAST(substr(first_name, 2) AS INTEGER) AS event_number,
               TRY_CAST(substr(last_name, 2) AS BIGINT) AS log_user,
               CAST(registration AS DOUBLE) AS registration, CAST(ts AS VARCHAR) AS ts
        FROM user_logs
        """,
        "user_logs",
    ),
)
def typed_casts(feeds: Feeds) -> DataFrame:
    """Text that is no number (an empty id, a level) becomes NULL; ids may also arrive as DOUBLE."""
    return feeds.user_logs.select(
        "first_name",
        id_from_text("user_id").alias("user_id"),
        id_from_text("level").alias("level_id"),
        id_from_text(F.col("user_id").try_cast("double")).alias("number_id"),
        as_integer(F.substr(F.col("first_name"), F.lit(2))).alias("event_number"),
        as_long(F.substr(F.col("last_name"), F.lit(2))).alias("log_user"),
        F.col("registration").cast("double").alias("registration"),
        F.col("ts").cast("string").alias("ts"),
    )


@query(
    "map_level",
    with_tables(
        """
        SELECT first_name, page,
               CASE page WHEN 'Submit Upgrade' THEN 'paid' WHEN 'Submit Downgrade' THEN 'free' END
                   AS new_level
        FROM user_logs
        """,
        "user_logs",
    ),
)
def map_level(feeds: Feeds) -> DataFrame:
    logs = feeds.user_logs.select("first_name", "page")
    return logs.withColumn("new_level", translate("page", LEVEL_AFTER))


@query(
    "sentinel_to_null",
    with_tables("SELECT song_id, duration, nullif(year, 0) AS year FROM catalogue", "catalogue"),
)
def unknown_years(feeds: Feeds) -> DataFrame:
    feed = feeds.catalogue.select("song_id", "duration", "year")
    return feed.withColumn("year", sentinel_to_null("year"))


@query(
    "coalesce_default",
    with_tables(
        """
        SELECT song_id, duration, coalesce(artist_location, 'unknown') AS location,
               coalesce(artist_latitude, 0.0) AS latitude
        FROM catalogue
        """,
        "catalogue",
    ),
)
def coalesce_default(feeds: Feeds) -> DataFrame:
    return feeds.catalogue.select(
        "song_id",
        "duration",
        or_default("artist_location", "unknown").alias("location"),
        or_default("artist_latitude", 0.0).alias("latitude"),
    )


@query(
    "abs_difference",
    """
    SELECT l_orderkey, l_linenumber, abs(l_extendedprice - o_totalprice) AS difference
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def abs_difference(feeds: Feeds) -> DataFrame:
    lines = feeds.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    orders = feeds.table("orders").select("o_orderkey", "o_totalprice")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", distance("l_extendedprice", "o_totalprice").alias("difference")
    )


@query(
    "float_ratio",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS DOUBLE) / l_linenumber AS suppliers_per_line
    FROM lineitem
    """,
)
def float_ratio(feeds: Feeds) -> DataFrame:
    return feeds.table("lineitem").select(
        "l_orderkey", "l_linenumber", ratio("l_suppkey", "l_linenumber").alias("suppliers_per_line")
    )


@query("literal_tag", "SELECT event_id, 'transition' AS source, TRUE AS is_converted FROM events")
def literal_tag(feeds: Feeds) -> DataFrame:
    return feeds.table("events").select(
        "event_id", F.lit("transition").alias("source"), F.lit(True).alias("is_converted")
    )


@query(
    "null_to_boolean",
    with_tables("SELECT song_id, duration, year IS NOT NULL AS is_dated FROM catalogue", "catalogue"),
)
def null_to_boolean(feeds: Feeds) -> DataFrame:
    feed = feeds.catalogue
    return feed.select("song_id", "duration", F.col("year").isNotNull().alias("is_dated"))
