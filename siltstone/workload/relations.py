"""Projections, predicates, joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import (
    distance,
    is_positive,
    is_required,
    version_key,
)
from siltstone.operators import (
    join_pairs,
    keep_known,
    lookup,
    membership,
    tolerance_join,
    top_row,
    union_tagged,
    zero_fill_join,
)
from siltstone.plans import silver
from siltstone.plans.values import DOWNGRADE_PAGE, DURATION_TOLERANCE, UPGRADE_PAGE
from siltstone.workload.feeds import PLAY_LENGTH, Feeds
from siltstone.workload.registry import query
from siltstone.workload.sql import with_tables


@query(
    "project_rename",
    "SELECT c_custkey AS user_id, c_name AS full_name, c_mktsegment AS segment FROM customer",
)
def project_rename(feeds: Feeds) -> DataFrame:
    return feeds.table("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("segment"),
    )


@query(
    "filter_required",
    with_tables(
        """
        SELECT song_id, artist_id, artist_location FROM catalogue
        WHERE artist_location IS NOT NULL AND artist_location <> ''
        """,
        "catalogue",
    ),
)
def filter_required(feeds: Feeds) -> DataFrame:
    rows = feeds.catalogue.select("song_id", "artist_id", "artist_location")
    return rows.where(is_required("artist_location"))


@query("filter_category", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_category(feeds: Feeds) -> DataFrame:
    orders = feeds.table("orders").where(F.col("o_orderstatus") == "F")
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "filter_in_list",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('purchase', 'error')",
)
def filter_in_list(feeds: Feeds) -> DataFrame:
    events = feeds.table("events").select("event_id", "user_id", "event_type")
    return events.where(F.col("event_type").isin("purchase", "error"))


@query(
    "filter_positive",
    """
    SELECT c_custkey, c_acctbal, c_custkey % 7 <> 0 AS positive_text
    FROM customer WHERE c_acctbal > 0
    """,
)
def filter_positive(feeds: Feeds) -> DataFrame:
    """On numbers, and on text of which some is no number."""
    customers = feeds.table("customer").select("c_custkey", "c_acctbal").where(is_positive("c_acctbal"))
    text = F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    return customers.withColumn("positive_text", F.coalesce(is_positive(text), F.lit(False)))


@query(
    "filter_not_null",
    with_tables("SELECT song_id, duration, year FROM catalogue WHERE year IS NOT NULL", "catalogue"),
)
def filter_not_null(feeds: Feeds) -> DataFrame:
    rows = feeds.catalogue.select("song_id", "duration", "year")
    return rows.where(F.col("year").isNotNull())


@query("filter_plays", with_tables("SELECT * FROM plays", "plays"))
def filter_plays(feeds: Feeds) -> DataFrame:
    return feeds.plays


@query(
    "semi_known_users",
    with_tables(
        """
        SELECT play_key, user_id, session_id, played_title FROM plays
        WHERE user_id IN (SELECT user_id FROM users)
        """,
        "plays",
        "users",
    ),
)
def semi_known_users(feeds: Feeds) -> DataFrame:
    plays = feeds.plays.select("play_key", "user_id", "session_id", "played_title")
    return keep_known(plays, feeds.users, ["user_id"])


@query(
    "join_title",
    with_tables(
        """
        SELECT song_id, played_title, title_plays
        FROM (SELECT played_title, count(*) AS title_plays FROM plays GROUP BY played_title)
        JOIN songs ON title = played_title
        """,
        "plays",
        "songs",
    ),
)
def join_title(feeds: Feeds) -> DataFrame:
    """Songs that a played title may mean. Plays are counted per title first, so the result grows
    with the catalogue and not with plays times songs of one name."""
    titles = feeds.plays.groupBy("played_title").agg(F.count("*").alias("title_plays"))
    songs = feeds.songs.select("song_id", "title")
    return join_pairs(titles, songs, {"played_title": "title"}).drop("title")


@query(
    "join_composite_key",
    with_tables(
        """
        SELECT c.song_id, c.duration, a.artist_id, a.artist_name, a.latitude
        FROM catalogue c
        JOIN artists a ON a.artist_id = c.artist_id AND a.artist_name = c.artist_name
        """,
        "catalogue",
        "artists",
    ),
)
def join_composite_key(feeds: Feeds) -> DataFrame:
    """Catalogue rows that credit the artist by the chosen name."""
    credits = feeds.catalogue.select(
        "song_id",
        "duration",
        F.col("artist_id").alias("credited_id"),
        F.col("artist_name").alias("credited_name"),
    )
    artists = feeds.artists.select("artist_id", "artist_name", "latitude")
    pairs = {"credited_id": "artist_id", "credited_name": "artist_name"}
    return join_pairs(credits, artists, pairs).drop(*pairs)


def _line_lengths(feeds: Feeds) -> DataFrame:
    """Each order line as a play of its part's song."""
    lines = feeds.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = feeds.table("part").select("p_partkey", "p_retailprice")
    return join_pairs(lines, parts, {"l_partkey": "p_partkey"}).select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_linenumber").alias("item_in_session"),
        F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("played_song"),
        F.expr(PLAY_LENGTH).alias("length"),
    )


_LINE_LENGTHS = """
    SELECT l_orderkey AS session_id, l_linenumber AS item_in_session,
           'S' || CAST(l_partkey AS VARCHAR) AS played_song,
           p_retailprice + (l_linenumber - 4) * CAST(0.004 AS DOUBLE) AS length
    FROM lineitem JOIN part ON p_partkey = l_partkey"""


@query(
    "tolerance_join",
    with_tables(
        """
        SELECT session_id, item_in_session, length, song_id, duration, version_id
        FROM lengths JOIN song_versions ON song_id = played_song AND abs(duration - length) < 0.01
        """,
        "song_versions",
        lengths=_LINE_LENGTHS,
    ),
)
def tolerance_join_lengths(feeds: Feeds) -> DataFrame:
    return tolerance_join(
        _line_lengths(feeds),
        feeds.song_versions,
        {"played_song": "song_id"},
        "length",
        "duration",
        DURATION_TOLERANCE,
    ).drop("played_song")


@query(
    "left_join_zero_fill",
    with_tables(
        """
        SELECT song_id, title, coalesce(plays, 0) AS plays,
               coalesce(round(longest, 3), 0.0) AS longest, first_session
        FROM songs LEFT JOIN (
            SELECT played_song, count(*) AS plays, max(length) AS longest, min(session_id) AS first_session
            FROM lengths GROUP BY played_song) ON played_song = song_id
        """,
        "songs",
        lengths=_LINE_LENGTHS,
    ),
)
def left_join_zero_fill(feeds: Feeds) -> DataFrame:
    """Every song; the live ones are never played."""
    measures = (
        _line_lengths(feeds)
        .groupBy(F.col("played_song").alias("song_id"))
        .agg(
            F.count("*").alias("plays"),
            F.round(F.max("length"), 3).alias("longest"),
            F.min("session_id").alias("first_session"),
        )
    )
    songs = feeds.songs.select("song_id", "title")
    return zero_fill_join(songs, measures, ["song_id"], {"plays": 0, "longest": 0.0})


@query(
    "left_join_lookup",
    with_tables(
        """
        SELECT session_id, item_in_session, played_song, duration
        FROM lengths LEFT JOIN song_versions ON song_id = played_song AND duration = length
        """,
        "song_versions",
        lengths=_LINE_LENGTHS,
    ),
)
def left_join_lookup(feeds: Feeds) -> DataFrame:
    """The duration behind a version key; plays of an odd length have a key without version."""
    plays = _line_lengths(feeds).select(
        "session_id",
        "item_in_session",
        "played_song",
        version_key("played_song", "length").alias("version_id"),
    )
    versions = feeds.song_versions.select("version_id", "duration")
    return lookup(plays, versions, ["version_id"]).drop("version_id")


@query(
    "left_join_latest",
    with_tables(
        """
        SELECT c_custkey AS user_id, c_name, new_level AS current_level
        FROM customer LEFT JOIN (
            SELECT user_id, new_level FROM user_levels
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY changed_at DESC) = 1) l
          ON l.user_id = c_custkey
        """,
        "user_levels",
    ),
)
def left_join_latest(feeds: Feeds) -> DataFrame:
    latest = top_row(feeds.user_levels, ["user_id"], [F.desc("changed_at")])
    customers = feeds.table("customer").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    return lookup(customers, latest.select("user_id", F.col("new_level").alias("current_level")), ["user_id"])


@query(
    "membership_flag",
    """
    SELECT c_custkey AS user_id, c_mktsegment,
           c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS is_converted
    FROM customer
    """,
)
def membership_flag(feeds: Feeds) -> DataFrame:
    buyers = feeds.table("events").where(F.col("event_type") == "purchase")
    customers = feeds.table("customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment"
    )
    return membership(customers, buyers, ["user_id"], "is_converted")


@query(
    "using_join",
    with_tables(
        """
        SELECT user_id, data_interval, seen, upgrades
        FROM (SELECT user_id, data_interval, count(*) AS seen FROM user_logs GROUP BY ALL)
        LEFT JOIN (SELECT user_id, data_interval, count(*) AS upgrades FROM user_logs
                   WHERE page = 'Submit Upgrade' GROUP BY ALL) USING (user_id, data_interval)
        """,
        "user_logs",
    ),
)
def using_join(feeds: Feeds) -> DataFrame:
    keys = ["user_id", "data_interval"]
    logs = feeds.user_logs.select(*keys, "page")
    seen = logs.groupBy(*keys).agg(F.count("*").alias("seen"))
    upgrades = (
        logs.where(F.col("page") == UPGRADE_PAGE).groupBy(*keys).agg(F.count("*").alias("upgrades"))
    )
    return lookup(seen, upgrades, keys)


@query(
    "star_resolution",
    with_tables(
        """
        SELECT play_key, user_id, song_id, artist_id, version_id FROM resolved
        WHERE user_id IN (SELECT c_custkey FROM customer)
        QUALIFY row_number() OVER (
            PARTITION BY play_key ORDER BY gap, artist_id, song_id, user_id, version_id) = 1
        """,
        "resolved",
    ),
)
def star_resolution(feeds: Feeds) -> DataFrame:
    """Plays of all customers, each with the nearest of its candidate versions."""
    customers = feeds.table("customer").select(F.col("c_custkey").alias("user_id"))
    candidates = silver.candidate_versions(
        keep_known(feeds.plays, customers, ["user_id"]),
        feeds.songs,
        feeds.artists,
        feeds.song_versions,
    ).select(
        "play_key",
        "user_id",
        "song_id",
        "artist_id",
        "version_id",
        distance("duration", "length").alias("gap"),
    )
    return top_row(candidates, ["play_key"], ["gap"]).drop("gap")


@query(
    "union_tagged",
    with_tables(
        """
        SELECT user_id, ts, 'up' AS source FROM user_logs WHERE page = 'Submit Upgrade'
        UNION ALL
        SELECT user_id, ts, 'down' AS source FROM user_logs WHERE page = 'Submit Downgrade'
        """,
        "user_logs",
    ),
)
def union_of_changes(feeds: Feeds) -> DataFrame:
    logs = feeds.user_logs
    parts = {
        name: logs.where(F.col("page") == page).select("user_id", "ts")
        for name, page in {"up": UPGRADE_PAGE, "down": DOWNGRADE_PAGE}.items()
    }
    return union_tagged(parts)
