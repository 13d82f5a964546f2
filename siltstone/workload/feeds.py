"""The given tables shaped as the feeds and silver tables the builders read."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans import silver
from siltstone.sources import SIDE_COMPRESSION, clustered, create_table, stamp_interval
from siltstone.workload.scratch import new_namespace

# One batch label for feeds that are loaded whole.
BATCH = "2024-01-31"

PLAY_LENGTH = "p_retailprice + (l_linenumber - 4) * 0.004D"

PLAY_LOG_COLUMNS = (
    "if(o_orderstatus = 'P', '', string(o_custkey)) AS user_id",
    "l_orderkey AS session_id",
    "l_linenumber AS item_in_session",
    "unix_millis(timestamp(l_shipdate)) + l_linenumber * 60000 AS ts",
    """CASE WHEN l_returnflag <> 'N' THEN 'NextSong' WHEN l_linenumber = 2 THEN 'Submit Upgrade'
       WHEN l_linenumber = 3 THEN 'Submit Downgrade' ELSE 'Home' END AS page""",
    "if(o_orderstatus = 'P' OR o_custkey % 11 = 0, 'Logged Out', 'Logged In') AS auth",
    "if(l_discount >= 0.05D, 'paid', 'free') AS level",
    "p_name AS song",
    "p_brand AS artist",
    f"{PLAY_LENGTH} AS length",
    "concat('Supplier ', l_suppkey) AS location",
    "l_linestatus AS user_agent",
    "c_name AS first_name",
    "c_mktsegment AS last_name",
    "if(c_acctbal > 0, 'F', 'M') AS gender",
    "o_custkey * 86400000 + 1672531200001 AS registration",
    "date_format(l_shipdate, 'yyyy-MM') AS data_interval",
)

USER_LOG_COLUMNS = (
    "if(event_type = 'signup', '', string(user_id)) AS user_id",
    "unix_millis(timestamp(ts)) AS ts",
    """CASE event_type WHEN 'purchase' THEN 'Submit Upgrade' WHEN 'error' THEN 'Submit Downgrade'
       ELSE 'NextSong' END AS page""",
    "if(event_type = 'view', 'Logged Out', 'Logged In') AS auth",
    "if(value > 10, 'paid', 'free') AS level",
    "concat('F', event_id) AS first_name",
    "concat('L', user_id) AS last_name",
    "if(value > 5, 'F', 'M') AS gender",
    "props AS location",
    "user_id * 86400000 + 1672531200001 AS registration",
    "date_format(ts, 'yyyy-MM-dd') AS data_interval",
)

EDITION_COLUMNS = (
    "*",
    "explode(array('studio', 'reissue', 'extended', 'live')) AS edition",
    "bigint(CASE WHEN p_size > 40 THEN 0 WHEN p_size > 3 THEN p_size + 1950 END) AS made",
    "CASE WHEN p_size <= 30 THEN double(p_size) END AS point",
)

CATALOGUE_COLUMNS = (
    "concat(if(edition = 'live', 'L', 'S'), p_partkey) AS song_id",
    "p_name AS title",
    "if(edition = 'live', concat(p_brand, ' Live'), p_brand) AS artist_id",
    """CASE edition WHEN 'live' THEN concat(p_brand, ' Live') WHEN 'reissue' THEN upper(p_brand)
       ELSE p_brand END AS artist_name""",
    """CASE edition WHEN 'extended' THEN round(p_retailprice + 50.0D, 1)
       WHEN 'live' THEN round(p_retailprice + 80.0D, 1) ELSE p_retailprice END AS duration""",
    """CASE edition WHEN 'extended' THEN NULL WHEN 'reissue' THEN made + 10 ELSE made END AS year""",
    "CASE WHEN edition <> 'reissue' THEN if(p_type = 'SMALL', '', p_type) END AS artist_location",
    "CASE WHEN edition <> 'extended' THEN point END AS artist_latitude",
    "CASE WHEN edition = 'studio' THEN -point END AS artist_longitude",
    f"'{BATCH}' AS data_interval",
)


def millis(stamp: str) -> Column:
    return F.unix_millis(F.col(stamp).cast("timestamp"))


class Feeds:
    """The feeds over one table folder; what several steps of a query read is built once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def scratch(self) -> tuple[str, str]:
        return new_namespace(self.spark)

    @cached_property
    def play_logs(self) -> DataFrame:
        """Listening log: one row per order line, monthly intervals, with attributes of the customer.

        Pending orders are guests; every eleventh customer plays, but is never signed in. Orders meet their
        customers first, so that order lines, the most rows, are shuffled for their part and their order only.
        """
        orders = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .selectExpr(*PLAY_LOG_COLUMNS)
        )

    @cached_property
    def user_logs(self) -> DataFrame:
        """User log: one row per event, daily intervals; sign-ups have no id yet."""
        return self.table("events").selectExpr(*USER_LOG_COLUMNS)

    @cached_property
    def catalogue(self) -> DataFrame:
        """Song feed: four rows per part.

        ``studio`` and ``reissue`` are one version of a song with different metadata, ``extended``
        is a longer version of it, and ``live`` is another song by another artist, which no play
        names.
        """
        return self.table("part").selectExpr(*EDITION_COLUMNS).selectExpr(*CATALOGUE_COLUMNS)

    @cached_property
    def play_batch(self) -> DataFrame:
        """The whole listening log as one batch."""
        return stamp_interval(self.play_logs, BATCH)

    @cached_property
    def play_log_table(self) -> DataFrame:
        """The whole listening log as a table, for queries that read it more than twice."""
        namespace, _ = self.scratch()
        create_table(self.play_batch, f"{namespace}.play_log", (), SIDE_COMPRESSION)
        return self.spark.table(f"{namespace}.play_log")

    @cached_property
    def user_log_table(self) -> DataFrame:
        """The user log as a table partitioned by interval."""
        namespace, _ = self.scratch()
        create_table(clustered(self.user_logs, ["data_interval"]), f"{namespace}.user_log", ["data_interval"])
        return self.spark.table(f"{namespace}.user_log")

    @cached_property
    def users(self) -> DataFrame:
        return silver.users(self.play_batch, BATCH)

    @cached_property
    def user_levels(self) -> DataFrame:
        return silver.user_levels(self.play_batch, BATCH)

    @cached_property
    def artists(self) -> DataFrame:
        return silver.artists(self.catalogue, BATCH)

    @cached_property
    def songs(self) -> DataFrame:
        return silver.songs(self.catalogue, BATCH)

    @cached_property
    def song_versions(self) -> DataFrame:
        return silver.song_versions(self.catalogue, BATCH)

    @cached_property
    def plays(self) -> DataFrame:
        return silver.plays(self.play_batch, BATCH)

    @cached_property
    def events(self) -> DataFrame:
        return silver.resolve_events(
            self.play_batch, self.users, self.songs, self.artists, self.song_versions, BATCH
        )

    @cached_property
    def event_table(self) -> DataFrame:
        """The resolved plays as a table, for queries that read them more than once; without ids of their own.

        The users are a table before. Of the log, each of the two writes takes its own columns and rows, which
        is less than the log as a table, and none plans the joins of the log twice.
        """
        namespace, _ = self.scratch()
        create_table(self.users, f"{namespace}.users", (), SIDE_COMPRESSION)
        events = silver.resolve_events(
            self.play_batch, self.spark.table(f"{namespace}.users"), self.songs, self.artists, self.song_versions, BATCH
        )
        create_table(events.drop("event_id"), f"{namespace}.events", (), SIDE_COMPRESSION)
        return self.spark.table(f"{namespace}.events")
