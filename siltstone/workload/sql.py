"""SQL common table expressions for the feeds and the tables built from them."""

from __future__ import annotations

FEEDS = {
    "play_logs": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
               l_orderkey AS session_id,
               l_linenumber AS item_in_session,
               epoch_us(l_shipdate) // 1000 + l_linenumber * 60000 AS ts,
               CASE WHEN l_returnflag <> 'N' THEN 'NextSong'
                    WHEN l_linenumber = 2 THEN 'Submit Upgrade'
                    WHEN l_linenumber = 3 THEN 'Submit Downgrade' ELSE 'Home' END AS page,
               CASE WHEN o_orderstatus = 'P' OR o_custkey % 11 = 0 THEN 'Logged Out'
                    ELSE 'Logged In' END AS auth,
               CASE WHEN l_discount >= 0.05 THEN 'paid' ELSE 'free' END AS level,
               p_name AS song,
               p_brand AS artist,
               p_retailprice + (l_linenumber - 4) * CAST(0.004 AS DOUBLE) AS length,
               'Supplier ' || CAST(l_suppkey AS VARCHAR) AS location,
               l_linestatus AS user_agent,
               c_name AS first_name,
               c_mktsegment AS last_name,
               CASE WHEN c_acctbal > 0 THEN 'F' ELSE 'M' END AS gender,
               o_custkey * 86400000 + 1672531200001 AS registration,
               strftime(l_shipdate, '%Y-%m') AS data_interval
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN part ON p_partkey = l_partkey
        JOIN customer ON c_custkey = o_custkey""",
    "user_logs": """
        SELECT CASE WHEN event_type = 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
               epoch_us(ts) // 1000 AS ts,
               CASE event_type WHEN 'purchase' THEN 'Submit Upgrade'
                               WHEN 'error' THEN 'Submit Downgrade'
                               ELSE 'NextSong' END AS page,
               CASE WHEN event_type = 'view' THEN 'Logged Out' ELSE 'Logged In' END AS auth,
               CASE WHEN value > 10 THEN 'paid' ELSE 'free' END AS level,
               'F' || CAST(event_id AS VARCHAR) AS first_name,
               'L' || CAST(user_id AS VARCHAR) AS last_name,
               CASE WHEN value > 5 THEN 'F' ELSE 'M' END AS gender,
               props AS location,
               user_id * 86400000 + 1672531200001 AS registration,
               strftime(ts, '%Y-%m-%d') AS data_interval
        FROM events""",
    "editions": """
        SELECT *,
               p_brand || CASE WHEN edition = 'live' THEN ' Live' ELSE '' END AS artist,
               CAST(CASE WHEN p_size > 40 THEN 0 WHEN p_size > 3 THEN p_size + 1950 END AS BIGINT) AS made,
               CASE WHEN p_size <= 30 THEN CAST(p_size AS DOUBLE) END AS point
        FROM part CROSS JOIN (VALUES ('studio'), ('reissue'), ('extended'), ('live')) AS e(edition)""",
    "catalogue": """
        SELECT CASE WHEN edition = 'live' THEN 'L' ELSE 'S' END || CAST(p_partkey AS VARCHAR) AS song_id,
               p_name AS title,
               artist AS artist_id,
               CASE WHEN edition = 'reissue' THEN upper(artist) ELSE artist END AS artist_name,
               CASE edition WHEN 'extended' THEN round(p_retailprice + 50.0, 1)
                            WHEN 'live' THEN round(p_retailprice + 80.0, 1)
                            ELSE p_retailprice END AS duration,
               CASE edition WHEN 'extended' THEN NULL
                            WHEN 'reissue' THEN made + 10
                            ELSE made END AS year,
               CASE WHEN edition <> 'reissue'
                    THEN CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END END AS artist_location,
               CASE WHEN edition <> 'extended' THEN point END AS artist_latitude,
               CASE WHEN edition = 'studio' THEN -point END AS artist_longitude,
               '2024-01-31' AS data_interval
        FROM editions""",
}


def level_tables(interval: str | None, prefix: str = "") -> dict[str, str]:
    """Level changes, first levels and their union: of one day of the user log, or of the whole play log."""
    log = "user_logs" if interval else "play_logs"
    current = f"data_interval = '{interval}'" if interval else "TRUE"
    known = f"data_interval <= '{interval}'" if interval else "TRUE"
    return {
        f"{prefix}level_sources": f"""
        SELECT CAST(user_id AS BIGINT) AS user_id, ts,
               CASE page WHEN 'Submit Upgrade' THEN 'paid' ELSE 'free' END AS new_level,
               'transition' AS source
        FROM {log}
        WHERE user_id <> '' AND page IN ('Submit Upgrade', 'Submit Downgrade') AND {current}
        UNION ALL
        SELECT user_id, ts, new_level, 'initial' AS source
        FROM (SELECT DISTINCT ON (user_id) CAST(user_id AS BIGINT) AS user_id, ts, level AS new_level
              FROM {log}
              WHERE user_id <> '' AND auth = 'Logged In' AND level IS NOT NULL AND {known}
              ORDER BY user_id, ts, level)""",
        f"{prefix}user_levels": f"""
        SELECT DISTINCT ON (user_id, changed_at) user_id, changed_at, new_level, source
        FROM (SELECT *, make_timestamp(ts // 1000 * 1000000) AS changed_at FROM {prefix}level_sources)
        ORDER BY user_id, changed_at, source = 'transition' DESC, ts DESC, new_level""",
    }


TABLES = {
    **FEEDS,
    "users": """
        SELECT DISTINCT ON (CAST(user_id AS BIGINT))
               CAST(user_id AS BIGINT) AS user_id, first_name, last_name, gender, location,
               make_timestamp(registration // 1000 * 1000000) AS registration,
               make_timestamp(ts // 1000 * 1000000) AS last_seen_at
        FROM play_logs
        WHERE user_id <> '' AND auth = 'Logged In'
        ORDER BY CAST(user_id AS BIGINT), ts DESC, first_name, gender, last_name, location, registration""",
    "artists": """
        SELECT artist_id, artist_name, artist_location AS location,
               artist_latitude AS latitude, artist_longitude AS longitude
        FROM catalogue
        WHERE artist_id <> ''
        QUALIFY row_number() OVER (
            PARTITION BY artist_id
            ORDER BY coalesce(artist_location, '') = '', artist_latitude IS NULL,
                     artist_name, artist_latitude, artist_location NULLS FIRST,
                     artist_longitude NULLS FIRST) = 1""",
    "songs": """
        SELECT song_id, title, artist_id, nullif(year, 0) AS year
        FROM catalogue
        WHERE song_id <> '' AND artist_id <> '' AND title IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY song_id ORDER BY year DESC NULLS LAST, artist_id, title) = 1""",
    "song_versions": """
        SELECT sha256(song_id || ':' || CAST(duration AS VARCHAR)) AS version_id, song_id, duration
        FROM (SELECT DISTINCT song_id, duration FROM catalogue WHERE song_id <> '' AND duration > 0)""",
    **level_tables(None),
    "plays": """
        SELECT user_id || ':' || CAST(session_id AS VARCHAR) || ':'
                   || CAST(item_in_session AS VARCHAR) AS play_key,
               make_timestamp(ts // 1000 * 1000000) AS ts,
               CAST(user_id AS BIGINT) AS user_id,
               session_id,
               item_in_session,
               song AS played_title,
               artist AS played_artist,
               length,
               level,
               location,
               user_agent,
               strftime(make_timestamp(ts // 1000 * 1000000), '%Y-%m-%d') AS event_date
        FROM play_logs
        WHERE page = 'NextSong' AND user_id <> '' AND song IS NOT NULL AND artist IS NOT NULL
          AND length > 0""",
    "resolved": """
        SELECT p.*, v.version_id, s.song_id, s.artist_id, abs(v.duration - p.length) AS gap
        FROM plays p
        JOIN songs s ON s.title = p.played_title
        JOIN artists a ON a.artist_id = s.artist_id AND a.artist_name = p.played_artist
        JOIN song_versions v ON v.song_id = s.song_id AND abs(v.duration - p.length) < 0.01""",
    "play_events": """
        SELECT sha256(play_key) AS event_id, ts, user_id, session_id, item_in_session, version_id,
               song_id, artist_id, level, location, user_agent, event_date
        FROM resolved
        WHERE user_id IN (SELECT user_id FROM users)
        QUALIFY row_number() OVER (
            PARTITION BY play_key
            ORDER BY gap, artist_id, event_date, item_in_session, level, location, session_id,
                     song_id, ts, user_agent, user_id, version_id) = 1""",
}


def with_tables(body: str, *names: str, **more: str) -> str:
    """The query preceded by the named tables and all that those read, in dependency order."""
    order = list(TABLES)
    needs = {
        "editions": [],
        "catalogue": ["editions"],
        "users": ["play_logs"],
        "artists": ["catalogue"],
        "songs": ["catalogue"],
        "song_versions": ["catalogue"],
        "level_sources": ["play_logs"],
        "user_levels": ["level_sources"],
        "plays": ["play_logs"],
        "resolved": ["plays", "songs", "artists", "song_versions"],
        "play_events": ["resolved", "users"],
    }
    wanted: set[str] = set()
    waiting = list(names)
    while waiting:
        name = waiting.pop()
        wanted.add(name)
        waiting.extend(needs.get(name, ()))
    parts = [f"{n} AS ({TABLES[n]})" for n in order if n in wanted]
    parts += [f"{name} AS ({text})" for name, text in more.items()]
    return f"WITH {', '.join(parts)}\n{body.strip()}"
