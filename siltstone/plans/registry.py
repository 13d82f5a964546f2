"""Keys, partitioning and order of the silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SilverTable:
    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = field(default=())


# In promotion order: a table follows those it reads.
SILVER_TABLES = (
    SilverTable("users", ("user_id",)),
    SilverTable("artists", ("artist_id",)),
    SilverTable("songs", ("song_id",)),
    SilverTable("song_versions", ("version_id",)),
    SilverTable("user_levels", ("user_id", "changed_at")),
    SilverTable("events", ("event_id",), ("event_date",)),
)

GOLD_KEYS = {
    "artist_facts": ("artist_id",),
    "session_facts": ("session_id", "user_id"),
    "song_facts": ("song_id",),
    "user_facts": ("user_id",),
}
