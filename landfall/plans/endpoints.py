"""Configuration: which endpoint gives which tables, and how those are keyed."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Endpoint:
    """``prefix`` of its table names; for a parameterised endpoint the injected
    column that holds the parent id, and the table and column the ids are in."""

    path: str
    prefix: str = ""
    parent_column: str | None = None
    parent_table: str | None = None
    parent_key: str = "id"


# The endpoints, in the order they are ingested.
ENDPOINTS = (
    Endpoint("bootstrap-static"),
    Endpoint("event-status"),
    Endpoint("fixtures"),
    Endpoint("team/set-piece-notes", prefix="team_set_piece_notes"),
    Endpoint("event/{id}/live", prefix="event_live", parent_column="event_id", parent_table="events"),
    Endpoint("dream-team/{id}", prefix="dream_team", parent_column="event_id", parent_table="events"),
    Endpoint("element-summary/{id}", prefix="element_summary", parent_column="element_id", parent_table="elements"),
)

# Keys of the tables without an id of their own.
TABLE_KEYS = {
    "game_settings": "singleton",
    "game_config": "singleton",
    "element_stats": ["name"],
    "status": ["event"],
    "dream_team_team": ["event_id", "element"],
    "element_summary_history": ["element", "fixture"],
    "element_summary_history_past": ["element_id", "season_name"],
}
