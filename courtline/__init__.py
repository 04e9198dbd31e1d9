"""Basketball play-by-play analytics on PySpark."""

from .operators.clean import clean_events
from .operators.game_order import GameProfile, profile_games
from .operators.player import build_fact_player_metrics
from .operators.possessions import (
    build_fact_possessions,
    possessions_with_season,
    reconstruct_possessions,
)
from .operators.shots import build_fact_shots, classify_shots
from .operators.team import build_fact_team_metrics
from .plans.pages import player_page, team_page
from .plans.pipeline import fact_frames, run_pipeline
from .session import create_spark_session
from .sources.event_files import get_raw_schema, ingest_data
from .sources.fact_store import FactStore

__all__ = [
    "FactStore",
    "GameProfile",
    "build_fact_player_metrics",
    "build_fact_possessions",
    "build_fact_shots",
    "build_fact_team_metrics",
    "classify_shots",
    "clean_events",
    "create_spark_session",
    "fact_frames",
    "get_raw_schema",
    "ingest_data",
    "player_page",
    "possessions_with_season",
    "profile_games",
    "reconstruct_possessions",
    "run_pipeline",
    "team_page",
]
