"""Event cleaning: coordinates, clock, running score, margin, assist, clutch flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import events as E
from .game_order import GameProfile, by_game_size
from .game_scan import SCORES, per_game_scores, split_scan


def clean_columns(events: DataFrame, strict_assist: bool = False) -> DataFrame:
    """The row-wise part of cleaning, one projection."""
    return events.withColumns(
        {
            "x": E.shot_coordinate(F.col("x")),
            "y": E.shot_coordinate(F.col("y")),
            "seconds_remaining": E.clock_seconds(F.col("clock")),
            "assister": E.assisting_player(F.col("desc"), strict_assist),
        }
    )


def with_margin(events: DataFrame) -> DataFrame:
    """No score yet counts as 0; margin is home minus away; then the clutch flag."""
    home, away = (F.coalesce(F.col(f"{c}_ff"), F.lit(0.0)) for c in SCORES)
    return events.withColumns(
        {"h_pts_ff": home, "a_pts_ff": away, "score_margin": home - away}
    ).withColumn("is_clutch", E.clutch_flag())


def running_scores(events: DataFrame, profile: GameProfile) -> DataFrame:
    return by_game_size(
        events, profile, per_game_scores, lambda rows: split_scan(rows, scores=True)
    )


def clean_events(
    events: DataFrame, profile: GameProfile, strict_assist: bool = False
) -> DataFrame:
    """Raw events (16 columns and event_seq) -> cleaned events.

    ``profile`` comes from ``profile_games``.
    """
    return with_margin(running_scores(clean_columns(events, strict_assist), profile))
