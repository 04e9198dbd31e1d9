"""Possession reconstruction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import events as E
from .game_order import GameProfile, by_game_size
from .game_scan import per_game_marks, split_scan


def with_action_team(events: DataFrame) -> DataFrame:
    return events.withColumn("action_team", E.action_team())


def mark_possessions(events: DataFrame, profile: GameProfile) -> DataFrame:
    """Add holder, previous holder and period, boundary flag and possession number."""
    return by_game_size(events, profile, per_game_marks, lambda rows: split_scan(rows, marks=True))


def possession_id() -> Column:
    """``<gameid>_<n>``; a NULL gameid leaves the bare number."""
    return F.concat_ws("_", F.col("gameid"), F.col("possession_id_game").cast("string"))


def reconstruct_possessions(
    cleaned: DataFrame, profile: GameProfile, three_point_rule: str = "points"
) -> DataFrame:
    """Cleaned events -> the same rows with possession marks, id and points per event."""
    # Row-wise columns first: the free text is then read below the shuffle.
    scored = with_action_team(
        cleaned.withColumn("points_scored_event", E.event_points(three_point_rule))
    )
    return mark_possessions(scored, profile).withColumn("possession_id", possession_id())


def build_fact_possessions(events: DataFrame, season: Column | None = None) -> DataFrame:
    """One row per possession, one aggregate.

    A possession number has one game and one holder, so the turnover flag needs no aggregate and
    join of its own. gameid among the keys keeps the aggregate on the partitioning of the windows.
    ``season`` adds an aggregate column of that name.
    """
    seconds = F.col("seconds_remaining")
    extra = [] if season is None else [season.alias("season")]
    grouped = events.groupBy(
        "gameid", "possession_id_game", F.col("possession_team").alias("team")
    ).agg(
        (F.max(seconds) - F.min(seconds)).alias("possession_length"),
        F.sum("points_scored_event").alias("points_scored"),
        F.max("is_clutch").alias("is_clutch"),
        F.max(F.when(F.col("type") == S.TURNOVER, 1).otherwise(0)).alias("turnover"),
        *extra,
    )
    outcome = (
        F.when(F.col("points_scored") > 0, "Score")
        .when(F.col("turnover") == 1, "Turnover")
        .otherwise("Miss/Other")
    )
    columns = S.FACT_SCHEMAS["fact_possessions"].fieldNames()
    return grouped.withColumns(
        {"possession_id": possession_id(), "possession_result": outcome}
    ).select(*(c for c in columns if c != "season" or extra))


def game_season_dim(events: DataFrame) -> DataFrame:
    return events.select("gameid", "season").distinct()


def possessions_with_season(possessions: DataFrame, game_seasons: DataFrame) -> DataFrame:
    """Left join on gameid: NULL gameid finds no season, a game under two seasons counts in both."""
    return possessions.join(game_seasons, "gameid", "left").select(
        *S.FACT_SCHEMAS["fact_possessions"].fieldNames()
    )


def season_of_possession() -> Column:
    """Aggregate that replaces the join where every game has one season (see GameProfile)."""
    return F.max(F.when(F.col("gameid").isNotNull(), F.col("season")))
