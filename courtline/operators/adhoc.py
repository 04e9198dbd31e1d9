"""Ad-hoc reports: previews, top-k lists and regular-time (non-clutch) variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import ratios as R
from ..functions.predicates import clutch_rows, seasons
from . import serving


def preview(fact: DataFrame, rows: int = 100) -> DataFrame:
    """Any ``rows`` rows of a fact table, in no particular order."""
    return fact.limit(rows)


def top_team_seasons(team_metrics: DataFrame, rows: int = 100) -> DataFrame:
    """Latest seasons first, most possessions first; the rest of the order only breaks ties."""
    ties = ["is_clutch", "points_scored", "def_possessions", "points_allowed", "total_fga"]
    order = [F.desc("season"), F.desc("total_possessions"), F.asc_nulls_last("team")]
    return team_metrics.orderBy(*order, *ties).limit(rows)


def top_player_seasons(player_metrics: DataFrame, rows: int = 100) -> DataFrame:
    order = [F.desc("season"), F.desc("pts"), F.col("player"), F.col("is_clutch")]
    return player_metrics.orderBy(*order).limit(rows)


def player_true_shooting(
    player_metrics: DataFrame, name_pattern: str = "%L. James%", rows: int = 10
) -> DataFrame:
    """True shooting per row for names like a pattern; NULL where there was no attempt."""
    attempts = F.col("fga") + F.lit(S.FREE_THROW_WEIGHT) * F.col("fta")
    share = F.try_divide(F.col("pts").cast("double"), F.lit(2.0) * attempts)
    regular = clutch_rows(player_metrics, "exclude").filter(F.col("player").like(name_pattern))
    return (
        regular.select("player", "season", "pts", "fga", "fta", F.round(share, 3).alias("true_shooting_pct"))
        .orderBy(F.desc("season"), "player")
        .limit(rows)
    )


def team_ratings_latest(team_metrics: DataFrame, team: str, rows: int = 10) -> DataFrame:
    """Rating and pace of one team's latest seasons."""
    possessions = F.col("total_possessions")
    rating = F.try_divide(F.col("points_scored") * F.lit(100.0), possessions.cast("double"))
    pace = F.try_divide(possessions * F.lit(48.0), F.col("games_played") * F.lit(48.0))
    return (
        clutch_rows(team_metrics, "exclude")
        .filter(F.col("team") == F.lit(team))
        .select(
            "season",
            "team",
            "total_possessions",
            "points_scored",
            F.round(rating, 1).alias("offensive_rating"),
            F.round(pace, 1).alias("pace"),
        )
        .orderBy(F.desc("season"))
        .limit(rows)
    )


def league_three_point_era(team_metrics: DataFrame) -> DataFrame:
    """Share of three-point shots in all shots of the league, per season."""
    threes, shots = F.sum("three_pt_attempts"), F.sum("total_fga")
    share = F.try_divide(threes * F.lit(100.0), shots.cast("double"))
    return (
        clutch_rows(team_metrics, "exclude")
        .groupBy("season")
        .agg(
            threes.alias("total_3pt_attempts"),
            F.sum("midrange_attempts").alias("total_midrange_attempts"),
            F.round(share, 1).alias("three_pt_pct_of_offense"),
        )
        .orderBy(F.desc("season"))
    )


def team_evolution_regular(
    team_metrics: DataFrame, team: str, start: int = 2015, end: int = 2024
) -> DataFrame:
    full = serving.team_evolution(team_metrics, start, end, "exclude", team)
    return full.drop("rim_rate")


def player_stats_regular(
    player_metrics: DataFrame, player: str, start: int = 2015, end: int = 2024
) -> DataFrame:
    return serving.player_stats(player_metrics, player, start, end, "exclude")


def shot_points_limited(
    shots: DataFrame, season: int, team: str, rows: int = 5000
) -> DataFrame:
    """Up to ``rows`` regular-time shots of a team's season, in no particular order."""
    regular = clutch_rows(shots, "exclude")
    return serving.team_shot_points(regular, team, season, season).limit(rows)


def player_shot_profile_regular(
    shots: DataFrame, player: str, start: int = 2015, end: int = 2024
) -> DataFrame:
    return serving.player_shot_profile(clutch_rows(shots, "exclude"), player, start, end)


def league_baseline(team_metrics: DataFrame, start: int = 2015, end: int = 2024) -> DataFrame:
    rows = clutch_rows(seasons(team_metrics, start, end), "exclude")
    return rows.groupBy("season").agg(*R.rates(R.TEAM_RATES, "pace", "ORtg")).orderBy("season")
