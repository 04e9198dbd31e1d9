"""Parametrised queries over the fact tables.

Each takes a fact frame and returns a lazy DataFrame. Season ranges are inclusive and reach the
scan as partition filters; other predicates are pushed to Parquet. Aggregates are partial before
their shuffle, so result size depends on seasons and teams, not on rows. ``ordered=False`` leaves
out the final sort when the result goes into another operator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import ratios as R
from ..functions.predicates import clutch_rows, clutch_window, of_teams, seasons

Teams = str | Iterable[str] | None


def _sorted(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def team_evolution(
    team_metrics: DataFrame,
    start: int,
    end: int,
    clutch: str | bool = "all",
    teams: Teams = None,
    ordered: bool = True,
) -> DataFrame:
    """Pace, ratings and shot shares per season and team."""
    rows = of_teams(clutch_rows(seasons(team_metrics, start, end), clutch), teams)
    per_team = rows.groupBy("season", "team").agg(*R.rates(R.TEAM_RATES))
    return _sorted(per_team, ordered, "season", F.asc_nulls_last("team"))


def league_evolution(
    team_metrics: DataFrame,
    start: int,
    end: int,
    clutch: str | bool = "all",
    teams: Teams = None,
    ordered: bool = True,
) -> DataFrame:
    """The same per season, over all teams or the chosen ones pooled (rows without team too)."""
    rows = of_teams(clutch_rows(seasons(team_metrics, start, end), clutch), teams)
    return _sorted(rows.groupBy("season").agg(*R.rates(R.TEAM_RATES)), ordered, "season")


def league_player_stats(
    player_metrics: DataFrame,
    start: int,
    end: int,
    clutch: str | bool = "all",
    ordered: bool = True,
) -> DataFrame:
    rows = clutch_rows(seasons(player_metrics, start, end), clutch)
    return _sorted(rows.groupBy("season").agg(*R.rates(R.PLAYER_RATES)), ordered, "season")


def player_stats(
    player_metrics: DataFrame,
    player: str,
    start: int,
    end: int,
    clutch: str | bool = "all",
    ordered: bool = True,
) -> DataFrame:
    """True shooting, effective field goal and three-point percentage per season."""
    mine = player_metrics.filter(F.col("player") == F.lit(player))
    return league_player_stats(mine, start, end, clutch, ordered)


def team_shot_points(
    shots: DataFrame,
    teams: Teams,
    start: int,
    end: int,
    clutch: bool = False,
    clutch_minutes: float = S.CLUTCH_MINUTES,
    clutch_margin: float = S.CLUTCH_MARGIN,
) -> DataFrame:
    """Raw shot points; the clutch window is chosen here, not read from is_clutch."""
    rows = of_teams(seasons(shots, start, end), teams)
    rows = clutch_window(rows, clutch, clutch_minutes, clutch_margin)
    return rows.select("x", "y", "made_flag", "shot_zone", "team")


def _of_shooter(shots, player, start, end, clutch, minutes, margin) -> DataFrame:
    rows = seasons(shots, start, end).filter(F.col("shooter") == F.lit(player))
    return clutch_window(rows, clutch, minutes, margin)


def player_shot_points(
    shots: DataFrame,
    player: str,
    start: int,
    end: int,
    clutch: bool = False,
    clutch_minutes: float = S.CLUTCH_MINUTES,
    clutch_margin: float = S.CLUTCH_MARGIN,
) -> DataFrame:
    rows = _of_shooter(shots, player, start, end, clutch, clutch_minutes, clutch_margin)
    return rows.select("x", "y", "made_flag", "shot_zone")


def player_shot_profile(
    shots: DataFrame,
    player: str,
    start: int,
    end: int,
    clutch: bool = False,
    clutch_minutes: float = S.CLUTCH_MINUTES,
    clutch_margin: float = S.CLUTCH_MARGIN,
    ordered: bool = True,
) -> DataFrame:
    """Shares of rim, midrange and three-point shots per season."""
    rows = _of_shooter(shots, player, start, end, clutch, clutch_minutes, clutch_margin)
    return _sorted(rows.groupBy("season").agg(*R.rates(R.ZONE_RATES)), ordered, "season")


def _names(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def all_teams(team_metrics: DataFrame) -> DataFrame:
    return _names(team_metrics, "team")


def all_players(player_metrics: DataFrame) -> DataFrame:
    return _names(player_metrics, "player")
