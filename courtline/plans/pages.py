"""All frames of a dashboard page for one choice of filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from .. import schema as S
from ..operators import reshape, serving
from ..sources.fact_store import FactStore


def team_page(
    store: FactStore,
    start: int,
    end: int,
    clutch: bool = False,
    teams: Iterable[str] | str | None = None,
    clutch_minutes: float = S.CLUTCH_MINUTES,
    clutch_margin: float = S.CLUTCH_MARGIN,
    result: str = "All",
) -> dict[str, DataFrame]:
    """Lazy frames of the team page. Without a choice of teams the league stands in; tables that
    were never written are empty."""
    metrics, shots = store.read_or_empty("fact_team_metrics"), store.read_or_empty("fact_shots")
    league = serving.league_evolution(metrics, start, end, clutch, ordered=False)
    per_team = serving.team_evolution(metrics, start, end, clutch, teams, ordered=False)
    pooled = league
    if teams:
        pooled = serving.league_evolution(metrics, start, end, clutch, teams, ordered=False)
    points = serving.team_shot_points(
        shots, teams, start, end, clutch, clutch_minutes, clutch_margin
    )
    averages = reshape.team_averages(per_team)
    return {
        "shot_distribution": reshape.shot_distribution_long(pooled),
        "pace": reshape.pace_series(league, per_team if teams else None),
        "shot_chart": reshape.shot_chart(points, result),
        "radar": reshape.offensive_radar(
            per_team if teams else reshape.league_average_label(league)
        ),
        "ratings": reshape.ratings_scatter(averages),
        "efficiency_table": reshape.efficiency_table(averages),
    }


def player_page(
    store: FactStore,
    player: str,
    start: int,
    end: int,
    clutch: bool = False,
    clutch_minutes: float = S.CLUTCH_MINUTES,
    clutch_margin: float = S.CLUTCH_MARGIN,
    result: str = "All",
) -> dict[str, DataFrame]:
    """Lazy frames of the player page."""
    metrics, shots = store.read_or_empty("fact_player_metrics"), store.read_or_empty("fact_shots")
    mine = serving.player_stats(metrics, player, start, end, clutch, ordered=False)
    league = serving.league_player_stats(metrics, start, end, clutch, ordered=False)
    window = (clutch, clutch_minutes, clutch_margin)
    profile = serving.player_shot_profile(shots, player, start, end, *window, ordered=False)
    points = serving.player_shot_points(shots, player, start, end, *window)
    return {
        "efficiency": reshape.efficiency_compare(reshape.latest_efficiency(mine, league)),
        "shot_profile": reshape.shot_profile_long(profile),
        "career": reshape.career_efficiency(mine, league),
        "shot_chart": reshape.shot_chart(points, result),
    }
