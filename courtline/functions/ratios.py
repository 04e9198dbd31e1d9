"""Ratios over raw counts, each written once.

Every function returns an aggregate Column for use inside ``groupBy(...).agg``: counts are summed
first and divided afterwards, so a ratio stays right for any grouping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def total(name: str) -> Column:
    return F.sum(name).cast("double")


def guarded(numerator: Column, denominator: Column, scale: float | None = None) -> Column:
    """numerator / denominator (x scale), 0 unless the denominator is positive."""
    ratio = F.try_divide(numerator, denominator)
    if scale is not None:
        ratio = ratio * F.lit(scale)
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def pace() -> Column:
    """Possessions over the largest game count of the group; NULL when that count is 0."""
    return F.try_divide(total("total_possessions"), F.max("games_played").cast("double"))


def offensive_rating() -> Column:
    return guarded(total("points_scored"), total("total_possessions"), 100.0)


def defensive_rating() -> Column:
    return guarded(total("points_allowed"), total("def_possessions"), 100.0)


def attempt_share(attempts: str) -> Column:
    return guarded(total(attempts), total("total_fga"))


def true_shooting() -> Column:
    shots = total("fga") + F.lit(S.FREE_THROW_WEIGHT) * total("fta")
    return F.when(shots > 0, F.try_divide(total("pts"), F.lit(2.0) * shots)).otherwise(F.lit(0.0))


def effective_field_goal() -> Column:
    return guarded(total("fgm") + F.lit(S.THREE_BONUS) * total("fg3m"), total("fga"))


def three_point_accuracy() -> Column:
    return guarded(total("fg3m"), total("fg3a"))


def zone_share(*zones: str) -> Column:
    """Share of the group's rows whose shot_zone is one of ``zones``."""
    hits = F.count_if(F.col("shot_zone").isin(*zones)).cast("double")
    return F.try_divide(hits, F.count(F.lit(1)).cast("double"))


TEAM_RATES = {
    "pace": pace,
    "ORtg": offensive_rating,
    "DRtg": defensive_rating,
    "three_point_rate": lambda: attempt_share("three_pt_attempts"),
    "rim_rate": lambda: attempt_share("rim_attempts"),
    "midrange_rate": lambda: attempt_share("midrange_attempts"),
}

PLAYER_RATES = {
    "TS_pct": true_shooting,
    "eFG_pct": effective_field_goal,
    "three_point_efficiency": three_point_accuracy,
}

ZONE_RATES = {
    "rim_rate": lambda: zone_share(S.RIM),
    "midrange_rate": lambda: zone_share(S.MIDRANGE),
    "three_point_rate": lambda: zone_share(*S.THREE_ZONES),
}


def rates(family: dict, *names: str) -> list[Column]:
    """Aliased aggregate columns of a family, all of them or the named ones."""
    return [family[n]().alias(n) for n in (names or family)]
