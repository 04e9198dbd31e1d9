"""Per-event Column expressions. All are JVM built-ins; none needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S

THREE_POINT_RULES = {
    # Made shots: how the possession total spots a three-pointer in the description.
    # "points" is the historical default and reads the player's running total, so it also
    # matches "(13 PTS)"; "3PT" reads the shot label.
    "points": "%3 PTS%",
    "3PT": "%3PT%",
}


def is_attempt(event_type: Column | None = None) -> Column:
    return _type(event_type).isin(*S.FIELD_GOALS)


def is_made(event_type: Column | None = None) -> Column:
    return _type(event_type) == S.MADE


def _type(event_type: Column | None) -> Column:
    return F.col("type") if event_type is None else event_type


def shot_coordinate(value: Column) -> Column:
    """Keep a coordinate on field-goal attempts only."""
    return F.when(is_attempt(), value)


def clock_seconds(clock: Column) -> Column:
    """``PT11M40.00S`` -> 700.0; NULL when either part is missing or malformed."""
    minutes = F.regexp_extract(clock, r"PT(\d+)M", 1).try_cast("int")
    seconds = F.regexp_extract(clock, r"M(\d+\.\d+)S", 1).try_cast("double")
    return minutes * F.lit(60.0) + seconds


def assisting_player(desc: Column, strict: bool = False) -> Column:
    """Name in front of ``<n> AST)``, '' when there is none.

    The default pattern starts at the first bracket of the text, so a points bracket in front of
    the assist bracket is swallowed too; ``strict`` stays inside the assist bracket.
    """
    pattern = r"\(([^()]*?)\s+\d+\s+AST\)" if strict else r"\((.*?)\s+\d+\s+AST\)"
    return F.regexp_extract(desc, pattern, 1)


def in_clutch_window(minutes: float = S.CLUTCH_MINUTES, margin: float = S.CLUTCH_MARGIN) -> Column:
    """Late and close: predicate over period, seconds_remaining and score_margin (NULL-able)."""
    return (
        (F.col("period") >= S.CLUTCH_FIRST_PERIOD)
        & (F.col("seconds_remaining") <= F.lit(float(minutes * 60)))
        & F.col("score_margin").between(F.lit(-float(margin)), F.lit(float(margin)))
    )


def clutch_flag() -> Column:
    return F.when(in_clutch_window(), 1).otherwise(0)


def says_three(desc: Column) -> Column:
    return F.coalesce(desc.like("%3PT%"), F.lit(False))


def shot_zone() -> Column:
    three = F.when(F.col("y") <= S.CORNER_MAX_Y, S.CORNER_3).otherwise(S.ABOVE_BREAK_3)
    two = F.when(F.col("dist") <= S.RIM_MAX_DIST, S.RIM).otherwise(S.MIDRANGE)
    return F.when(is_attempt(), F.when(says_three(F.col("desc")), three).otherwise(two))


def is_three() -> Column:
    """A classified shot is a three exactly when its zone is a three-point zone."""
    return F.col("shot_zone").isin(*S.THREE_ZONES)


def shot_value() -> Column:
    """Points of a made field goal by its zone; 0 on anything else."""
    return F.when(is_made(), F.when(is_three(), 3).otherwise(2)).otherwise(0)


def made_flag() -> Column:
    return F.when(is_attempt(), F.when(is_made(), 1).otherwise(0))


def free_throw_made() -> Column:
    return (F.col("type") == S.FREE_THROW) & F.col("desc").like("% PTS%")


def event_points(three_point_rule: str = "points") -> Column:
    """Points an event adds to its possession (see THREE_POINT_RULES)."""
    three = F.col("desc").like(THREE_POINT_RULES[three_point_rule])
    return (
        F.when(is_made(), F.when(three, 3).otherwise(2)).when(free_throw_made(), 1).otherwise(0)
    )


def action_team() -> Column:
    """Team of an on-ball event; NULL on neutral ones."""
    return F.when(F.col("type").isin(*S.ON_BALL), F.col("team"))
