"""Fixed schemas and domain constants of the play-by-play model."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(columns: dict[str, str]) -> T.StructType:
    """Nullable fields; no session is needed to build them, unlike with a DDL string."""
    fields = T.StructType()
    for name, kind in columns.items():
        fields.add(name, kind)
    return fields


# The 16 columns of the raw feed, in file order.
RAW_EVENTS = _struct(
    {
        "gameid": "string",
        "period": "integer",
        "clock": "string",
        "h_pts": "double",
        "a_pts": "double",
        "team": "string",
        "playerid": "string",
        "player": "string",
        "type": "string",
        "subtype": "string",
        "result": "string",
        "x": "double",
        "y": "double",
        "dist": "double",
        "desc": "string",
        "season": "integer",
    }
)

# The four fact tables. `season` is the partition column and comes last.
FACT_SCHEMAS = {
    "fact_shots": _struct(
        {
            "shooter": "string",
            "team": "string",
            "x": "double",
            "y": "double",
            "shot_zone": "string",
            "made_flag": "integer",
            "shot_value": "integer",
            "is_clutch": "integer",
            "period": "integer",
            "seconds_remaining": "double",
            "score_margin": "double",
            "season": "integer",
        }
    ),
    "fact_possessions": _struct(
        {
            "possession_id": "string",
            "gameid": "string",
            "team": "string",
            "possession_length": "double",
            "points_scored": "long",
            "is_clutch": "integer",
            "possession_result": "string",
            "season": "integer",
        }
    ),
    "fact_team_metrics": _struct(
        {
            "team": "string",
            "is_clutch": "integer",
            "games_played": "long",
            "total_possessions": "long",
            "points_scored": "long",
            "def_possessions": "long",
            "points_allowed": "long",
            "three_pt_attempts": "long",
            "rim_attempts": "long",
            "midrange_attempts": "long",
            "total_fga": "long",
            "season": "integer",
        }
    ),
    "fact_player_metrics": _struct(
        {
            "player": "string",
            "is_clutch": "integer",
            "pts": "long",
            "fga": "long",
            "fgm": "long",
            "fg3m": "long",
            "fg3a": "long",
            "fta": "long",
            "tov": "long",
            "season": "integer",
        }
    ),
}

# Event types as spelled by the feed.
MADE, MISSED, FREE_THROW = "Made Shot", "Missed Shot", "Free Throw"
TURNOVER, REBOUND, JUMP_BALL = "Turnover", "Rebound", "Jump Ball"
FIELD_GOALS = (MADE, MISSED)
ON_BALL = (MADE, MISSED, TURNOVER, FREE_THROW, REBOUND, JUMP_BALL)

# Shot zones and the limits that separate them.
RIM, MIDRANGE, CORNER_3, ABOVE_BREAK_3 = (
    "Restricted Area",
    "Midrange",
    "Corner 3",
    "Above Break 3",
)
THREE_ZONES = (CORNER_3, ABOVE_BREAK_3)
CORNER_MAX_Y = 140.0
RIM_MAX_DIST = 4.0

# The standard clutch window (last minutes of period 4 or later, score margin).
CLUTCH_FIRST_PERIOD, CLUTCH_MINUTES, CLUTCH_MARGIN = 4, 5, 5

# Weights of the efficiency formulas.
FREE_THROW_WEIGHT, THREE_BONUS = 0.44, 0.5

# Named eras as (first season, last season), both inclusive. Each may also be named with
# its seasons behind, as in "2000s (2000-2009)".
ERAS = {
    "All Time": (1997, 2026),
    "Late 90s": (1997, 1999),
    "2000s": (2000, 2009),
    "Pace & Space": (2010, 2015),
    "Modern NBA": (2016, 2026),
}

# Radar axes, in drawing order, with the value that maps to the rim of the radar.
RADAR_AXES = {
    "pace": ("Pace", 110.0),
    "ORtg": ("ORtg", 120.0),
    "three_point_rate": ("3PT Rate", 0.6),
    "rim_rate": ("Rim Rate", 0.6),
    "midrange_rate": ("Midrange Rate", 0.6),
}

# Shot-chart sample size, seed and density grid.
SAMPLE_POINTS, SAMPLE_SEED, GRID_BINS = 2500, 42, 25
