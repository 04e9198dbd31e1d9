"""Team and player metrics: brute-force comparison, NULL keys, conservation laws."""

import pytest
from pyspark.sql import functions as F

from courtline.operators.team import (
    build_fact_team_metrics,
    offense_and_defense,
    team_defense,
    team_matchups,
    team_offense,
    team_shot_counts,
)
from courtline.schema import FACT_SCHEMAS

from .helpers import rows


def possessions(spark, data):
    """(gameid, team, season, is_clutch, points) rows."""
    schema = FACT_SCHEMAS["fact_possessions"]
    full = [(f"p{i}", g, t, 1.0, p, c, "x", s) for i, (g, t, s, c, p) in enumerate(data)]
    return spark.createDataFrame(full, schema)


AWKWARD = [
    ("g1", "A", 2020, 0, 2), ("g1", "B", 2020, 0, 3), ("g1", "A", 2020, 1, 1),
    ("g1", None, 2020, 0, 0),
    ("g2", "A", 2020, 0, 2), ("g2", "B", 2020, 1, 3), ("g2", "C", 2020, 0, 4),
    ("g3", "A", 2021, 0, 2),
    (None, "A", None, 0, 5), (None, "B", None, 0, 6),
    ("g4", "A", None, 0, 1), ("g4", "B", None, 1, 2),
    ("g5", "A", 2020, 0, 2), ("g5", "B", 2020, 0, 2), ("g5", "A", 2021, 0, 2), ("g5", "B", 2021, 0, 2),
]


def by_pairs(poss):
    """Defense the long way: every possession meets every other team of its game."""
    pairs = team_matchups(poss).withColumnsRenamed({"gameid": "g", "off_team": "o"})
    met = (F.col("gameid") == F.col("g")) & (F.col("team") == F.col("o"))
    joined = poss.join(pairs, met, "left")
    return joined.groupBy(F.col("def_team").alias("team"), "season", "is_clutch").agg(
        F.count("possession_id").alias("def_possessions"), F.sum("points_scored").alias("points_allowed")
    )


KEYS = ("team", "season", "is_clutch")


def test_defense_equals_pairing_every_possession(spark):
    poss = possessions(spark, AWKWARD)
    columns = (*KEYS, "def_possessions", "points_allowed")
    assert rows(team_defense(poss), *columns) == rows(by_pairs(poss), *columns)


def test_one_pass_equals_outer_join(spark):
    poss = possessions(spark, AWKWARD)
    joined = team_offense(poss).join(by_pairs(poss), list(KEYS), "outer").fillna(0)
    columns = joined.columns
    assert rows(offense_and_defense(poss), *columns) == rows(joined, *columns)


def test_null_team_keeps_two_rows(spark):
    poss = possessions(spark, [("g", None, 2020, 0, 0), ("g", "A", 2020, 0, 2)])
    got = rows(offense_and_defense(poss), "team", "total_possessions", "def_possessions")
    assert got == [(None, 0, 2), (None, 1, 0), ("A", 1, 0)]


def test_null_season_becomes_zero(spark):
    poss = possessions(spark, [("g", "A", None, 0, 2), ("g", "B", None, 0, 2)])
    got = rows(offense_and_defense(poss), "team", "season", "total_possessions", "def_possessions")
    assert got == [("A", 0, 0, 1), ("A", 0, 1, 0), ("B", 0, 0, 1), ("B", 0, 1, 0)]


def test_many_teams_under_one_game(spark):
    """A damaged game with many team codes: n squared pairs, but one row per team here."""
    poss = possessions(spark, [("g", f"T{i}", 2020, i % 2, i) for i in range(40)])
    columns = (*KEYS, "def_possessions", "points_allowed")
    assert rows(team_defense(poss), *columns) == rows(by_pairs(poss), *columns)


def test_games_played_needs_a_game_id(spark):
    poss = possessions(spark, [(None, "A", 2020, 0, 1), ("g", "A", 2020, 0, 1), ("g", "A", 2020, 0, 1)])
    assert rows(offense_and_defense(poss), "team", "games_played")[-1] == ("A", 1)


def test_league_totals(frames):
    totals = frames.facts["fact_team_metrics"].agg(
        *(F.sum(c).alias(c) for c in ("total_possessions", "points_scored", "def_possessions", "points_allowed"))
    ).first()
    assert tuple(totals) == (4333, 5713, 4333, 5713)


def test_zones_add_up(frames):
    wrong = frames.facts["fact_team_metrics"].filter(
        "three_pt_attempts + rim_attempts + midrange_attempts <> total_fga"
    )
    assert wrong.count() == 0


def test_team_without_shots_counts_zero(spark):
    poss = possessions(spark, [("g", "A", 2020, 0, 2)])
    shots = spark.createDataFrame([], FACT_SCHEMAS["fact_shots"])
    got = build_fact_team_metrics(poss, shots)
    assert [f.name for f in got.schema] == FACT_SCHEMAS["fact_team_metrics"].fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in FACT_SCHEMAS["fact_team_metrics"]]
    assert rows(got, "team", "total_fga", "games_played") == [(None, 0, 0), ("A", 0, 1)]
    assert team_shot_counts(shots).count() == 0


def test_player_totals(frames):
    got = frames.facts["fact_player_metrics"].agg(
        F.count("*"), F.count_distinct("player"), F.sum("pts")
    ).first()
    assert tuple(got) == (400, 20, 5190)


@pytest.mark.parametrize("table", list(FACT_SCHEMAS))
def test_fact_schemas(frames, table):
    got = [(f.name, f.dataType) for f in frames.facts[table].schema]
    assert got == [(f.name, f.dataType) for f in FACT_SCHEMAS[table]]
