"""Serving queries, ad-hoc reports and chart frames on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.functions.predicates import clutch_rows
from courtline.operators import adhoc, reshape, serving
from courtline.schema import FACT_SCHEMAS

from .helpers import rows


def metrics(spark, **columns):
    """One team-metrics row per position of the given lists."""
    schema = FACT_SCHEMAS["fact_team_metrics"]
    n = len(next(iter(columns.values())))
    defaults = {"team": ["A"] * n, "season": [2020] * n}
    full = {**defaults, **columns}
    return spark.createDataFrame(
        [tuple(full[c][i] if c in full else 0 for c in schema.fieldNames()) for i in range(n)], schema
    )


def test_zero_denominators(spark):
    got = serving.team_evolution(metrics(spark, is_clutch=[0]), 2020, 2020).first()
    assert got.pace is None
    assert (got.ORtg, got.DRtg, got.three_point_rate, got.rim_rate, got.midrange_rate) == (0.0,) * 5


def test_player_without_attempts(spark):
    row = ("A", 0, 0, 0, 0, 0, 0, 0, 1, 2020)
    got = serving.player_stats(spark.createDataFrame([row], FACT_SCHEMAS["fact_player_metrics"]), "A", 2020, 2020)
    assert tuple(got.first()) == (2020, 0.0, 0.0, 0.0)


def test_clutch_modes(spark):
    df = metrics(spark, is_clutch=[0, 1], total_possessions=[7, 3])
    totals = {m: clutch_rows(df, m).agg(F.sum("total_possessions")).first()[0] for m in ("all", "only", "exclude", True, False)}
    assert totals == {"all": 10, "only": 3, "exclude": 7, True: 3, False: 10} | {"all": 10}
    with pytest.raises(ValueError):
        clutch_rows(df, "sometimes")


def test_pooled_pace_uses_the_larger_game_count(spark):
    df = metrics(spark, is_clutch=[0, 1], total_possessions=[70, 10], games_played=[8, 4])
    assert serving.team_evolution(df, 2020, 2020).first().pace == 10.0


@pytest.mark.parametrize(
    "teams, expected",
    [(None, 3), ([], 3), ("", 3), ("A", 1), (["A", "O'Neal"], 2), ("O'Neal", 1), (("A",), 1), ("' OR 1=1 --", 0)],
)
def test_team_choice(spark, teams, expected):
    df = metrics(spark, team=["A", "O'Neal", None], season=[2020] * 3)
    assert serving.team_evolution(df, 2020, 2020, teams=teams).count() == expected


def test_names_are_sorted_and_complete(spark):
    df = metrics(spark, team=["B", None, "A", "B"], season=[2020] * 4)
    assert [r.team for r in serving.all_teams(df).collect()] == ["A", "B"]


def shots(spark, data):
    """(shooter, x, y, made, season, period, seconds, margin) rows."""
    schema = FACT_SCHEMAS["fact_shots"]
    full = [(n, "A", x, y, "Midrange", m, 2, 0, p, sec, mar, s) for n, x, y, m, s, p, sec, mar in data]
    return spark.createDataFrame(full, schema)


def test_apostrophe_and_clutch_window(spark):
    df = shots(
        spark,
        [
            ("D'Aaron", 1.0, 1.0, 1, 2020, 4, 60.0, 2.0),
            ("D'Aaron", 2.0, 1.0, 0, 2020, 4, 60.1, 2.0),
            ("D'Aaron", 3.0, 1.0, 0, 2020, 4, 60.0, -2.5),
            ("D'Aaron", 4.0, 1.0, 0, 2020, 3, 60.0, 0.0),
        ],
    )
    assert serving.player_shot_points(df, "D'Aaron", 2020, 2020).count() == 4
    late = serving.player_shot_points(df, "D'Aaron", 2020, 2020, True, 1, 2)
    assert rows(late, "x") == [(1.0,)]
    profile = serving.player_shot_profile(df, "D'Aaron", 2020, 2020).first()
    assert (profile.rim_rate, profile.midrange_rate, profile.three_point_rate) == (0.0, 1.0, 0.0)


def test_unguarded_reports_give_null(spark):
    df = metrics(spark, team=["A"], season=[2020])
    got = adhoc.team_ratings_latest(df, "A").first()
    assert got.offensive_rating is None and got.pace is None
    assert adhoc.league_three_point_era(df).first().three_pt_pct_of_offense is None


def points(spark, data):
    schema = "x double, y double, made_flag int, shot_zone string"
    return spark.createDataFrame([(x, y, m, "Midrange") for x, y, m in data], schema)


def test_density_matches_numpy(spark):
    rng = np.random.default_rng(7)
    xy = np.floor(rng.uniform(-250, 420, size=(600, 2)))
    grid, xe, ye = np.histogram2d(xy[:, 0], xy[:, 1], bins=25)
    ix = np.clip(np.digitize(xy[:, 0], xe) - 1, 0, 24)
    iy = np.clip(np.digitize(xy[:, 1], ye) - 1, 0, 24)
    expected = sorted((float(x), float(y), int(d)) for (x, y), d in zip(xy, grid[ix, iy]))
    df = points(spark, [(float(x), float(y), 1) for x, y in xy])
    assert rows(reshape.density_grid(df), "x", "y", "Density") == expected


def test_density_edges(spark):
    same = reshape.density_grid(points(spark, [(3.0, 4.0, 1)] * 5))
    assert {(r.x_bin, r.y_bin, r.Density) for r in same.collect()} == {(12, 12, 5)}
    wide = reshape.density_grid(points(spark, [(0.0, 0.0, 1), (25.0, 25.0, 0), (None, 1.0, 1)]))
    assert {(r.x_bin, r.y_bin, r.Density) for r in wide.collect()} == {(0, 0, 1), (24, 24, 1)}
    assert reshape.density_grid(points(spark, [])).count() == 0


def test_sample_is_exact_and_ignores_partitions(spark):
    data = [(float(i % 40), float(i % 7), i % 2) for i in range(3000)]
    df = points(spark, data)
    one = reshape.sample_points(df.coalesce(1), 250)
    many = reshape.sample_points(df.repartition(9, "y"), 250)
    assert one.count() == 250 and rows(one, *df.columns) == rows(many, *df.columns)
    assert one.exceptAll(df).count() == 0
    assert rows(reshape.sample_points(df, 250, seed=1), *df.columns) != rows(one, *df.columns)
    assert rows(reshape.sample_points(df, 5000), *df.columns) == rows(df, *df.columns)


def test_sample_gives_copies_their_share(spark):
    """A third of the rows are copies of one point: about a third of the sample must be too."""
    data = [(0.0, 0.0, 1)] * 3000 + [(float(i), 1.0, 1) for i in range(6000)]
    share = [
        reshape.sample_points(points(spark, data), 900, seed=s).filter("y = 0").count() / 900
        for s in (1, 2)
    ]
    assert all(0.27 < s < 0.40 for s in share)


def test_chart_of_all_points_has_the_grid_density(spark):
    df = points(spark, [(float(i % 13), float(i * i % 17), i % 2) for i in range(200)] + [(None, 1.0, 1)])
    columns = ("x", "y", "made_flag", "x_bin", "y_bin", "Density")
    assert rows(reshape.shot_chart(df), *columns) == rows(reshape.density_grid(df), *columns)
    few = reshape.shot_chart(df, "Made", n=30)
    assert few.count() == few.filter("made_flag = 1 and Result = 'Made'").count()
    assert few.count() in (29, 30) and few.filter("x is null").count() == 0


def test_results(spark):
    df = points(spark, [(1.0, 1.0, 1), (2.0, 1.0, 0), (3.0, 1.0, None)])
    count = {r: reshape.shots_by_result(df, r).count() for r in ("All", "Made", "Missed")}
    assert count == {"All": 3, "Made": 1, "Missed": 1}
    assert rows(reshape.shots_by_result(df), "x", "Result") == [(1.0, "Made"), (2.0, "Missed"), (3.0, "Missed")]


RATE_SCHEMA = (
    "season int, team string, pace double, ORtg double, DRtg double,"
    " three_point_rate double, rim_rate double, midrange_rate double"
)


def evolution(spark, data):
    return spark.createDataFrame(data, RATE_SCHEMA)


def test_radar_clips_and_closes(spark):
    df = evolution(spark, [(2020, "A", 220.0, -5.0, 1.0, 0.3, None, 0.6), (2020, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)])
    got = rows(reshape.offensive_radar(df), "team", "position", "theta", "r")
    assert got == [
        ("A", 0, "Pace", 1.0),
        ("A", 1, "ORtg", 0.0),
        ("A", 2, "3PT Rate", 0.5),
        ("A", 3, "Rim Rate", 0.0),
        ("A", 4, "Midrange Rate", 1.0),
        ("A", 5, "Pace", 1.0),
    ]
    assert {r.team for r in reshape.offensive_radar(df.drop("team")).collect()} == {"Average"}


def test_pace_series_names(spark):
    league = evolution(spark, [(2020, None, 50.0, 0.0, 0.0, 0.0, 0.0, 0.0)]).drop("team")
    one = evolution(spark, [(2020, "A", 60.0, 0.0, 0.0, 0.0, 0.0, 0.0)])
    two = one.unionByName(evolution(spark, [(2020, "B", 61.0, 0.0, 0.0, 0.0, 0.0, 0.0)]))
    names = lambda df: {r.series for r in df.collect()}
    assert names(reshape.pace_series(league)) == {"League Average"}
    assert names(reshape.pace_series(league, one)) == {"League Average", "Team Pace"}
    assert names(reshape.pace_series(league, two)) == {"League Average", "A", "B"}
    assert names(reshape.pace_series(league, one.limit(0))) == {"League Average"}
    unnamed = one.unionByName(evolution(spark, [(2020, None, 61.0, 0.0, 0.0, 0.0, 0.0, 0.0)]))
    assert names(reshape.pace_series(league, unnamed)) == {"League Average", "Team Pace"}


def test_team_averages_and_table(spark):
    df = evolution(
        spark,
        [
            (2020, "A", 50.0, 100.0, 110.0, 0.333, 0.2, 0.4),
            (2021, "A", None, 101.0, 111.0, 0.4, 0.2, 0.4),
            (2021, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ],
    )
    means = reshape.team_averages(df)
    assert rows(means, "team", "season", "pace", "ORtg") == [("A", 2020.5, 50.0, 100.5)]
    table = reshape.efficiency_table(means)
    assert "season" not in table.columns
    assert rows(table, "team", "ORtg", "three_point_rate") == [("A", 100.5, 0.37)]
    assert rows(reshape.ratings_scatter(means), "team", "DRtg", "size") == [("A", 110.5, 50.0)]


EFF = "season int, TS_pct double, eFG_pct double, three_point_efficiency double"


def test_latest_seasons_are_independent(spark):
    player = spark.createDataFrame([(2019, 0.5, 0.4, None), (2018, 0.9, 0.9, 0.9)], EFF)
    league = spark.createDataFrame([(2021, 0.55, 0.45, 0.35), (2020, 0.1, 0.1, 0.1)], EFF)
    latest = reshape.latest_efficiency(player, league)
    assert rows(latest, "series", "season") == [("League Avg", 2021), ("Player", 2019)]
    bars = rows(reshape.efficiency_compare(latest), "metric", "player", "league", "player_label", "league_label")
    assert bars == [
        ("3PT%", 0.0, 0.35, "0.0%", "35.0%"),
        ("TS%", 0.5, 0.55, "50.0%", "55.0%"),
        ("eFG%", 0.4, 0.45, "40.0%", "45.0%"),
    ]
    alone = reshape.efficiency_compare(reshape.latest_efficiency(player, league.limit(0)))
    assert rows(alone, "player", "league", "delta", "league_label")[0][1:] == (None, None, None)
    nobody = reshape.latest_efficiency(player.limit(0), league)
    assert reshape.efficiency_compare(nobody).count() == 0


def test_long_series(spark):
    player = spark.createDataFrame([(2019, 0.5, 0.4, None)], EFF)
    assert rows(reshape.career_efficiency(player), "series", "value") == [("TS%", 0.5), ("eFG%", 0.4)]
    assert reshape.career_efficiency(player, player).count() == 4


def test_eras(spark):
    df = metrics(spark, season=[1996, 1998, 2012, 2016], team=["A"] * 4, total_possessions=[1, 10, 20, 30], games_played=[1, 5, 5, 10])
    got = rows(reshape.era_league_summary(df), "era", "first_season", "last_season", "pace")
    assert got == [
        ("All Time", 1998, 2016, 6.0),
        ("Late 90s", 1998, 1998, 2.0),
        ("Modern NBA", 2016, 2016, 3.0),
        ("Pace & Space", 2012, 2012, 4.0),
    ]
    assert reshape.era_range("2000s") == reshape.era_range("2000s (2000-2009)") == (2000, 2009)
    assert reshape.era_range("All Time") == (1997, 2026)
    with pytest.raises(ValueError, match="unknown era"):
        reshape.era_range("2000s (1997-2026)")
