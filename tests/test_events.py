"""Cleaning and classification on hand-written rows."""

import pytest

from courtline.operators.clean import clean_columns, clean_events
from courtline.operators.game_order import GameProfile
from courtline.operators.player import build_fact_player_metrics
from courtline.operators.possessions import reconstruct_possessions
from courtline.operators.shots import build_fact_shots, classify_shots

from .helpers import events, rows, worked_example

PLAIN = GameProfile()


def test_clock_text(spark):
    clocks = ["PT12M00.00S", "PT00M05.30S", "", "PT12M00S", None, "PT99999999999M01.00S"]
    df = clean_columns(events(spark, [{"clock": c} for c in clocks]))
    got = [r.seconds_remaining for r in df.orderBy("event_seq").collect()]
    assert got == [720.0, 5.3, None, None, None, None]


def test_coordinates_stay_on_shots_only(spark):
    kinds = ["Made Shot", "Missed Shot", "Rebound", None]
    df = clean_columns(events(spark, [{"type": k, "x": 1.0, "y": 2.0} for k in kinds]))
    got = [(r.x, r.y) for r in df.orderBy("event_seq").collect()]
    assert got == [(1.0, 2.0), (1.0, 2.0), (None, None), (None, None)]


@pytest.mark.parametrize(
    "text, default, strict",
    [
        ("A 3PT (13 PTS) (Smith 3 AST)", "13 PTS) (Smith", "Smith"),
        ("A Layup (Smith 3 AST)", "Smith", "Smith"),
        ("A Layup", "", ""),
    ],
)
def test_assist_text(spark, text, default, strict):
    df = events(spark, [{"desc": text}])
    assert clean_columns(df).first().assister == default
    assert clean_columns(df, strict_assist=True).first().assister == strict


def _game(**columns):
    n = max(len(v) for v in columns.values())
    return [
        {"gameid": "G", "period": 1, "clock": f"PT{11 - i:02d}M00.00S", **{k: v[i] for k, v in columns.items()}}
        for i in range(n)
    ]


def test_running_score_keeps_its_maximum(spark):
    raw = events(spark, _game(h_pts=[10.0, 12.0, 11.0, None], a_pts=[None, None, 3.0, None]))
    got = rows(clean_events(raw, PLAIN), "event_seq", "h_pts_ff", "a_pts_ff", "score_margin")
    assert got == [(1, 10.0, 0.0, 10.0), (2, 12.0, 0.0, 12.0), (3, 12.0, 3.0, 9.0), (4, 12.0, 3.0, 9.0)]


def test_no_score_is_zero(spark):
    raw = events(spark, _game(h_pts=[None, None]))
    assert {r.score_margin for r in clean_events(raw, PLAIN).collect()} == {0.0}


@pytest.mark.parametrize(
    "period, clock, home, away, flag",
    [
        (4, "PT05M00.00S", 5.0, 0.0, 1),
        (5, "PT05M00.00S", 0.0, 5.0, 1),
        (4, "PT05M00.01S", 5.0, 0.0, 0),
        (4, "PT05M00.00S", 6.0, 0.0, 0),
        (4, "PT05M00.00S", 0.0, 6.0, 0),
        (3, "PT05M00.00S", 0.0, 0.0, 0),
        (None, "PT05M00.00S", 0.0, 0.0, 0),
        (4, "junk", 0.0, 0.0, 0),
    ],
)
def test_clutch_edges(spark, period, clock, home, away, flag):
    raw = events(spark, [{"gameid": "G", "period": period, "clock": clock, "h_pts": home, "a_pts": away}])
    assert clean_events(raw, PLAIN).first().is_clutch == flag


@pytest.mark.parametrize(
    "desc, y, dist, zone",
    [
        ("A 3PT Jump Shot", None, 25.0, "Above Break 3"),
        ("A Layup", 1.0, None, "Midrange"),
        (None, 1.0, 3.0, "Restricted Area"),
        ("A 3PT Jump Shot", 140.0, 25.0, "Corner 3"),
        ("A 3PT Jump Shot", 141.0, 25.0, "Above Break 3"),
        ("A Layup", 1.0, 4.0, "Restricted Area"),
        ("A Layup", 1.0, 5.0, "Midrange"),
    ],
)
def test_zones(spark, desc, y, dist, zone):
    row = {"type": "Missed Shot", "desc": desc, "y": y, "dist": dist}
    got = classify_shots(events(spark, [row])).first()
    assert (got.shot_zone, got.shot_value, got.made_flag) == (zone, 0, 0)


def test_shot_value_and_flag(spark):
    raw = events(
        spark,
        [
            {"type": "Made Shot", "desc": "A 3PT Jump Shot (3 PTS)"},
            {"type": "Made Shot", "desc": "A Layup (13 PTS)"},
            {"type": "Made Shot", "desc": None},
            {"type": "Turnover", "desc": "A 3PT"},
        ],
    )
    got = rows(classify_shots(raw), "event_seq", "shot_value", "made_flag", "shot_zone")
    assert got == [(1, 3, 1, "Above Break 3"), (2, 2, 1, "Midrange"), (3, 2, 1, "Midrange"), (4, 0, None, None)]


def test_worked_example_shots_and_player(spark):
    classified = classify_shots(clean_events(worked_example(spark), PLAIN))
    shots = build_fact_shots(classified)
    assert [r.shot_zone for r in shots.collect()] == ["Midrange", "Midrange"]
    lebron = build_fact_player_metrics(classified).filter("player = 'LeBron'")
    total = lebron.groupBy().sum("pts", "fga", "fgm").first()
    assert tuple(total) == (2, 2, 1)


def test_free_throws_and_unnamed_players(spark):
    raw = events(
        spark,
        [
            {"player": "A", "type": "Free Throw", "desc": "A Free Throw (5 PTS)"},
            {"player": "A", "type": "Free Throw", "desc": "MISS A Free Throw"},
            {"player": "", "type": "Free Throw", "desc": "A Free Throw (5 PTS)"},
            {"player": None, "type": "Turnover", "desc": "x"},
        ],
    )
    metrics = build_fact_player_metrics(classify_shots(clean_events(raw, PLAIN)))
    assert rows(metrics, "player", "pts", "fta", "fga", "tov") == [("A", 1, 2, 0, 0)]


def test_three_point_rules_differ_on_running_totals(spark):
    raw = events(spark, _game(type=["Made Shot", "Made Shot"], desc=["A Layup (13 PTS)", "A 3PT (12 PTS)"], team=["X", "X"]))
    cleaned = clean_events(raw, PLAIN)
    by_rule = {
        rule: rows(reconstruct_possessions(cleaned, PLAIN, rule), "event_seq", "points_scored_event")
        for rule in ("points", "3PT")
    }
    assert by_rule == {"points": [(1, 3), (2, 2)], "3PT": [(1, 2), (2, 3)]}


def test_empty_input_keeps_the_schema(spark):
    empty = events(spark, [])
    cleaned = clean_events(empty, PLAIN)
    assert cleaned.count() == 0
    assert {"seconds_remaining", "score_margin", "assister", "is_clutch"} <= set(cleaned.columns)
    assert build_fact_shots(classify_shots(cleaned)).count() == 0
