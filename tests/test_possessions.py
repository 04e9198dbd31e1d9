"""Possessions: goldens, the split plan against the per-game plan, and conservation laws."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courtline.functions.events import clock_seconds
from courtline.operators import game_order
from courtline.operators.clean import clean_events
from courtline.operators.game_order import GameProfile, profile_games
from courtline.operators.possessions import (
    build_fact_possessions,
    game_season_dim,
    possessions_with_season,
    reconstruct_possessions,
)
from courtline.plans.pipeline import fact_frames
from courtline.schema import FACT_SCHEMAS, RAW_EVENTS

from .helpers import events, rows, tied_game, worked_example

PLAIN = GameProfile()
MARKS = ("event_seq", "possession_team", "prev_possession_team", "prev_period", "is_new_possession", "possession_id")


def marked(raw, profile=PLAIN, rule="points"):
    return reconstruct_possessions(clean_events(raw, profile), profile, rule)


def test_worked_example(spark):
    got = build_fact_possessions(marked(worked_example(spark))).collect()
    assert [tuple(r) for r in got] == [("G1_1", "G1", "LAL", 5.0, 2, 1, "Score")]


def test_clock_ties_and_period_change(spark):
    got = rows(marked(tied_game(spark)), "event_seq", "possession_team", "is_new_possession", "possession_id")
    assert got == [
        (1, None, 0, "G2_0"),
        (2, "BOS", 1, "G2_1"),
        (3, "LAL", 1, "G2_2"),
        (4, "LAL", 0, "G2_2"),
        (5, "LAL", 0, "G2_2"),
        (6, "LAL", 1, "G2_3"),
        (7, "LAL", 0, "G2_3"),
    ]


@pytest.mark.parametrize("rule, points", [("points", 3), ("3PT", 2)])
def test_possession_rows(spark, rule, points):
    facts = build_fact_possessions(marked(tied_game(spark), rule=rule))
    got = rows(facts, "possession_id", "team", "possession_length", "points_scored", "possession_result")
    assert got == [
        ("G2_0", None, 0.0, 0, "Miss/Other"),
        ("G2_1", "BOS", 0.0, 2, "Score"),
        ("G2_2", "LAL", 20.0, 0, "Miss/Other"),
        ("G2_3", "LAL", 10.0, points, "Score"),
    ]


def test_null_game_has_bare_numbers_and_no_season(spark):
    facts = build_fact_possessions(marked(tied_game(spark, gameid=None)))
    assert [r[0] for r in rows(facts, "possession_id")] == ["0", "1", "2", "3"]
    dated = possessions_with_season(facts, game_season_dim(tied_game(spark, gameid=None)))
    assert {r.season for r in dated.collect()} == {None}
    frames = fact_frames(tied_game(spark, gameid=None), PLAIN)
    assert {r.season for r in frames["fact_possessions"].collect()} == {None}


def test_score_wins_over_turnover(spark):
    kinds = ["Turnover", "Made Shot"]
    raw = events(spark, [{"gameid": "G", "period": 1, "clock": "PT10M00.00S", "team": "A", "type": k} for k in kinds])
    assert [r.possession_result for r in build_fact_possessions(marked(raw)).collect()] == ["Score"]


def test_game_under_two_seasons_counts_in_both(spark):
    two = tied_game(spark).withColumn("season", F.when(F.col("event_seq") < 4, 2023).otherwise(2024))
    assert not profile_games(two).one_season_per_game
    got = fact_frames(two, profile_games(two))["fact_possessions"]
    assert got.count() == 8 and rows(got.select("season").distinct(), "season") == [(2023,), (2024,)]


def test_partly_undated_game_takes_the_join(spark):
    part = tied_game(spark).withColumn("season", F.when(F.col("event_seq") < 4, 2023))
    assert not profile_games(part).one_season_per_game
    assert rows(fact_frames(part, profile_games(part))["fact_possessions"].select("season").distinct(), "season") == [(None,), (2023,)]


def _awkward(spark, frames):
    """Fixture events plus NULL games, broken clocks, NULL periods and score-less stretches."""
    base = frames.events
    hot = F.col("gameid").isin("G00001", "G00002", "G00003")
    return base.withColumns(
        {
            "gameid": F.when(F.col("gameid") == "G00004", None).otherwise(F.col("gameid")),
            "clock": F.when(hot & (F.col("event_seq") % 3 == 0), "broken").otherwise(F.col("clock")),
            "period": F.when(hot & (F.col("event_seq") % 11 == 0), None).otherwise(F.col("period")),
        }
    )


def hot_ids(spark, *ids):
    return spark.createDataFrame([(g,) for g in ids], "gameid string")


@pytest.mark.parametrize("chunk, broadcast", [(3, "-1"), (1_000_000, "10m")])
def test_split_plan_equals_per_game_plan(spark, frames, monkeypatch, chunk, broadcast):
    monkeypatch.setattr(game_order, "CHUNK_ROWS", chunk)
    raw = _awkward(spark, frames)
    split = GameProfile(hot_ids(spark, "G00001", "G00002", "G00003", None), one_season_per_game=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        columns = ("h_pts_ff", "a_pts_ff", "is_clutch", *MARKS)
        assert rows(marked(raw, split), *columns) == rows(marked(raw), *columns)
        ours, plain = fact_frames(raw, split), fact_frames(raw, GameProfile(None, True))
        for table, schema in FACT_SCHEMAS.items():
            names = schema.fieldNames()
            assert rows(ours[table], *names) == rows(plain[table], *names), table
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_plan_orders_struct_event_numbers(spark, frames, monkeypatch):
    monkeypatch.setattr(game_order, "CHUNK_ROWS", 5)
    raw = frames.events.withColumn(
        "event_seq", F.struct(F.lit("f").alias("file"), F.lit(0).alias("split"), F.col("event_seq").alias("row"))
    )
    columns = ("event_seq.row", "h_pts_ff", "possession_team", "possession_id")
    split = GameProfile(hot_ids(spark, "G00005", "G00006"))
    assert rows(marked(raw, split), *columns) == rows(marked(raw), *columns)


def test_profile_finds_oversized_games(spark, frames):
    raw = _awkward(spark, frames)
    sizes = {r.gameid: r["count"] for r in raw.groupBy("gameid").count().collect()}
    limit = sorted(sizes.values())[-6]
    profile = profile_games(raw, hot_rows=limit)
    assert {r.gameid for r in profile.hot_games.collect()} == {g for g, n in sizes.items() if n > limit}
    everything = profile_games(raw, hot_rows=0).hot_games
    assert everything.count() == len(sizes)  # no bound on their number
    assert profile_games(raw).hot_games is None


@pytest.mark.parametrize("number", ["event_seq div 50", "if(event_seq > 9, event_seq, null)"])
def test_repeated_and_unknown_event_numbers_are_refused(spark, frames, number):
    with pytest.raises(ValueError, match="unique and not NULL"):
        profile_games(frames.events.withColumn("event_seq", F.expr(number)))


def test_number_repeated_in_other_games_is_fine(spark, frames):
    place = F.row_number().over(Window.partitionBy("gameid").orderBy("event_seq"))
    profile_games(frames.events.withColumn("event_seq", place))


@pytest.mark.parametrize("ticks", [1, 4, 100_000])
def test_segments_do_not_matter(spark, frames, monkeypatch, ticks):
    monkeypatch.setattr(game_order, "SEGMENT_TICKS", ticks)
    monkeypatch.setattr(game_order, "CHUNK_ROWS", 2)
    raw = _awkward(spark, frames)
    split = profile_games(raw, hot_rows=0)
    columns = ("h_pts_ff", "a_pts_ff", *MARKS)
    assert rows(marked(raw, split), *columns) == rows(marked(raw), *columns)


def test_no_window_of_the_split_plan_holds_a_game(spark, frames):
    import re

    text = marked(frames.events, profile_games(frames.events, hot_rows=0))._jdf.queryExecution().optimizedPlan().toString()
    whole = [w for w in re.findall(r"Window \[[^\n]*", text.split("Join LeftSemi")[-1]) if "gameid" in w]
    assert all("_seg" in w or "_tick" in w or "_chunk" in w for w in whole)


def test_a_minute_of_very_many_clock_values_is_cut(spark, monkeypatch):
    """100,000 clock values in one minute: no segment, which is what a window holds, has many of them."""
    monkeypatch.setattr(game_order, "SEGMENT_TICKS", 2_000)
    clock = F.format_string("PT03M%.5fS", F.col("id") * 0.0005)
    team = F.when(F.col("id") % 7 != 0, F.concat(F.lit("T"), (F.col("id") % 11 % 3).cast("string")))
    kind = F.when(F.col("id") % 3 == 0, "Rebound").otherwise("Made Shot")
    raw = spark.range(100_000).select(
        F.lit("HOT").alias("gameid"), F.lit(2024).alias("season"), F.lit(2).alias("period"), clock.alias("clock"),
        team.alias("team"), kind.alias("type"), F.lit("Layup (2 PTS)").alias("desc"),
        (F.col("id") * 31 % 977).cast("double").alias("h_pts"), (F.col("id") * 17 % 991).cast("double").alias("a_pts"),
        F.col("id").alias("event_seq"),
    )
    full = raw.select(*(
        F.col(f.name).cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_EVENTS.fields
    ), "event_seq")
    ticks = full.select("gameid", "period", clock_seconds(F.col("clock")).alias("seconds_remaining")).distinct()
    sizes = [r["count"] for r in game_order.with_segments(ticks, ticks).groupBy("_seg").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) > 20 and max(sizes) < 2_000 * 12
    columns = ("event_seq", "h_pts_ff", "a_pts_ff", "possession_team", "prev_possession_team", "possession_id")
    split, plain = (marked(full, p).select(*columns).toPandas() for p in (GameProfile(hot_ids(spark, "HOT")), PLAIN))
    split, plain = (f.sort_values("event_seq", ignore_index=True) for f in (split, plain))
    assert len(plain) == 100_000 and split.equals(plain)


def test_segments_follow_each_other_in_the_order_of_the_game(spark, monkeypatch):
    """Cuts part a game by its order, unknown periods first and unknown clocks last of their period."""
    monkeypatch.setattr(game_order, "SEGMENT_TICKS", 3)
    known = [(g, p, s) for g in ("A", None) for p in (None, -70_000, 1, 2, 80_000) for s in (None, 0.0, 0.5, 59.9, 60.0, 1e6)]
    ticks = spark.createDataFrame(known, "gameid string, period int, seconds_remaining double")
    got = game_order.with_segments(ticks, ticks).collect()
    assert len(got) == len(known)
    for game in ("A", None):
        mine = [r for r in got if r.gameid == game]
        mine.sort(key=lambda r: (
            r.period is not None, r.period or 0, r.seconds_remaining is None, -(r.seconds_remaining or 0.0)
        ))
        numbers = [r._seg.n for r in mine]
        assert numbers == sorted(numbers) and len(set(numbers)) > 3


def test_points_are_conserved(spark, frames):
    events_points = frames.marked.agg(F.sum("points_scored_event")).first()[0]
    assert frames.facts["fact_possessions"].agg(F.sum("points_scored")).first()[0] == events_points == 5713


def test_input_partitions_do_not_matter(spark, frames):
    shuffled = frames.events.repartition(13, "k") if "k" in frames.events.columns else frames.events.repartition(13)
    columns = ("event_seq", "h_pts_ff", "possession_id", "possession_team")
    assert rows(marked(shuffled), *columns) == rows(frames.marked, *columns)
