"""The batch job: raw events -> four fact tables."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import events as E
from ..operators.clean import clean_columns, with_margin
from ..operators.game_order import NO_ORDER, GameProfile, by_game_size, games_by_size, profile_games
from ..operators.game_scan import per_game_marks, per_game_scores, split_scan
from ..operators.player import build_fact_player_metrics
from ..operators.possessions import (
    build_fact_possessions,
    game_season_dim,
    possessions_with_season,
    season_of_possession,
    with_action_team,
)
from ..operators.shots import build_fact_shots, with_shot_outcome, with_shot_zone
from ..operators.team import build_fact_team_metrics
from ..schema import FACT_SCHEMAS
from ..sources.event_files import DEFAULT_PATH, ingest_data
from ..sources.fact_store import FactStore
from .staging import Staging, partitions_for, shuffle_partitions

# What the windows and the facts need. The free text, the clock text, the unused columns of the
# feed and whatever follows from these columns are left out before the first shuffle.
MEASURED = (
    "gameid", "season", "period", "seconds_remaining", "event_seq", "h_pts", "a_pts", "team",
    "player", "type", "x", "y", "shot_zone", "points_scored_event",
)
MARKED = (
    "gameid", "season", "period", "seconds_remaining", "score_margin", "is_clutch", "team",
    "player", "type", "x", "y", "shot_zone", "points_scored_event", "possession_team",
    "possession_id_game",
)


def measure_events(events: DataFrame, three_point_rule: str = "points") -> DataFrame:
    """The row-wise columns that read the text, in one projection, before any shuffle."""
    measured = with_shot_zone(clean_columns(events)).withColumn(
        "points_scored_event", E.event_points(three_point_rule)
    )
    return measured.select(*MEASURED)


def _mark_ordinary(rows: DataFrame) -> DataFrame:
    return with_margin(per_game_marks(per_game_scores(rows))).select(*MARKED)


def _mark_large(rows: DataFrame) -> DataFrame:
    return with_margin(split_scan(rows, scores=True, marks=True)).select(*MARKED)


def mark_events(measured: DataFrame, profile: GameProfile) -> DataFrame:
    """Scores, clutch flag and possessions: all windows on one shuffle of narrow rows."""
    return by_game_size(with_action_team(measured), profile, _mark_ordinary, _mark_large)


def seasonal_possessions(marked: DataFrame, profile: GameProfile) -> DataFrame:
    """fact_possessions with season. The join is left out where it cannot change a row."""
    if profile.one_season_per_game:
        return build_fact_possessions(marked, season_of_possession())
    return possessions_with_season(build_fact_possessions(marked), game_season_dim(marked))


def fact_frames(
    events: DataFrame, profile: GameProfile, three_point_rule: str = "points"
) -> dict[str, DataFrame]:
    """The four facts as lazy frames over raw events (16 columns and event_seq)."""
    marked = mark_events(measure_events(events, three_point_rule), profile)
    shots, possessions = build_fact_shots(with_shot_outcome(marked)), seasonal_possessions(marked, profile)
    return {
        "fact_shots": shots,
        "fact_possessions": possessions,
        "fact_team_metrics": build_fact_team_metrics(possessions, shots),
        "fact_player_metrics": build_fact_player_metrics(marked),
    }


def staged_marks(
    staging: Staging, measured: DataFrame, profile: GameProfile, partitions: int
) -> list[DataFrame]:
    """The marked rows as one staged table, or as two where there are oversized games.

    Ordinary games are bucketed like the windows' shuffle: possessions then group by game without
    another. A bucket is read by one task, so the rows of oversized games are kept apart, and without.
    """
    rows = with_action_team(measured)
    if profile.hot_games is None:
        return [staging.keep(_mark_ordinary(rows), "marked", "gameid", partitions)]
    ordinary, large = games_by_size(rows, profile)
    return [
        staging.keep(_mark_ordinary(ordinary), "marked", "gameid", partitions),
        staging.keep(_mark_large(large), "marked_large"),
    ]


def independent_facts(parts: list[DataFrame], profile: GameProfile) -> dict[str, DataFrame]:
    """The facts that read nothing but marked rows. No game is in two parts, so their possessions are."""
    marked = _together(parts)
    return {
        "fact_shots": build_fact_shots(with_shot_outcome(marked)),
        "fact_possessions": _together([seasonal_possessions(part, profile) for part in parts]),
        "fact_player_metrics": build_fact_player_metrics(marked),
    }


def _together(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def run_pipeline(
    spark: SparkSession,
    source: str | list[str] | DataFrame = DEFAULT_PATH,
    out: str = "data/processed",
    three_point_rule: str = "points",
    overwrite: str = "static",
) -> dict[str, float]:
    """Build and write the four fact tables; returns seconds per step.

    ``source`` is a path of CSV files, or raw events that have an ``event_seq`` already, known and
    unique among the events of a game and clock value, else a ValueError. Team metrics read the shots
    and possessions that were just written. The four tables replace the present ones together when all
    are written; a run that fails leaves the present ones as they are.
    """
    seconds: dict[str, float] = {}
    started = last = time.monotonic()

    def done(step: str) -> None:
        nonlocal last
        now = time.monotonic()
        seconds[step], last = now - last, now

    staging = Staging(spark)
    try:
        # Rows are measured once, and event_seq is fixed on disk before anything reads it.
        events = source if isinstance(source, DataFrame) else ingest_data(spark, source)
        measured = staging.keep(measure_events(events, three_point_rule), "measured")
        partitions = partitions_for(spark, staging.bytes("measured"))
        done("ingest")
        with shuffle_partitions(spark, partitions), FactStore(spark, out).commit(overwrite) as commit:
            # The windows check the order of events where they sort them.
            profile = profile_games(
                measured, keep=lambda ids: staging.keep(ids, "hot_games"), check_order=False
            )
            done("profile")
            parts = staged_marks(staging, measured, profile, partitions)
            done("mark")
            independent = independent_facts(parts, profile)
            # Three jobs over one staged table: running together they fill each other's tails.
            with ThreadPoolExecutor(len(independent)) as pool:
                for job in [pool.submit(commit.write, *fact) for fact in independent.items()]:
                    job.result()
            done("facts")
            # Only what was just written: with overwrite="dynamic" those are whole seasons.
            shots, possessions = commit.read("fact_shots"), commit.read("fact_possessions")
            commit.write("fact_team_metrics", build_fact_team_metrics(possessions, shots))
            done("team_metrics")
        done("commit")
    except PySparkException as error:
        if NO_ORDER in str(error):
            said = str(error).split(NO_ORDER, 1)[1].splitlines()[0]
            raise ValueError(NO_ORDER + said) from error
        raise
    finally:
        staging.drop()
    seconds["total"] = time.monotonic() - started
    return seconds


def table_counts(store: FactStore) -> DataFrame:
    """Rows per fact table."""
    counts = [
        store.read(table).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(table).alias("table_name"), "n_rows"
        )
        for table in FACT_SCHEMAS
    ]
    first, *rest = counts
    for df in rest:
        first = first.unionByName(df)
    return first
