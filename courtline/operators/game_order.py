"""Ordering of the events of a game, and how games are spread over tasks.

Order inside a game is (period, clock counting down, event_seq), and ``event_seq`` is known and unique
among the events of one clock value, so every plan has one order to follow. The windows of both plans
check that as they go, where neighbours in the order lie side by side; ``check_event_order`` asks for more,
unique numbers in the whole game, before anything is computed. A real game has a few hundred events, so
one task per game is the cheapest plan: one shuffle on gameid serves every window. A damaged feed can still put a large share of all rows under one id (or under NULL). Those
games are found by a count per game and take a second plan, which cuts a game into segments (ranges of
about ``SEGMENT_TICKS`` clock values), a segment into ticks (one clock value) and a tick into chunks of at
most ``CHUNK_ROWS`` consecutive event numbers, scans the chunks in parallel and carries the state between
them through small summaries. Both plans give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A game above this many rows takes the split plan; a task sorts that many rows with ease.
HOT_GAME_ROWS = 1_000_000
CHUNK_ROWS = 1_000_000
# Clock values in a segment of a game, on average.
SEGMENT_TICKS = 100_000

TICK = ("gameid", "period", "seconds_remaining")


def tick_order() -> list[Column]:
    return [F.col("period").asc_nulls_first(), F.col("seconds_remaining").desc_nulls_last()]


def by_tick():
    """Events of a game by clock. The default RANGE frame makes clock ties peers."""
    return Window.partitionBy("gameid").orderBy(*tick_order())


def by_event():
    return Window.partitionBy("gameid").orderBy(*tick_order(), F.col("event_seq"))


def up_to_here(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before_here(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class GameProfile:
    """What a pass over a feed tells: the oversized games, as a frame of their ids (None where there
    are none), and whether seasons follow games."""

    hot_games: DataFrame | None = field(default=None, compare=False)
    one_season_per_game: bool = False


#: What an event number that does not tell the order is answered with.
NO_ORDER = "event_seq must be unique and not NULL within a game"


def in_order(value: Column, clash: Column) -> Column:
    """``value``, or an error where the row has no number or the number (``clash``) of its neighbour."""
    said = F.concat(
        F.lit(f"{NO_ORDER}: "), F.coalesce(F.col("event_seq").cast("string"), F.lit("NULL")),
        F.lit(" in game "), F.coalesce(F.col("gameid").cast("string"), F.lit("NULL")),
    )
    wrong = F.col("event_seq").isNull() | F.coalesce(clash, F.lit(False))
    return F.when(wrong, F.raise_error(said)).otherwise(value)


def check_event_order(events: DataFrame) -> None:
    """Raise unless ``event_seq`` is known and unique within each game. A job with a shuffle of all
    numbers; the pipeline does without, its windows check what the order needs. Files read by
    ``ingest_data`` have such numbers by construction."""
    repeated = events.groupBy("gameid", "event_seq").agg(F.count(F.lit(1)).alias("n"))
    wrong = repeated.filter("n > 1 or event_seq is null").limit(1).collect()
    if wrong:
        raise ValueError(f"{NO_ORDER}: {wrong[0].event_seq} occurs {wrong[0].n} times in game {wrong[0].gameid}")


def profile_games(
    events: DataFrame,
    hot_rows: int | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    check_order: bool = True,
) -> GameProfile:
    """Run a job over two columns: the oversized games, and whether seasons follow games.

    Counts are pre-aggregated before the shuffle. Two flags come to the driver; the ids of the
    oversized games stay a frame, however many they are, which ``keep`` may stage.
    """
    if check_order:
        check_event_order(events)
    hot_rows = HOT_GAME_ROWS if hot_rows is None else hot_rows
    games = events.groupBy("gameid").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("season").alias("dated"),
        F.min("season").alias("first"),
        F.max("season").alias("last"),
    )
    mixed = (F.col("first") != F.col("last")) | (F.col("dated").between(1, F.col("n") - 1))
    flags = games.agg(
        F.coalesce(F.bool_or(F.col("n") > hot_rows), F.lit(False)).alias("hot"),
        F.coalesce(F.bool_or(F.col("gameid").isNotNull() & mixed), F.lit(False)).alias("mixed"),
    ).first()
    hot = games.filter(F.col("n") > hot_rows).select("gameid") if flags.hot else None
    return GameProfile(
        hot_games=keep(hot) if hot is not None and keep else hot,
        one_season_per_game=not flags.mixed,
    )


def games_by_size(events: DataFrame, profile: GameProfile) -> tuple[DataFrame, DataFrame]:
    """The events of ordinary games, and those of the oversized ones that ``profile`` has.

    The ids of oversized games are few beside the rows, so adaptive execution may broadcast them; by
    its size, it decides. A NULL id is an id like any other.
    """
    hot = profile.hot_games.select(F.col("gameid").alias("_hot_game")).distinct()
    same = events["gameid"].eqNullSafe(hot["_hot_game"])
    return events.join(hot, same, "anti"), events.join(hot, same, "semi")


def by_game_size(
    events: DataFrame,
    profile: GameProfile,
    per_game: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``per_game`` to ordinary games and ``split`` to the oversized ones."""
    if profile.hot_games is None:
        return per_game(events)
    ordinary, large = games_by_size(events, profile)
    return per_game(ordinary).unionByName(split(large))


def with_segments(ticks: DataFrame, events: DataFrame) -> DataFrame:
    """Add ``_place``, the order of a tick in its game, and ``_seg``, the key of its segment.

    A game is cut at clock values of ``events`` drawn by their hash, one of SEGMENT_TICKS, and a segment
    is what lies between two cuts, whatever periods and clock values the game has. The draw depends on
    the values alone, so every part of a plan finds the same cuts without a sort, a sample or a job, and
    drops all other rows where it reads them. Most games have no cut.
    """
    clock = F.col("seconds_remaining")
    place = F.struct("period", clock.isNull().alias("unknown"), (-clock).alias("down"))
    drawn = F.pmod(F.xxhash64(*TICK), F.lit(SEGMENT_TICKS)) == 0
    cuts = events.filter(drawn).select(*TICK).distinct().groupBy(F.col("gameid").alias("_cut_game")).agg(
        F.collect_list(place).alias("_cuts")
    )
    placed = ticks.withColumn("_place", place)
    known = placed.join(cuts, placed["gameid"].eqNullSafe(cuts["_cut_game"]), "left")
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_place")))
    number = F.when(F.col("_cuts").isNull(), 0).otherwise(passed)
    return known.withColumn("_seg", F.struct("gameid", number.alias("n"))).drop("_cuts", "_cut_game")


def with_chunks(events: DataFrame) -> DataFrame:
    """Add ``_tick`` and ``_chunk``, struct keys under which NULL equals NULL.

    Event numbers are unique within a tick, so a chunk of it cannot exceed CHUNK_ROWS rows.
    """
    seq_type = events.schema["event_seq"].dataType
    if isinstance(seq_type, T.StructType):
        *outer, last = seq_type.fieldNames()
        slot = F.struct(
            *(F.col(f"event_seq.{f}").alias(f) for f in outer),
            F.floor(F.col(f"event_seq.{last}") / CHUNK_ROWS).alias(last),
        )
    else:
        slot = F.floor(F.col("event_seq") / CHUNK_ROWS)
    return events.withColumn("_tick", F.struct(*TICK)).withColumn(
        "_chunk", F.struct(*TICK, slot.alias("slot"))
    )
