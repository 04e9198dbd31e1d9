"""What depends on the order of events: running scores and possession marks.

``per_game_*`` are the window plans for ordinary games; ``split_scan`` computes the same columns
for games that are too large for one task (see ``game_order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .game_order import TICK, before_here, by_event, by_tick, in_order, up_to_here, with_chunks, with_segments

SCORES = ("h_pts", "a_pts")
RUNNING = tuple(f"{c}_ff" for c in SCORES)
MARKS = (
    "possession_team",
    "prev_possession_team",
    "prev_period",
    "is_new_possession",
    "possession_id_game",
)


def per_game_scores(events: DataFrame) -> DataFrame:
    """Running maximum of both scores (not a fill: a correction downward does not lower it)."""
    row = by_event()
    running = {f"{c}_ff": F.max(c).over(up_to_here(row)) for c in SCORES}
    place = F.struct("period", "seconds_remaining", "event_seq")
    scored = events.withColumns({**running, "_clash": place.eqNullSafe(F.lag(place).over(row))})
    return scored.withColumns({c: in_order(F.col(c), F.col("_clash")) for c in running}).drop("_clash")


def _starts_possession() -> Column:
    """Change of team, change of period, or first team of the game. No team yet: 0."""
    team, before = F.col("possession_team"), F.col("prev_possession_team")
    starts = (team != before) | (F.col("period") != F.col("prev_period")) | before.isNull()
    return F.when(team.isNotNull() & starts, 1).otherwise(0)


def per_game_marks(events: DataFrame) -> DataFrame:
    """Holder, previous holder and period, boundary flag and possession number.

    Clock peers share a holder, the team of the latest on-ball event up to and including the whole
    tick. So only the first row of a tick can start a possession, the holder before it is known by
    rows, and the running count by rows is already the same for all peers.
    """
    row = by_event()
    earlier = {
        "_n": F.row_number().over(row),
        "_holder": F.last("action_team", ignorenulls=True).over(before_here(row)),
        "_clock": F.lag("seconds_remaining").over(row),
        "_number": F.lag("event_seq").over(row),
        "prev_period": F.lag("period").over(row),
    }
    same_tick = F.col("period").eqNullSafe(F.col("prev_period")) & F.col(
        "seconds_remaining"
    ).eqNullSafe(F.col("_clock"))
    opens_tick = (F.col("_n") == 1) | ~same_tick
    on_ball = F.when(F.col("action_team").isNotNull(), F.col("_n"))
    holder = F.col("possession_team")
    return (
        events.withColumns(earlier)
        .withColumn("possession_team", F.max_by("action_team", on_ball).over(by_tick()))
        .withColumn("prev_possession_team", F.when(opens_tick, F.col("_holder")).otherwise(holder))
        .withColumn("is_new_possession", _starts_possession())
        .withColumn("possession_id_game", F.sum("is_new_possession").over(up_to_here(row)))
        .withColumn(
            "possession_id_game",
            in_order(F.col("possession_id_game"), same_tick & (F.col("event_seq") == F.col("_number"))),
        )
        .select(*events.columns, *MARKS)
    )


def _started(before: Column) -> Column:
    """How many possessions a segment starts, given the team that held the ball before it.

    Ticks after its first team are counted from within (``inner``). That first team starts one unless
    it goes on with the one before in the same period; ticks before it start one with each new period.
    """
    turned = F.coalesce(F.col("first_period") != F.col("_s_period"), F.lit(False))
    goes_on = (F.col("opener") == before) & ~F.col("opener_turned") & ~(F.col("opens") & turned)
    idle = F.col("idle") + F.when(turned & ~F.col("opens"), 1).otherwise(0)
    return (
        F.col("inner")
        + F.when(F.col("opener").isNotNull() & ~F.coalesce(goes_on, F.lit(False)), 1).otherwise(0)
        + F.when(before.isNotNull(), idle).otherwise(0)
    )


def _scan_ticks(ticks: DataFrame, events: DataFrame, scores: bool, marks: bool) -> DataFrame:
    """State of ticks (one row each) without a window over a whole game.

    Windows over the ticks of a segment tell what is known within it, segments are summarised, and
    windows over the segments of a game give each segment what came before it, the number of
    possessions included (see ``_started``). Periods never fall along the order, so the latest is the
    greatest.
    """
    ticks = with_segments(ticks.withColumns({c: F.col(f"_tick.{c}") for c in TICK}), events)
    in_game = before_here(Window.partitionBy("_seg.gameid").orderBy("_seg.n"))
    in_segment = Window.partitionBy("_seg").orderBy("_place")
    inside = before_here(in_segment)
    own: dict[str, Column] = {}
    totals: list[Column] = []
    carried: dict[str, Column] = {}
    if scores:
        own |= {f"_i_{c}": F.max(c).over(inside) for c in SCORES}
        totals += [F.max(c).alias(c) for c in SCORES]
        carried |= {f"_s_{c}": F.max(c).over(in_game) for c in SCORES}
    if marks:
        own |= {
            "_team": F.last("action_team", ignorenulls=True).over(inside),
            "_period": F.max("period").over(inside),
            "_first": F.row_number().over(in_segment) == 1,
        }
        team, held, first = F.col("action_team"), F.col("_team"), F.col("_first")
        turned = F.coalesce(F.col("period") != F.col("_period"), F.lit(False))
        on_ball = F.when(team.isNotNull(), F.col("_place"))
        totals += [
            F.max_by("action_team", on_ball).alias("action_team"),
            F.max("period").alias("period"),
            F.min_by("action_team", on_ball).alias("opener"),
            F.max(F.when(first, F.col("period"))).alias("first_period"),
            F.bool_or(first & team.isNotNull()).alias("opens"),
            F.bool_or(held.isNull() & team.isNotNull() & turned).alias("opener_turned"),
            F.count_if(held.isNotNull() & ((F.coalesce(team, held) != held) | turned)).alias("inner"),
            F.count_if(held.isNull() & team.isNull() & turned).alias("idle"),
        ]
        carried |= {
            "_s_team": F.last("action_team", ignorenulls=True).over(in_game),
            "_s_period": F.max("period").over(in_game),
        }
    seen = ticks.withColumns(own)
    segments = seen.groupBy("_seg").agg(*totals).withColumns(carried)
    if marks:
        before = F.sum(_started(F.col("_s_team"))).over(in_game)
        segments = segments.withColumn("_before", F.coalesce(before, F.lit(0)))
        carried |= {"_before": before}
    known = seen.join(segments.select("_seg", *carried), "_seg")
    if scores:
        known = known.withColumns({f"_t_{c}": F.greatest(f"_i_{c}", f"_s_{c}") for c in SCORES})
    if not marks:
        return known
    known = known.withColumns(
        {
            "prev_possession_team": F.coalesce("_team", "_s_team"),
            "prev_period": F.coalesce("_period", "_s_period"),
        }
    ).withColumn("possession_team", F.coalesce("action_team", "prev_possession_team"))
    flagged = known.withColumn("is_new_possession", _starts_possession())
    number = F.sum("is_new_possession").over(up_to_here(in_segment)) + F.col("_before")
    return flagged.withColumn("possession_id_game", number)


def split_scan(events: DataFrame, scores: bool = False, marks: bool = False) -> DataFrame:
    """Running scores and/or possession marks without a task that holds a whole game.

    Rows are summarised per chunk and chunks per tick, before any shuffle of rows. The state before
    a row is what earlier ticks of the game and earlier chunks of its tick left behind. No window
    holds all ticks of a game, see ``_scan_ticks``, and chunks of a tick are bounded by the number
    of rows over CHUNK_ROWS. The state joins the rows by chunk, so a tick that holds very many rows
    is spread as well.
    """
    rows = with_chunks(events)
    on_ball = F.when(F.col("action_team").isNotNull(), F.col("event_seq"))
    by_row: list[Column] = []
    merged: list[Column] = []
    if scores:
        by_row += [F.max(c).alias(c) for c in SCORES]
        merged += [F.max(c).alias(c) for c in SCORES]
    if marks:
        by_row += [
            F.max_by("action_team", on_ball).alias("action_team"),
            F.max(on_ball).alias("_on_ball"),
            F.min("event_seq").alias("event_seq"),
        ]
        merged += [
            F.max_by("action_team", "_on_ball").alias("action_team"),
            F.min("event_seq").alias("event_seq"),
        ]
    chunks = rows.groupBy("_tick", "_chunk").agg(*by_row)

    tick_state: list[Column] = []
    if scores:
        tick_state += [F.col(f"_t_{c}") for c in SCORES]
    if marks:
        # A tick's first event number stands for it.
        tick_state += [F.col("event_seq").alias("_first"), *map(F.col, MARKS)]
    ticks = _scan_ticks(chunks.groupBy("_tick").agg(*merged), events, scores, marks)
    ticks = ticks.select("_tick", *tick_state)

    chunk_state = ["_tick", "_chunk"]
    if scores:
        earlier_chunks = before_here(Window.partitionBy("_tick").orderBy("_chunk.slot"))
        chunks = chunks.withColumns({f"_c_{c}": F.max(c).over(earlier_chunks) for c in SCORES})
        chunk_state += [f"_c_{c}" for c in SCORES]
    state = chunks.select(*chunk_state).join(ticks, "_tick").drop("_tick")

    known = rows.join(state, "_chunk")
    in_chunk = Window.partitionBy("_chunk").orderBy("event_seq")
    known = known.withColumn("_number", F.lag("event_seq").over(in_chunk))
    clash = F.col("event_seq") == F.col("_number")
    if scores:
        inside = up_to_here(in_chunk)
        known = known.withColumns(
            {f"{c}_ff": F.greatest(F.max(c).over(inside), f"_c_{c}", f"_t_{c}") for c in SCORES}
        ).withColumns({c: in_order(F.col(c), clash) for c in RUNNING})
    if marks:
        opens = F.col("event_seq") == F.col("_first")
        own = {
            "prev_possession_team": F.col("possession_team"),
            "prev_period": F.col("period"),
            "is_new_possession": F.lit(0),
        }
        known = known.withColumns(
            {c: F.when(opens, F.col(c)).otherwise(inner) for c, inner in own.items()}
        ).withColumn("possession_id_game", in_order(F.col("possession_id_game"), clash))
    return known.select(*events.columns, *(RUNNING if scores else ()), *(MARKS if marks else ()))
