"""Player metrics: raw counts by player, season and clutch flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import events as E


def _points(classified: DataFrame) -> Column:
    """Field goals by zone, free throws by text, or by the event points that hold the same."""
    if "points_scored_event" in classified.columns:
        free_throw = F.when(F.col("type") == S.FREE_THROW, F.col("points_scored_event"))
    else:
        free_throw = F.when(E.free_throw_made(), 1)
    return F.sum(E.shot_value() + F.coalesce(free_throw, F.lit(0)))


def build_fact_player_metrics(classified: DataFrame) -> DataFrame:
    """Counts over classified events. Players without a name are dropped before the aggregate."""
    made, attempt, three = E.is_made(), E.is_attempt(), E.is_three()
    named = classified.filter(F.col("player").isNotNull() & (F.col("player") != ""))
    return (
        named.groupBy("player", "season", "is_clutch")
        .agg(
            _points(classified).alias("pts"),
            F.count_if(attempt).alias("fga"),
            F.count_if(made).alias("fgm"),
            F.count_if(made & three).alias("fg3m"),
            F.count_if(three).alias("fg3a"),
            F.count_if(F.col("type") == S.FREE_THROW).alias("fta"),
            F.count_if(F.col("type") == S.TURNOVER).alias("tov"),
        )
        .select(*S.FACT_SCHEMAS["fact_player_metrics"].fieldNames())
    )
