"""Shot classification and the shot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schema as S
from ..functions import events as E


def with_shot_zone(events: DataFrame) -> DataFrame:
    return events.withColumn("shot_zone", E.shot_zone())


def with_shot_outcome(zoned: DataFrame) -> DataFrame:
    """Value and flag follow from type and zone, so they need not travel through a shuffle."""
    return zoned.withColumns({"shot_value": E.shot_value(), "made_flag": E.made_flag()})


def classify_shots(events: DataFrame) -> DataFrame:
    return with_shot_outcome(with_shot_zone(events))


def build_fact_shots(classified: DataFrame) -> DataFrame:
    """One row per field-goal attempt. A filter and a projection: no shuffle."""
    shots = classified.filter(E.is_attempt()).withColumnRenamed("player", "shooter")
    return shots.select(*S.FACT_SCHEMAS["fact_shots"].fieldNames())
