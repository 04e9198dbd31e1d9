"""Filters shared by the serving queries. Values are literals, never spliced into SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .events import in_clutch_window

CLUTCH_MODES = ("all", "only", "exclude")


def seasons(df: DataFrame, start: int, end: int) -> DataFrame:
    """Inclusive season range, straight on the partition column so that directories are pruned."""
    return df.filter(F.col("season").between(start, end))


def clutch_rows(df: DataFrame, clutch: str | bool) -> DataFrame:
    """"all" pools both flags, "only" keeps clutch rows, "exclude" drops them.

    The booleans of a plain on/off switch are accepted too: False is "all", True is "only".
    """
    mode = {False: "all", True: "only"}.get(clutch, clutch) if isinstance(clutch, bool) else clutch
    if mode not in CLUTCH_MODES:
        raise ValueError(f"clutch must be one of {CLUTCH_MODES} or a bool, not {clutch!r}")
    if mode == "all":
        return df
    return df.filter(F.col("is_clutch") == (1 if mode == "only" else 0))


def clutch_window(df: DataFrame, enabled: bool, minutes: float, margin: float) -> DataFrame:
    """Clutch window chosen at query time, over raw shots."""
    return df.filter(in_clutch_window(minutes, margin)) if enabled else df


def team_is(teams: str | Iterable[str] | None) -> Column | None:
    """Predicate for one team, several teams, or None when nothing is chosen."""
    if not teams:
        return None
    if isinstance(teams, str):
        return F.col("team") == F.lit(teams)
    chosen = list(teams)
    return F.col("team").isin(*chosen) if chosen else None


def of_teams(df: DataFrame, teams: str | Iterable[str] | None) -> DataFrame:
    predicate = team_is(teams)
    return df if predicate is None else df.filter(predicate)
