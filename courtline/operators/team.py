"""Team metrics: offense, defense and shot counts by team, season and clutch flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S

KEYS = ("team", "season", "is_clutch")
OFFENSE, DEFENSE = "offense", "defense"


def team_offense(possessions: DataFrame) -> DataFrame:
    return possessions.groupBy(*KEYS).agg(
        F.count("possession_id").alias("total_possessions"),
        F.sum("points_scored").alias("points_scored"),
        F.count_distinct("gameid").alias("games_played"),
    )


def team_matchups(possessions: DataFrame) -> DataFrame:
    """(gameid, off_team, def_team) for the teams that met in a game.

    Distinct teams are taken before the join, so both sides have a few rows per game. Nothing else
    uses these pairs: defense is worked out from game totals below.
    """
    teams = possessions.select("gameid", "team").distinct()
    a, b = teams.alias("a"), teams.alias("b")
    met = (F.col("a.gameid") == F.col("b.gameid")) & (F.col("a.team") != F.col("b.team"))
    return a.join(b, met).select(
        F.col("a.gameid").alias("gameid"),
        F.col("a.team").alias("off_team"),
        F.col("b.team").alias("def_team"),
    )


def game_sides(possessions: DataFrame) -> DataFrame:
    """Per game, what each team adds to its offense and to its defense.

    A team defends the possessions of every other known team of its game, so its share is the
    game's total minus its own. Possessions of an unknown team, of a game without id and of a team
    without opponent are defended by nobody (team NULL). Possessions are summed per game and team
    first, so a game is a few rows by the time of the window, and no pairs are formed.
    """
    own = possessions.groupBy("gameid", "season", "team").agg(
        F.expr("count_if(is_clutch = 0) as n0"),
        F.expr("count_if(is_clutch = 1) as n1"),
        F.expr("coalesce(sum(points_scored) filter (where is_clutch = 0), 0) as p0"),
        F.expr("coalesce(sum(points_scored) filter (where is_clutch = 1), 0) as p1"),
    )
    game = Window.partitionBy("gameid", "season")
    totals = {
        f"all_{m}": F.sum(F.expr(f"if(team is not null, {m}, 0)")).over(game)
        for m in ("n0", "p0", "n1", "p1")
    }
    per_game = own.withColumns({**totals, "teams": F.count("team").over(game)}).withColumn(
        "opposed", F.expr("gameid is not null and team is not null and teams > 1")
    )
    return per_game.selectExpr(
        "season",
        f"""stack(4,
            '{OFFENSE}', team, 0, n0, p0, cast(gameid is not null as bigint),
            '{OFFENSE}', team, 1, n1, p1, cast(gameid is not null as bigint),
            '{DEFENSE}', if(opposed, team, null), 0,
                if(opposed, all_n0 - n0, n0), if(opposed, all_p0 - p0, p0), 0L,
            '{DEFENSE}', if(opposed, team, null), 1,
                if(opposed, all_n1 - n1, n1), if(opposed, all_p1 - p1, p1), 0L
        ) as (side, team, is_clutch, n, points, games)""",
    ).filter("n > 0")


def team_defense(possessions: DataFrame) -> DataFrame:
    return (
        game_sides(possessions)
        .filter(F.col("side") == DEFENSE)
        .groupBy(*KEYS)
        .agg(F.sum("n").alias("def_possessions"), F.sum("points").alias("points_allowed"))
    )


def offense_and_defense(possessions: DataFrame) -> DataFrame:
    """Full outer join of offense and defense on KEYS with missing numbers as 0, in one pass.

    Under a join NULL keys match nothing, so a group with a NULL key keeps its two sides apart.
    Filling numbers also turns a NULL season into 0, as it does for every other integer column.
    """
    unmatched = F.when(F.col("team").isNull() | F.col("season").isNull(), F.col("side"))
    offense, defense = F.col("side") == OFFENSE, F.col("side") == DEFENSE
    return (
        game_sides(possessions)
        .groupBy(*KEYS, unmatched.alias("unmatched"))
        .agg(
            F.sum(F.when(offense, F.col("n"))).alias("total_possessions"),
            F.sum(F.when(offense, F.col("points"))).alias("points_scored"),
            F.sum(F.when(offense, F.col("games"))).alias("games_played"),
            F.sum(F.when(defense, F.col("n"))).alias("def_possessions"),
            F.sum(F.when(defense, F.col("points"))).alias("points_allowed"),
        )
        .drop("unmatched")
        .fillna(0)
    )


def team_shot_counts(shots: DataFrame) -> DataFrame:
    zone = F.col("shot_zone")
    return shots.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_fga"),
        F.count_if(zone.isin(*S.THREE_ZONES)).alias("three_pt_attempts"),
        F.count_if(zone == S.RIM).alias("rim_attempts"),
        F.count_if(zone == S.MIDRANGE).alias("midrange_attempts"),
    )


def build_fact_team_metrics(possessions: DataFrame, shots: DataFrame) -> DataFrame:
    """Raw counts per team, season and clutch flag.

    ``possessions`` carries season. Both sides of the join are aggregates of a few rows per team
    and season, so its strategy is left to the optimizer.
    """
    return (
        offense_and_defense(possessions)
        .join(team_shot_counts(shots), list(KEYS), "left")
        .fillna(0)
        .select(*S.FACT_SCHEMAS["fact_team_metrics"].fieldNames())
    )
