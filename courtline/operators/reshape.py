"""Frames behind the charts: long series, averages, samples, density grids, profiles, eras."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import ratios as R

SHOT_RATES = ("rim_rate", "midrange_rate", "three_point_rate")
EFFICIENCY = {"TS_pct": "TS%", "eFG_pct": "eFG%", "three_point_efficiency": "3PT%"}


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- team frames -----------------------------------------------------------------------------


def team_averages(evolution: DataFrame) -> DataFrame:
    """Mean over seasons of every rate, per team; rows without team are left out."""
    return (
        evolution.filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(*(F.avg(c).alias(c) for c in ("season", *R.TEAM_RATES)))
    )


def efficiency_table(averages: DataFrame) -> DataFrame:
    """Display form: one decimal for pace and ratings, two for shares, season hidden."""
    digits = {c: 2 if c.endswith("rate") else 1 for c in R.TEAM_RATES}
    return averages.select("team", *(F.round(c, d).alias(c) for c, d in digits.items()))


def ratings_scatter(averages: DataFrame) -> DataFrame:
    """Offensive against defensive rating, point size = pace."""
    return averages.select("team", "ORtg", "DRtg", F.col("pace").alias("size"))


def shot_distribution_long(league: DataFrame) -> DataFrame:
    """(season, Shot Zone, Rate), one row per season and share."""
    return league.select("season", *SHOT_RATES).unpivot(
        ["season"], list(SHOT_RATES), "Shot Zone", "Rate"
    )


def pace_series(league: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """(season, series, pace): the league line, then one line per chosen team.

    A single team is labelled "Team Pace"; several carry their own names. Rows without a team
    draw no line.
    """
    base = league.select("season", F.lit("League Average").alias("series"), "pace")
    if teams is None:
        return base
    named = teams.filter(F.col("team").isNotNull())
    several = named.agg(F.min("team") != F.max("team")).scalar()
    name = F.when(several, F.col("team")).otherwise(F.lit("Team Pace"))
    return base.unionByName(named.select("season", name.alias("series"), "pace"))


def league_average_label(league: DataFrame) -> DataFrame:
    return league.withColumn("team", F.lit("League Average"))


def offensive_radar(evolution: DataFrame) -> DataFrame:
    """(team, position, theta, r): mean of five rates scaled to [0, 1], first point repeated."""
    named = evolution if "team" in evolution.columns else evolution.withColumn("team", F.lit("Average"))
    means = (
        named.filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(*(F.avg(c).alias(c) for c in S.RADAR_AXES))
    )
    axes = [*S.RADAR_AXES.items(), next(iter(S.RADAR_AXES.items()))]
    points = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label).alias("theta"),
            # A missing mean is drawn at the centre; least and greatest alone would skip the NULL.
            F.greatest(
                F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col(c) / F.lit(top), F.lit(0.0)))
            ).alias("r"),
        )
        for i, (c, (label, top)) in enumerate(axes)
    ]
    return means.select("team", F.explode(F.array(*points)).alias("p")).select("team", "p.*")


# ---- player frames ---------------------------------------------------------------------------


def career_efficiency(player: DataFrame, league: DataFrame | None = None) -> DataFrame:
    """(season, series, value): TS% and eFG% of the player, then of the league."""

    def long(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            "season", F.col("TS_pct").alias(f"{prefix}TS%"), F.col("eFG_pct").alias(f"{prefix}eFG%")
        ).unpivot(["season"], [f"{prefix}TS%", f"{prefix}eFG%"], "series", "value")

    frames = [long(player, "")] + ([] if league is None else [long(league, "League ")])
    return _stack(frames)


def latest_efficiency(player: DataFrame, league: DataFrame) -> DataFrame:
    """Latest season of the player and, on its own, of the league (they may differ)."""

    def latest(df: DataFrame, label: str) -> DataFrame:
        row = F.max_by(F.struct("season", *EFFICIENCY), "season").alias("row")
        return df.groupBy(F.lit(label).alias("series")).agg(row).select("series", "row.*")

    return _stack([latest(player, "Player"), latest(league, "League Avg")])


def efficiency_compare(latest: DataFrame) -> DataFrame:
    """(metric, player, league, delta, labels): percent text of both and the difference.

    A player without rows gives no bars, like an empty chart; a league without rows gives a
    player's bars alone, its own and the difference being NULL.
    """
    league = F.count_if(F.col("series") == "League Avg") > 0

    def of(series: str, column: str) -> Column:
        return F.max(F.when(F.col("series") == series, F.col(column)))

    bars = [
        F.struct(
            F.lit(label).alias("metric"),
            F.coalesce(of("Player", c), F.lit(0.0)).alias("player"),
            F.when(league, F.coalesce(of("League Avg", c), F.lit(0.0))).alias("league"),
        )
        for c, label in EFFICIENCY.items()
    ]
    present = F.count_if(F.col("series") == "Player") > 0
    wide = latest.agg(F.array(*bars).alias("bars"), present.alias("present"))
    rows = wide.filter("present").select(F.explode("bars").alias("b")).select("b.*")

    def percent(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.format_string("%.1f%%", F.col(c) * 100.0))

    return rows.withColumns(
        {
            "delta": F.col("player") - F.col("league"),
            "player_label": percent("player"),
            "league_label": percent("league"),
        }
    )


def shot_profile_long(profile: DataFrame) -> DataFrame:
    """(season, zone, rate) with the display names of the stacked bars."""
    return profile.select(
        "season",
        F.col("rim_rate").alias("Rim"),
        F.col("midrange_rate").alias("Midrange"),
        F.col("three_point_rate").alias("3PT"),
    ).unpivot(["season"], ["Rim", "Midrange", "3PT"], "zone", "rate")


# ---- shot charts -----------------------------------------------------------------------------


def shots_by_result(points: DataFrame, result: str = "All") -> DataFrame:
    """All, Made or Missed shots, with the result as text."""
    wanted = {"All": None, "Made": 1, "Missed": 0}[result]
    kept = points if wanted is None else points.filter(F.col("made_flag") == wanted)
    label = F.when(F.col("made_flag") == 1, "Made").otherwise("Missed")
    return kept.withColumn("Result", label)


def sample_points(
    points: DataFrame, n: int = S.SAMPLE_POINTS, seed: int = S.SAMPLE_SEED
) -> DataFrame:
    """Uniform sample of exactly ``n`` rows, or all rows when there are no more than that.

    The draw is an MD5 of the row's text and the seed, so any engine can repeat it and partitions do
    not matter. Equal rows are
    counted before the shuffle, and each of the ``c`` copies of a row draws an exponential key:
    the j-th smallest of c such keys is a sum of independent draws over c, c-1, .. . The n smallest
    keys overall make the sample. They lie in the n rows with the smallest first key, so only
    those are expanded, each into at most n copies.
    """
    columns = points.columns

    def draw(number: Column) -> Column:
        values = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)
        text = F.concat_ws("|", F.lit(str(seed)), *values, number.cast("string"))
        bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
        return -F.log((bits + 0.5) / F.lit(float(2**52)))

    counted = points.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    first = counted.withColumn("_key", draw(F.lit(1)) / F.col("_copies"))
    chosen = first.orderBy("_key", *columns).limit(n).drop("_key")
    copies = chosen.withColumn(
        "_j", F.explode(F.sequence(F.lit(1), F.least(F.col("_copies"), F.lit(n)).cast("int")))
    )
    row = F.struct(*columns)
    earlier = Window.partitionBy(row).orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    step = draw(F.col("_j")) / (F.col("_copies") - F.col("_j") + 1)
    keyed = copies.withColumn("_step", step).withColumn("_key", F.sum("_step").over(earlier))
    return keyed.orderBy("_key", *columns).limit(n).select(*columns)


def _cells(placed: DataFrame, edge: dict[str, Column], bins: int) -> DataFrame:
    def cell(axis: str) -> Column:
        low, high = edge[f"lo_{axis}"], edge[f"hi_{axis}"]
        pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
        slot = F.floor((F.col(axis) - (low - pad)) / ((high + pad) - (low - pad)) * F.lit(bins))
        return F.least(slot, F.lit(bins - 1)).cast("int")

    return placed.withColumns({"x_bin": cell("x"), "y_bin": cell("y")})


def _edges() -> dict[str, Column]:
    return {f"{name}_{a}": f(a) for a in "xy" for name, f in (("lo", F.min), ("hi", F.max))}


def _placed(points: DataFrame) -> DataFrame:
    return points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def density_grid(points: DataFrame, bins: int = S.GRID_BINS) -> DataFrame:
    """Add ``Density``: how many points share the cell of an equal-width grid over the data.

    The last edge belongs to the last cell; a range of zero width is widened by 0.5 both ways;
    rows without coordinates are left out. Points are counted per place before the shuffle, once: edges
    and counts are read from the same exchange of places, as both ask for all of its columns. How the
    counts, bins x bins rows at most, are joined to the rows is left to adaptive execution.
    """
    placed = _placed(points)
    places = placed.groupBy("x", "y").agg(F.count(F.lit(1)).alias("_n"))
    bounds = {**_edges(), "points": F.sum("_n")}
    edges = places.agg(F.struct(*(c.alias(n) for n, c in bounds.items())).alias("e")).scalar()

    def binned(rows: DataFrame) -> DataFrame:
        known = {n: F.col(f"_e.{n}") for n in _edges()}
        return _cells(rows.withColumn("_e", edges), known, bins).drop("_e")

    counts = binned(places).groupBy("x_bin", "y_bin").agg(F.sum("_n").alias("Density"))
    return binned(placed).join(counts, ["x_bin", "y_bin"]).select(
        *points.columns, "x_bin", "y_bin", "Density"
    )


def shot_chart(points: DataFrame, result: str = "All", n: int = S.SAMPLE_POINTS) -> DataFrame:
    """Filter, then sample, then density on the sample.

    The sample has at most ``n`` rows and lies in one task already, so its density is two windows
    over those rows, with the same cells as ``density_grid``.
    """
    kept = shots_by_result(points, result)
    sample = _placed(shots_by_result(sample_points(kept.drop("Result"), n)))
    whole, cell = Window.partitionBy(F.lit(0)), Window.partitionBy("x_bin", "y_bin")
    edges = {f"_{name}": c.over(whole) for name, c in _edges().items()}
    binned = _cells(
        sample.withColumns(edges), {name: F.col(f"_{name}") for name in _edges()}, S.GRID_BINS
    )
    return binned.drop(*edges).withColumn("Density", F.count(F.lit(1)).over(cell))


# ---- eras ------------------------------------------------------------------------------------


def era_range(era: str) -> tuple[int, int]:
    """First and last season of a named era, with or without the seasons behind the name."""
    for name, (first, last) in S.ERAS.items():
        if era in (name, f"{name} ({first}-{last})"):
            return first, last
    raise ValueError(f"unknown era {era!r}; known: {', '.join(S.ERAS)}")


def era_league_summary(team_metrics: DataFrame) -> DataFrame:
    """Pooled pace and ratings per era. A season may belong to several eras.

    The few eras are constants, so each row names its own and no join is needed. Rows are summed
    per season first, which keeps the expansion tiny.
    """
    sums = ("total_possessions", "points_scored", "def_possessions", "points_allowed")
    per_season = team_metrics.groupBy("season").agg(
        *(F.sum(c).alias(c) for c in sums), F.max("games_played").alias("games_played")
    )
    names = [
        F.when(F.col("season").between(first, last), F.lit(name))
        for name, (first, last) in S.ERAS.items()
    ]
    return (
        per_season.withColumn("era", F.explode(F.array_compact(F.array(*names))))
        .groupBy("era")
        .agg(
            F.min("season").alias("first_season"),
            F.max("season").alias("last_season"),
            *R.rates(R.TEAM_RATES, "pace", "ORtg", "DRtg"),
        )
    )
