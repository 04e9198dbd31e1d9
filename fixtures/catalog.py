"""Registered queries: for every operator a DataFrame callable and, where SQL can say it, the
DuckDB statement to compare with.

Operators run on frames derived lazily from the whole ``events`` table. Serving queries read the
fact tables, which the pipeline writes once per session and data folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import schema as S
from courtline.operators import adhoc, clean, possessions, reshape, serving, shots, team
from courtline.operators.game_order import profile_games
from courtline.plans import pages, pipeline
from courtline.plans.staging import Staging
from courtline.sources.event_files import ranked_events
from courtline.sources.fact_store import FactStore

from . import oracle as O
from .pbp import read_pbp

FIRST, LAST = 2015, 2024
TEAMS = ["T1", "T4"]
TEAM, PLAYER = "T1", "P. Player3"
# Events of one CSV file of the feed, which one task sorts.
FILE_ROWS = 250_000


@dataclass
class Frames:
    """Frames of one data folder, built on first use."""

    spark: SparkSession
    sf_dir: str
    _store: FactStore | None = field(default=None, repr=False)
    _csv_store: FactStore | None = field(default=None, repr=False)
    _stagings: list[Staging] = field(default_factory=list, repr=False)

    @cached_property
    def events(self) -> DataFrame:
        return read_pbp(self.spark, self.sf_dir)

    @cached_property
    def profile(self):
        return profile_games(self.events)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean.clean_events(self.events, self.profile)

    @cached_property
    def classified(self) -> DataFrame:
        return shots.classify_shots(self.cleaned)

    @cached_property
    def marked(self) -> DataFrame:
        return possessions.reconstruct_possessions(self.classified, self.profile)

    @cached_property
    def facts(self) -> dict[str, DataFrame]:
        return pipeline.fact_frames(self.events, self.profile)

    def staging(self) -> Staging:
        """Tables that go with ``release``."""
        self._stagings.append(Staging(self.spark))
        return self._stagings[-1]

    def folder(self) -> str:
        """A folder that goes with ``release``."""
        return self.staging().root

    def release(self) -> None:
        """Drop whatever was written for these frames; they write it again when asked."""
        while self._stagings:
            self._stagings.pop().drop()
        self._store = self._csv_store = None

    @property
    def store(self) -> FactStore:
        if self._store is None:
            root = self.folder()
            pipeline.run_pipeline(self.spark, self.events, root)
            self._store = FactStore(self.spark, root)
        return self._store

    def csv_files(self) -> str:
        """The feed as three CSV files or, of large feeds, as many as keep FILE_ROWS each, events in their order."""
        root = f"{self.folder()}/feed"
        files = max(3, -(-self.events.count() // FILE_ROWS))
        ordered = self.events.repartitionByRange(files, "event_seq").sortWithinPartitions("event_seq")
        ordered.select(*_RAW).write.option("header", True).csv(root)
        return root

    @property
    def csv_store(self) -> FactStore:
        """Facts from CSV files, as users build them."""
        if self._csv_store is None:
            root = self.folder()
            pipeline.run_pipeline(self.spark, f"{self.csv_files()}/*.csv", root)
            self._csv_store = FactStore(self.spark, root)
        return self._csv_store

    def read(self, table: str) -> DataFrame:
        return self.store.read(table)

    @property
    def team_metrics(self) -> DataFrame:
        return self.read("fact_team_metrics")

    @property
    def player_metrics(self) -> DataFrame:
        return self.read("fact_player_metrics")

    @property
    def shots(self) -> DataFrame:
        return self.read("fact_shots")


_FRAMES: dict[tuple[str, str], Frames] = {}


def frames(spark: SparkSession, sf_dir: str) -> Frames:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FRAMES:
        _FRAMES[key] = Frames(spark, sf_dir)
    return _FRAMES[key]


Query = Callable[[Frames], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, run: Query, oracle: str | None = None) -> None:
    QUERIES[key] = run
    if oracle is not None:
        ORACLES[key] = oracle


def columns(names: str) -> list[str]:
    return names.replace(",", " ").split()


# ---- sources and sinks -----------------------------------------------------------------------

_RAW = S.RAW_EVENTS.fieldNames()
# An empty CSV field is NULL, so '' does not survive the text file.
_RAW_FROM_CSV = ", ".join(
    "nullif(player, '') as player" if c == "player" else f'"{c}"' for c in _RAW
)


def _csv_round_trip(f: Frames) -> DataFrame:
    """The 16 columns and the rank of each event's place: files in order, rows in order."""
    return ranked_events(f.spark, f"{f.csv_files()}/*.csv")


register(
    "src_csv_scan",
    _csv_round_trip,
    O.sql(
        f"select {_RAW_FROM_CSV}, row_number() over (order by event_seq)::integer as event_rank from pbp",
        upto="pbp",
    ),
)


def _sink_round_trip(f: Frames) -> DataFrame:
    store = FactStore(f.spark, f.folder())
    store.write("fact_possessions", f.facts["fact_possessions"])
    return store.read("fact_possessions")


_POSS = (
    "possession_id, gameid, team, possession_length, points_scored, is_clutch, possession_result"
)
register("sink_partitioned_roundtrip", _sink_round_trip, O.sql(f"select {_POSS}, season from pws", upto="pws"))
register(
    "possessions_with_season",
    lambda f: possessions.possessions_with_season(
        possessions.build_fact_possessions(f.marked), possessions.game_season_dim(f.events)
    ),
    O.sql(f"select {_POSS}, season from pws", upto="pws"),
)
register(
    "pipeline_end_to_end",
    lambda f: pipeline.table_counts(f.store),
    O.sql(
        """select 'fact_shots' as table_name, count(*) as n_rows from shots
        union all select 'fact_possessions', count(*) from pws
        union all select 'fact_team_metrics', count(*) from tm
        union all select 'fact_player_metrics', count(*) from pm""",
        upto="pm",
    ),
)

register(
    "pipeline_csv_team_metrics",
    lambda f: f.csv_store.read("fact_team_metrics"),
    O.sql("select * from tm", upto="tm"),
)
register(
    "pipeline_csv_possessions",
    lambda f: f.csv_store.read("fact_possessions"),
    O.sql(f"select {_POSS}, season from pws", upto="pws"),
)

# ---- cleaning --------------------------------------------------------------------------------


def _event_columns(key: str, frame: Callable[[Frames], DataFrame], names: str, sql_columns: str, upto: str) -> None:
    register(
        key,
        lambda f: frame(f).select("gameid", "event_seq", *columns(names)),
        O.sql(f"select gameid, event_seq, {sql_columns} from {upto}", upto=upto),
    )


def _cleaned(f: Frames) -> DataFrame:
    return f.cleaned


_event_columns("clean_coordinates", _cleaned, "x y", "x, y", "timed")
_event_columns("clean_clock_seconds", _cleaned, "seconds_remaining", "secs as seconds_remaining", "timed")
_event_columns("clean_score_ffill", _cleaned, "h_pts_ff a_pts_ff", "h_ff as h_pts_ff, a_ff as a_pts_ff", "scored")
_event_columns("clean_score_margin", _cleaned, "score_margin", "margin as score_margin", "ev")
_event_columns("clean_assister", _cleaned, "assister", "assister", "timed")
_event_columns("clean_clutch_flag", _cleaned, "is_clutch", "is_clutch", "ev")

# ---- shots -----------------------------------------------------------------------------------

for _key, _column in (
    ("shot_zone", "shot_zone"),
    ("shot_value", "shot_value"),
    ("shot_made_flag", "made_flag"),
):
    _event_columns(_key, lambda f: f.classified, _column, _column, "ev")

register("fact_shots", lambda f: f.facts["fact_shots"], O.sql("select * from shots", upto="shots"))

# ---- possessions -----------------------------------------------------------------------------


def _marked(f: Frames) -> DataFrame:
    return f.marked


_event_columns("poss_action_team", _marked, "action_team", "action_team", "ev")
_event_columns("poss_team_ffill", _marked, "possession_team", "possession_team", "held")
_event_columns(
    "poss_boundary_flag",
    _marked,
    "prev_possession_team prev_period is_new_possession",
    "prev_team as prev_possession_team, prev_period, is_new as is_new_possession",
    "flagged",
)
_event_columns(
    "poss_segment_id",
    _marked,
    "possession_id_game possession_id",
    "seg as possession_id_game, possession_id",
    "segmented",
)


def _all_split(f: Frames) -> DataFrame:
    """Every game through the plan for oversized games; ids and scored events are staged, as the
    pipeline does with ids and rows, so neither is computed again wherever the plan reads it."""
    staging = f.staging()
    profile = profile_games(f.events, hot_rows=0, keep=lambda ids: staging.keep(ids, "ids"))
    cleaned = staging.keep(clean.clean_events(f.events, profile), "cleaned")
    return possessions.reconstruct_possessions(cleaned, profile)


_event_columns(
    "possessions_split_plan",
    _all_split,
    "h_pts_ff a_pts_ff prev_possession_team prev_period is_new_possession possession_id_game possession_id",
    "h_ff as h_pts_ff, a_ff as a_pts_ff, prev_team as prev_possession_team, prev_period,"
    " is_new as is_new_possession, seg as possession_id_game, possession_id",
    "segmented",
)
_event_columns("poss_event_points", _marked, "points_scored_event", "pts_event as points_scored_event", "ev")
register(
    "fact_possessions",
    lambda f: possessions.build_fact_possessions(f.marked),
    O.sql(f"select {_POSS} from poss", upto="poss"),
)
register(
    "poss_result_distribution",
    lambda f: f.facts["fact_possessions"]
    .groupBy("possession_result")
    .agg(F.count(F.lit(1)).alias("n"), F.sum("points_scored").alias("points")),
    O.sql(
        "select possession_result, count(*) as n, sum(points_scored)::bigint as points"
        " from poss group by 1",
        upto="poss",
    ),
)

# ---- team and player metrics -----------------------------------------------------------------

register(
    "game_season_dim",
    lambda f: possessions.game_season_dim(f.events),
    O.sql("select * from game_season", upto="game_season"),
)


def _of_possessions(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda f: operator(f.facts["fact_possessions"])


for _key, _operator, _cte in (
    ("team_offense", team.team_offense, "offense"),
    ("team_matchups", team.team_matchups, "matchups"),
    ("team_defense", team.team_defense, "defense"),
    ("team_off_def_outer", team.offense_and_defense, "both_sides"),
):
    register(_key, _of_possessions(_operator), O.sql(f"select * from {_cte}", upto=_cte))
register(
    "team_shot_counts",
    lambda f: team.team_shot_counts(f.facts["fact_shots"]),
    O.sql("select * from shot_counts", upto="shot_counts"),
)
register(
    "fact_team_metrics",
    lambda f: f.facts["fact_team_metrics"],
    O.sql("select * from tm", upto="tm"),
)
register(
    "fact_player_metrics",
    lambda f: f.facts["fact_player_metrics"],
    O.sql("select * from pm", upto="pm"),
)

# ---- serving ---------------------------------------------------------------------------------

_IN_TEAMS = "team in (" + ", ".join(f"'{t}'" for t in TEAMS) + ")"
_SEASONS = f"season between {FIRST} and {LAST}"


def _team_sql(where: str = "true", keys: str = "season, team") -> str:
    return f"select {keys}, {O.team_rates()} from tm where {_SEASONS} and {where} group by {keys}"


def _player_sql(where: str = "true") -> str:
    return f"select season, {O.PLAYER_RATES} from pm where {_SEASONS} and {where} group by season"


def _profile_sql(where: str = "true") -> str:
    return (
        f"select season, {O.ZONE_RATES} from shots where {_SEASONS} and shooter = '{PLAYER}'"
        f" and {where} group by season"
    )


_LATE = "period >= 4 and seconds_remaining <= {0} and score_margin >= -{1} and score_margin <= {1}"

register(
    "team_evolution",
    lambda f: serving.team_evolution(f.team_metrics, FIRST, LAST),
    O.sql(_team_sql(), upto="tm"),
)
register(
    "team_evolution_clutch",
    lambda f: serving.team_evolution(f.team_metrics, FIRST, LAST, "only", TEAMS),
    O.sql(_team_sql(f"is_clutch = 1 and {_IN_TEAMS}"), upto="tm"),
)
register(
    "league_evolution",
    lambda f: serving.league_evolution(f.team_metrics, FIRST, LAST),
    O.sql(_team_sql(keys="season"), upto="tm"),
)
register(
    "league_evolution_subset",
    lambda f: serving.league_evolution(f.team_metrics, FIRST, LAST, teams=TEAMS),
    O.sql(_team_sql(_IN_TEAMS, "season"), upto="tm"),
)
register(
    "player_stats",
    lambda f: serving.player_stats(f.player_metrics, PLAYER, FIRST, LAST),
    O.sql(_player_sql(f"player = '{PLAYER}'"), upto="pm"),
)
register(
    "league_player_stats",
    lambda f: serving.league_player_stats(f.player_metrics, FIRST, LAST),
    O.sql(_player_sql(), upto="pm"),
)
register(
    "team_shot_points",
    lambda f: serving.team_shot_points(f.shots, TEAMS, FIRST, LAST),
    O.sql(
        f"select x, y, made_flag, shot_zone, team from shots where {_SEASONS} and {_IN_TEAMS}",
        upto="shots",
    ),
)
register(
    "clutch_dynamic_window",
    lambda f: serving.team_shot_points(f.shots, None, FIRST, LAST, True, 8, 3),
    O.sql(
        "select x, y, made_flag, shot_zone, team from shots"
        f" where {_SEASONS} and {_LATE.format(8 * 60, 3)}",
        upto="shots",
    ),
)
register(
    "player_shot_points",
    lambda f: serving.player_shot_points(f.shots, PLAYER, FIRST, LAST),
    O.sql(
        "select x, y, made_flag, shot_zone from shots"
        f" where {_SEASONS} and shooter = '{PLAYER}'",
        upto="shots",
    ),
)
register(
    "player_shot_profile",
    lambda f: serving.player_shot_profile(f.shots, PLAYER, FIRST, LAST),
    O.sql(_profile_sql(), upto="shots"),
)
register(
    "all_teams",
    lambda f: serving.all_teams(f.team_metrics),
    O.sql("select distinct team from tm where team is not null", upto="tm"),
)
register(
    "all_players",
    lambda f: serving.all_players(f.player_metrics),
    O.sql("select distinct player from pm where player is not null", upto="pm"),
)

# ---- ad-hoc reports --------------------------------------------------------------------------



def _some_of(part: DataFrame, whole: DataFrame) -> DataFrame:
    """(n_rows, n_unknown): rows of an unordered limit, and how many of them are not in the table."""
    unknown = part.exceptAll(whole).agg(F.count(F.lit(1))).scalar()
    return part.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_unknown", unknown)


def _some_sql(table: str, n: int, where: str = "true") -> str:
    return O.sql(
        f"select least(count(*), {n})::bigint as n_rows, 0::bigint as n_unknown from {table} where {where}",
        upto=table,
    )


register("preview_shots", lambda f: _some_of(adhoc.preview(f.shots), f.shots), _some_sql("shots", 100))
register(
    "preview_possessions",
    lambda f: _some_of(adhoc.preview(f.read("fact_possessions")), f.read("fact_possessions")),
    _some_sql("pws", 100),
)
register(
    "topk_team_seasons",
    lambda f: adhoc.top_team_seasons(f.team_metrics),
    O.sql(
        """select * from tm order by season desc, total_possessions desc, team nulls last,
        is_clutch, points_scored, def_possessions, points_allowed, total_fga limit 100""",
        upto="tm",
    ),
)
register(
    "topk_player_seasons",
    lambda f: adhoc.top_player_seasons(f.player_metrics),
    O.sql("select * from pm order by season desc, pts desc, player, is_clutch limit 100", upto="pm"),
)
register(
    "player_true_shooting",
    lambda f: adhoc.player_true_shooting(f.player_metrics, "%Player1%"),
    O.sql(
        """select player, season, pts, fga, fta, round(cast(pts as double)
          / nullif(2.0::double * (fga + 0.44::double * fta), 0), 3) as true_shooting_pct
        from pm where player like '%Player1%' and is_clutch = 0
        order by season desc, player limit 10""",
        upto="pm",
    ),
)
register(
    "team_ratings_latest",
    lambda f: adhoc.team_ratings_latest(f.team_metrics, TEAM),
    O.sql(
        f"""select season, team, total_possessions, points_scored,
          round(points_scored * 100.0::double / nullif(total_possessions, 0), 1)
            as offensive_rating,
          round(total_possessions * 48.0::double / nullif(games_played * 48.0::double, 0), 1)
            as pace
        from tm where team = '{TEAM}' and is_clutch = 0 order by season desc limit 10""",
        upto="tm",
    ),
)
register(
    "league_three_point_era",
    lambda f: adhoc.league_three_point_era(f.team_metrics),
    O.sql(
        """select season, sum(three_pt_attempts)::bigint as total_3pt_attempts,
          sum(midrange_attempts)::bigint as total_midrange_attempts,
          round(sum(three_pt_attempts)::double * 100 / nullif(sum(total_fga)::double, 0), 1)
            as three_pt_pct_of_offense
        from tm where is_clutch = 0 group by season""",
        upto="tm",
    ),
)
_EVOLUTION_REGULAR = O.sql(
    "select * exclude (rim_rate) from ("
    + _team_sql(f"is_clutch = 0 and team = '{TEAM}'")
    + ")",
    upto="tm",
)
register(
    "team_evolution_regular",
    lambda f: adhoc.team_evolution_regular(f.team_metrics, TEAM, FIRST, LAST),
    _EVOLUTION_REGULAR,
)
register(
    "player_stats_regular",
    lambda f: adhoc.player_stats_regular(f.player_metrics, PLAYER, FIRST, LAST),
    O.sql(_player_sql(f"player = '{PLAYER}' and is_clutch = 0"), upto="pm"),
)
register(
    "shot_points_limited",
    lambda f: _some_of(
        adhoc.shot_points_limited(f.shots, 2020, TEAM), serving.team_shot_points(f.shots, TEAM, 2020, 2020)
    ),
    _some_sql("shots", 5000, f"season = 2020 and team = '{TEAM}' and is_clutch = 0"),
)
register(
    "player_shot_profile_regular",
    lambda f: adhoc.player_shot_profile_regular(f.shots, PLAYER, FIRST, LAST),
    O.sql(_profile_sql("is_clutch = 0"), upto="shots"),
)
register(
    "league_baseline",
    lambda f: adhoc.league_baseline(f.team_metrics, FIRST, LAST),
    O.sql(
        f'select season, pace, "ORtg" from ({_team_sql("is_clutch = 0", "season")})', upto="tm"
    ),
)

# ---- frames behind charts --------------------------------------------------------------------
# Means of ratios are summed in a different order by the two engines: compare six decimals.


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*(F.round(c, digits).alias(c) if c in doubles else c for c in df.columns))


_TEAM_EVO = ("evo", _team_sql())
_LEAGUE_EVO = ("league", _team_sql(keys="season"))
_PICKED_EVO = ("picked", _team_sql(_IN_TEAMS))
_PLAYER_EVO = ("player_evo", _player_sql(f"player = '{PLAYER}'"))
_LEAGUE_PLAYERS = ("league_evo", _player_sql())


def _team_averages(f: Frames) -> DataFrame:
    return reshape.team_averages(serving.team_evolution(f.team_metrics, FIRST, LAST, ordered=False))


def _league(f: Frames) -> DataFrame:
    return serving.league_evolution(f.team_metrics, FIRST, LAST, ordered=False)


def _player_pair(f: Frames) -> tuple[DataFrame, DataFrame]:
    return (
        serving.player_stats(f.player_metrics, PLAYER, FIRST, LAST, ordered=False),
        serving.league_player_stats(f.player_metrics, FIRST, LAST, ordered=False),
    )


_RATE_NAMES = ("pace", '"ORtg"', '"DRtg"', "three_point_rate", "rim_rate", "midrange_rate")
register(
    "team_efficiency_table",
    lambda f: _rounded(_team_averages(f)),
    O.sql(
        "select team, round(avg(season), 6) as season, "
        + ", ".join(f"round(avg({c}), 6) as {c}" for c in _RATE_NAMES)
        + " from evo where team is not null group by team",
        _TEAM_EVO,
        upto="tm",
    ),
)
register(
    "efficiency_table",
    lambda f: reshape.efficiency_table(_team_averages(f)),
    O.sql(
        "select team, "
        + ", ".join(f"round(avg({c}), {2 if c.endswith('rate') else 1}) as {c}" for c in _RATE_NAMES)
        + " from evo where team is not null group by team",
        _TEAM_EVO,
        upto="tm",
    ),
)
register(
    "ortg_drtg_points",
    lambda f: _rounded(reshape.ratings_scatter(_team_averages(f))),
    O.sql(
        """select team, round(avg("ORtg"), 6) as "ORtg", round(avg("DRtg"), 6) as "DRtg",
        round(avg(pace), 6) as size from evo where team is not null group by team""",
        _TEAM_EVO,
        upto="tm",
    ),
)
register(
    "shots_by_result",
    lambda f: reshape.shots_by_result(serving.team_shot_points(f.shots, None, FIRST, LAST), "Made"),
    O.sql(
        f"""select x, y, made_flag, shot_zone, team, 'Made' as "Result" from shots
        where {_SEASONS} and made_flag = 1""",
        upto="shots",
    ),
)
register(
    "shots_by_result_missed",
    lambda f: reshape.shots_by_result(serving.team_shot_points(f.shots, None, FIRST, LAST), "Missed"),
    O.sql(
        f"""select x, y, made_flag, shot_zone, team, 'Missed' as "Result" from shots
        where {_SEASONS} and made_flag = 0""",
        upto="shots",
    ),
)
register(
    "shots_by_result_all",
    lambda f: reshape.shots_by_result(serving.team_shot_points(f.shots, None, FIRST, LAST)),
    O.sql(
        f"""select x, y, made_flag, shot_zone, team,
        case when made_flag = 1 then 'Made' else 'Missed' end as "Result" from shots where {_SEASONS}""",
        upto="shots",
    ),
)
register(
    "shot_distribution_long",
    lambda f: reshape.shot_distribution_long(_league(f)),
    O.sql(
        " union all ".join(
            f"""select season, '{c}' as "Shot Zone", {c} as "Rate" from league"""
            for c in ("rim_rate", "midrange_rate", "three_point_rate")
        ),
        _LEAGUE_EVO,
        upto="tm",
    ),
)
register(
    "pace_series",
    lambda f: reshape.pace_series(
        _league(f), serving.team_evolution(f.team_metrics, FIRST, LAST, teams=TEAMS, ordered=False)
    ),
    O.sql(
        "select season, 'League Average' as series, pace from league"
        " union all select season, team, pace from picked",
        _LEAGUE_EVO,
        _PICKED_EVO,
        upto="tm",
    ),
)
_CELL = (
    "least(floor(({0} - lo_{0}) / (hi_{0} - lo_{0}) * 25), 24)::integer as {0}_bin"
)
# The sample: an MD5 of row, seed and number of the copy gives each copy's place in the draw.
_POINT = "x, y, made_flag, shot_zone, team"
_TEXT = "concat_ws('|', '{seed}', {values}, {j})".format(
    seed=S.SAMPLE_SEED,
    values=", ".join(f"coalesce(cast({c} as varchar), '')" for c in _POINT.split(", ")),
    j="cast(j as varchar)",
)
_DRAW = f"-ln((('0x' || substr(md5({_TEXT}), 1, 13))::bigint + 0.5::double) / {2**52}::double)"
_SAMPLE = (
    ("counted", f"select {_POINT}, count(*) as c from shots where {_SEASONS} group by all"),
    ("copies", f"select *, unnest(range(1, least(c, {S.SAMPLE_POINTS}) + 1)) as j from counted"),
    (
        "drawn",
        f"""select {_POINT}, sum({_DRAW} / (c - j + 1)) over (partition by {_POINT} order by j
        rows unbounded preceding) as k from copies""",
    ),
    ("picked", f"select {_POINT} from drawn order by k, {_POINT} limit {S.SAMPLE_POINTS}"),
)
register(
    "shot_sample_fixed",
    lambda f: reshape.sample_points(serving.team_shot_points(f.shots, None, FIRST, LAST)),
    O.sql(f"select {_POINT} from picked", *_SAMPLE, upto="shots"),
)
register(
    "shot_chart_points",
    lambda f: reshape.shot_chart(serving.team_shot_points(f.shots, None, FIRST, LAST)),
    O.sql(
        f"""select {_POINT}, case when made_flag = 1 then 'Made' else 'Missed' end as "Result",
        x_bin, y_bin, count(*) over (partition by x_bin, y_bin) as "Density" from binned""",
        *_SAMPLE,
        (
            "edges",
            """select min(x) as lo_x, max(x) as hi_x, min(y) as lo_y, max(y) as hi_y from picked
            where x is not null and y is not null""",
        ),
        (
            "binned",
            f"""select {_POINT}, {_CELL.format("x")}, {_CELL.format("y")} from picked, edges
            where x is not null and y is not null""",
        ),
        upto="shots",
    ),
)
register(
    "shot_density_grid",
    lambda f: reshape.density_grid(serving.team_shot_points(f.shots, None, FIRST, LAST)),
    O.sql(
        """select x, y, made_flag, shot_zone, team, x_bin, y_bin,
        count(*) over (partition by x_bin, y_bin) as "Density" from binned""",
        (
            "edges",
            f"""select min(x) as lo_x, max(x) as hi_x, min(y) as lo_y, max(y) as hi_y
            from shots where {_SEASONS}""",
        ),
        (
            "binned",
            f"""select x, y, made_flag, shot_zone, team, {_CELL.format("x")}, {_CELL.format("y")}
            from shots, edges where {_SEASONS} and x is not null and y is not null""",
        ),
        upto="shots",
    ),
)
register(
    "offensive_radar",
    lambda f: _rounded(
        reshape.offensive_radar(serving.team_evolution(f.team_metrics, FIRST, LAST, ordered=False))
    ),
    O.sql(
        " union all ".join(
            f"""select team, {i} as position, '{label}' as theta,
            round(greatest(0.0, least(1.0, {c} / {top}::double)), 6) as r from means"""
            for i, (c, label, top) in enumerate(
                (
                    ("pace", "Pace", 110),
                    ('"ORtg"', "ORtg", 120),
                    ("three_point_rate", "3PT Rate", 0.6),
                    ("rim_rate", "Rim Rate", 0.6),
                    ("midrange_rate", "Midrange Rate", 0.6),
                    ("pace", "Pace", 110),
                )
            )
        ),
        _TEAM_EVO,
        (
            "means",
            "select team, "
            + ", ".join(f"avg({c}) as {c}" for c in _RATE_NAMES)
            + " from evo where team is not null group by team",
        ),
        upto="tm",
    ),
)
register(
    "career_efficiency",
    lambda f: reshape.career_efficiency(*_player_pair(f)),
    O.sql(
        " union all ".join(
            f"""select season, '{prefix}{label}' as series, "{c}" as value from {cte}"""
            for cte, prefix in (("player_evo", ""), ("league_evo", "League "))
            for c, label in (("TS_pct", "TS%"), ("eFG_pct", "eFG%"))
        ),
        _PLAYER_EVO,
        _LEAGUE_PLAYERS,
        upto="pm",
    ),
)
_LATEST_SQL = (
    "latest",
    """(select 'Player' as series, * from player_evo order by season desc limit 1)
    union all (select 'League Avg' as series, * from league_evo order by season desc limit 1)""",
)
register(
    "latest_efficiency",
    lambda f: reshape.latest_efficiency(*_player_pair(f)),
    O.sql("select * from latest", _PLAYER_EVO, _LEAGUE_PLAYERS, _LATEST_SQL, upto="pm"),
)
register(
    "efficiency_compare",
    lambda f: reshape.efficiency_compare(reshape.latest_efficiency(*_player_pair(f))),
    O.sql(
        " union all ".join(
            f"""select '{label}' as metric, p."{c}" as player, l."{c}" as league,
            p."{c}" - l."{c}" as delta, printf('%.1f%%', p."{c}" * 100) as player_label,
            printf('%.1f%%', l."{c}" * 100) as league_label
            from (select * from latest where series = 'Player') p,
            (select * from latest where series = 'League Avg') l"""
            for c, label in reshape.EFFICIENCY.items()
        ),
        _PLAYER_EVO,
        _LEAGUE_PLAYERS,
        _LATEST_SQL,
        upto="pm",
    ),
)
register(
    "shot_profile_long",
    lambda f: reshape.shot_profile_long(
        serving.player_shot_profile(f.shots, PLAYER, FIRST, LAST, ordered=False)
    ),
    O.sql(
        " union all ".join(
            f"select season, '{label}' as zone, {c} as rate from profile"
            for c, label in (
                ("rim_rate", "Rim"),
                ("midrange_rate", "Midrange"),
                ("three_point_rate", "3PT"),
            )
        ),
        ("profile", _profile_sql()),
        upto="shots",
    ),
)
_ERA_ROWS = ", ".join(f"('{n}', {a}, {b})" for n, (a, b) in S.ERAS.items())
register(
    "era_league_summary",
    lambda f: reshape.era_league_summary(f.team_metrics),
    O.sql(
        """select era, min(season)::integer as first_season, max(season)::integer as last_season,
        """
        + O.team_rates("pace", "ORtg", "DRtg")
        + " from tm join eras on season between lo and hi group by era",
        ("eras", f"select * from (values {_ERA_ROWS}) t(era, lo, hi)"),
        upto="tm",
    ),
)

# ---- branches and empty stores ---------------------------------------------------------------

register(
    "league_radar",
    lambda f: _rounded(reshape.offensive_radar(reshape.league_average_label(_league(f)))),
    O.sql(
        " union all ".join(
            f"""select 'League Average' as team, {i} as position, '{label}' as theta,
            round(greatest(0.0, least(1.0, avg({c}) / {top}::double)), 6) as r from league"""
            for i, (c, label, top) in enumerate(
                (
                    ("pace", "Pace", 110),
                    ('"ORtg"', "ORtg", 120),
                    ("three_point_rate", "3PT Rate", 0.6),
                    ("rim_rate", "Rim Rate", 0.6),
                    ("midrange_rate", "Midrange Rate", 0.6),
                    ("pace", "Pace", 110),
                )
            )
        ),
        _LEAGUE_EVO,
        upto="tm",
    ),
)
register(
    "pace_series_one_team",
    lambda f: reshape.pace_series(
        _league(f), serving.team_evolution(f.team_metrics, FIRST, LAST, teams=TEAM, ordered=False)
    ),
    O.sql(
        "select season, 'League Average' as series, pace from league"
        " union all select season, 'Team Pace', pace from one",
        _LEAGUE_EVO,
        ("one", _team_sql(f"team = '{TEAM}'")),
        upto="tm",
    ),
)
_MINE = f"shooter = '{PLAYER}' and {_LATE.format(8 * 60, 3)}"
register(
    "player_shot_points_clutch",
    lambda f: serving.player_shot_points(f.shots, PLAYER, FIRST, LAST, True, 8, 3),
    O.sql(f"select x, y, made_flag, shot_zone from shots where {_SEASONS} and {_MINE}", upto="shots"),
)
register(
    "player_shot_profile_clutch",
    lambda f: serving.player_shot_profile(f.shots, PLAYER, FIRST, LAST, True, 8, 3),
    O.sql(_profile_sql(_LATE.format(8 * 60, 3)), upto="shots"),
)
_PICKED_ERA = "Pace & Space (2010-2015)"
register(
    "era_by_displayed_name",
    lambda f: serving.league_evolution(f.team_metrics, *reshape.era_range(_PICKED_ERA)),
    O.sql(
        f"select season, {O.team_rates()} from tm where season between 2010 and 2015 group by season",
        upto="tm",
    ),
)


def _pages_of_nothing(f: Frames) -> DataFrame:
    """(page, rows) over a store that was never built, beside the rows of the store that was."""
    empty = FactStore(f.spark, f"{f.folder()}/none")
    sizes = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(f"{page}.{name}").alias("frame"), "n_rows")
        for page, frames_ in (
            ("team", pages.team_page(empty, FIRST, LAST)),
            ("player", pages.player_page(empty, PLAYER, FIRST, LAST)),
        )
        for name, df in frames_.items()
    ]
    teams = serving.all_teams(f.team_metrics).agg(F.count(F.lit(1)).alias("n_rows"))
    out = teams.select(F.lit("teams of the built store").alias("frame"), "n_rows")
    for size in sizes:
        out = out.unionByName(size)
    return out


_EMPTY_FRAMES = (
    "team.shot_distribution", "team.pace", "team.shot_chart", "team.radar", "team.ratings",
    "team.efficiency_table", "player.efficiency", "player.shot_profile", "player.career",
    "player.shot_chart",
)
register(
    "pages_of_an_empty_store",
    _pages_of_nothing,
    O.sql(
        "select 'teams of the built store' as frame, count(distinct team)::bigint as n_rows from tm"
        + "".join(f" union all select '{x}', 0::bigint" for x in _EMPTY_FRAMES),
        upto="tm",
    ),
)


def _pages_without_rows(f: Frames) -> DataFrame:
    """(choice, frame, rows) of every frame of both pages, for seasons, a team and a player of the built
    store that have no rows, beside those of the usual choice."""
    choices = {
        "usual": (pages.team_page(f.store, FIRST, LAST, teams=[TEAM]), pages.player_page(f.store, PLAYER, FIRST, LAST)),
        "no season": (pages.team_page(f.store, 1900, 1901, teams=[TEAM]), pages.player_page(f.store, PLAYER, 1900, 1901)),
        "nobody": (pages.team_page(f.store, FIRST, LAST, teams=["nobody"]), pages.player_page(f.store, "nobody", FIRST, LAST)),
    }
    sizes = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(choice).alias("choice"), F.lit(f"{page}.{name}").alias("frame"), "n_rows"
        )
        for choice, both in choices.items()
        for page, frames_ in zip(("team", "player"), both)
        for name, df in frames_.items()
    ]
    out, *rest = sizes
    for size in rest:
        out = out.unionByName(size)
    return out


def _page_sizes_sql(choice: str, seasons_: str, team: str, player: str) -> str:
    """Rows of the frames from counts over the fact tables: seasons of the league and of the choice, and
    what a chart makes of each of them."""
    of_team, of_player = f"{seasons_} and team = '{team}'", f"{seasons_} and {{0}} = '{player}'"
    placed = "x is not null and y is not null"
    counts = {
        "team.shot_distribution": f"select 3 * count(distinct season) from tm where {of_team}",
        "team.pace": f"""select (select count(distinct season) from tm where {seasons_})
            + (select count(distinct season) from tm where {of_team})""",
        "team.shot_chart": f"select count(*) from shots where {of_team} and {placed}",
        "team.radar": f"select 6 * count(distinct team) from tm where {of_team}",
        "team.ratings": f"select count(distinct team) from tm where {of_team}",
        "team.efficiency_table": f"select count(distinct team) from tm where {of_team}",
        "player.efficiency": f"select 3 * least(count(*), 1) from pm where {of_player.format('player')}",
        "player.shot_profile": f"select 3 * count(distinct season) from shots where {of_player.format('shooter')}",
        "player.career": f"""select 2 * ((select count(distinct season) from pm where {of_player.format('player')})
            + (select count(distinct season) from pm where {seasons_}))""",
        "player.shot_chart": f"select count(*) from shots where {of_player.format('shooter')} and {placed}",
    }
    return " union all ".join(
        f"select '{choice}' as choice, '{frame}' as frame, ({sql})::bigint as n_rows" for frame, sql in counts.items()
    )


register(
    "pages_of_choices_without_rows",
    _pages_without_rows,
    O.sql(
        " union all ".join(
            (
                _page_sizes_sql("usual", _SEASONS, TEAM, PLAYER),
                _page_sizes_sql("no season", "season between 1900 and 1901", TEAM, PLAYER),
                _page_sizes_sql("nobody", _SEASONS, "nobody", "nobody"),
            )
        ),
        upto="pm",
    ),
)


def release() -> None:
    """Drop what the registered queries wrote."""
    for f in _FRAMES.values():
        f.release()
