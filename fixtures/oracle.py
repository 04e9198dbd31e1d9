"""Independent DuckDB SQL for every registered query.

One chain of common table expressions derives events, possessions and metrics from the ``events``
table in plain SQL (self join, outer join, two-step fill, ...), so it shares no logic with the
DataFrame operators. Each query appends its final SELECT.
"""

from __future__ import annotations

from .pbp import pbp_ctes

_ORDER = "order by period asc nulls first, secs desc nulls last, event_seq"
_ROWS = f"(partition by gameid {_ORDER} rows between unbounded preceding and current row)"

_CTES: dict[str, str] = dict(pbp_ctes())
_CTES["timed"] = """
    select * replace (
        case when type in ('Made Shot', 'Missed Shot') then x end as x,
        case when type in ('Made Shot', 'Missed Shot') then y end as y),
      try_cast(regexp_extract(clock, 'PT(\\d+)M', 1) as integer) * 60
        + try_cast(regexp_extract(clock, 'M(\\d+\\.\\d+)S', 1) as double) as secs,
      regexp_extract("desc", '\\((.*?)\\s+\\d+\\s+AST\\)', 1) as assister
    from pbp"""
_CTES["scored"] = f"""
    select *, coalesce(max(h_pts) over {_ROWS}, 0.0) as h_ff,
      coalesce(max(a_pts) over {_ROWS}, 0.0) as a_ff
    from timed"""
_CTES["ev"] = """
    select *, h_ff - a_ff as margin,
      case when period >= 4 and secs <= 300 and h_ff - a_ff >= -5 and h_ff - a_ff <= 5
        then 1 else 0 end as is_clutch,
      case when type in ('Made Shot', 'Missed Shot') then
        case when "desc" like '%3PT%' then
          case when y <= 140 then 'Corner 3' else 'Above Break 3' end
        when dist <= 4 then 'Restricted Area' else 'Midrange' end end as shot_zone,
      case when type = 'Made Shot' then case when "desc" like '%3PT%' then 3 else 2 end
        else 0 end as shot_value,
      case type when 'Made Shot' then 1 when 'Missed Shot' then 0 end as made_flag,
      case when type = 'Made Shot' then case when "desc" like '%3 PTS%' then 3 else 2 end
        when type = 'Free Throw' and "desc" like '% PTS%' then 1 else 0 end as pts_event,
      case when type in ('Made Shot', 'Missed Shot', 'Turnover', 'Free Throw', 'Rebound',
        'Jump Ball') then team end as action_team
    from scored"""
_CTES["shots"] = """
    select player as shooter, team, x, y, shot_zone, made_flag, shot_value, season, is_clutch,
      period, secs as seconds_remaining, margin as score_margin
    from ev where type in ('Made Shot', 'Missed Shot')"""
_CTES["filled"] = f"""
    select *, last_value(action_team ignore nulls) over {_ROWS} as row_team from ev"""
_CTES["held"] = """
    select *, last_value(row_team) over (partition by gameid, period, secs order by event_seq
      rows between unbounded preceding and unbounded following) as possession_team
    from filled"""
_CTES["lagged"] = f"""
    select *, lag(possession_team) over (partition by gameid {_ORDER}) as prev_team,
      lag(period) over (partition by gameid {_ORDER}) as prev_period
    from held"""
_CTES["flagged"] = """
    select *, case when possession_team is null then 0 when possession_team <> prev_team then 1
      when period <> prev_period then 1 when prev_team is null then 1 else 0 end as is_new
    from lagged"""
_CTES["marked"] = """
    select *, sum(is_new) over (partition by gameid
      order by period asc nulls first, secs desc nulls last)::bigint as seg
    from flagged"""
_CTES["segmented"] = """
    select *, concat_ws('_', gameid, cast(seg as varchar)) as possession_id from marked"""
_CTES["turnovers"] = """
    select possession_id, max(case when type = 'Turnover' then 1 else 0 end) as has_turnover
    from segmented group by possession_id"""
_CTES["poss_core"] = """
    select possession_id, gameid, possession_team as team, max(secs) - min(secs)
      as possession_length, sum(pts_event)::bigint as points_scored, max(is_clutch) as is_clutch
    from segmented group by possession_id, gameid, possession_team"""
_CTES["poss"] = """
    select p.*, case when points_scored > 0 then 'Score' when has_turnover = 1 then 'Turnover'
      else 'Miss/Other' end as possession_result
    from poss_core p left join turnovers using (possession_id)"""
_CTES["game_season"] = "select distinct gameid, season from pbp"
_CTES["pws"] = "select p.*, g.season from poss p left join game_season g on p.gameid = g.gameid"
_CTES["offense"] = """
    select team, season, is_clutch, count(*) as total_possessions,
      sum(points_scored)::bigint as points_scored, count(distinct gameid) as games_played
    from pws group by all"""
_CTES["game_teams"] = "select distinct gameid, team from pws"
_CTES["matchups"] = """
    select a.gameid, a.team as off_team, b.team as def_team
    from game_teams a join game_teams b on a.gameid = b.gameid and a.team <> b.team"""
_CTES["defense"] = """
    select m.def_team as team, p.season, p.is_clutch, count(*) as def_possessions,
      sum(p.points_scored)::bigint as points_allowed
    from pws p left join matchups m on p.gameid = m.gameid and p.team = m.off_team
    group by all"""
_CTES["both_sides"] = """
    select team, coalesce(season, 0) as season, coalesce(is_clutch, 0) as is_clutch,
      coalesce(total_possessions, 0) as total_possessions,
      coalesce(points_scored, 0) as points_scored, coalesce(games_played, 0) as games_played,
      coalesce(def_possessions, 0) as def_possessions,
      coalesce(points_allowed, 0) as points_allowed
    from offense full outer join defense using (team, season, is_clutch)"""
_CTES["shot_counts"] = """
    select team, season, is_clutch, count(*) as total_fga,
      count(*) filter (where shot_zone in ('Corner 3', 'Above Break 3') or shot_zone like '%3%')
        as three_pt_attempts,
      count(*) filter (where shot_zone = 'Restricted Area') as rim_attempts,
      count(*) filter (where shot_zone = 'Midrange') as midrange_attempts
    from shots group by all"""
_CTES["tm"] = """
    select team, season, is_clutch, games_played, total_possessions, points_scored,
      def_possessions, points_allowed, coalesce(three_pt_attempts, 0) as three_pt_attempts,
      coalesce(rim_attempts, 0) as rim_attempts,
      coalesce(midrange_attempts, 0) as midrange_attempts, coalesce(total_fga, 0) as total_fga
    from both_sides left join shot_counts using (team, season, is_clutch)"""
_CTES["pm"] = """
    select player, season, is_clutch,
      sum(case when type = 'Made Shot' then case when "desc" like '%3PT%' then 3 else 2 end
        when type = 'Free Throw' and "desc" like '% PTS%' then 1 else 0 end)::bigint as pts,
      count(*) filter (where type in ('Made Shot', 'Missed Shot')) as fga,
      count(*) filter (where type = 'Made Shot') as fgm,
      count(*) filter (where type = 'Made Shot' and "desc" like '%3PT%') as fg3m,
      count(*) filter (where type in ('Made Shot', 'Missed Shot') and "desc" like '%3PT%') as fg3a,
      count(*) filter (where type = 'Free Throw') as fta,
      count(*) filter (where type = 'Turnover') as tov
    from ev where player is not null and player <> '' group by all"""


def _ratio(num: str, den: str, scale: str = "") -> str:
    return f"case when {den} > 0 then cast({num} as double) / cast({den} as double){scale} else 0.0 end"


_TEAM_RATE = {
    "pace": "cast(sum(total_possessions) as double)"
    " / nullif(cast(max(games_played) as double), 0)",
    "ORtg": _ratio("sum(points_scored)", "sum(total_possessions)", " * 100"),
    "DRtg": _ratio("sum(points_allowed)", "sum(def_possessions)", " * 100"),
    "three_point_rate": _ratio("sum(three_pt_attempts)", "sum(total_fga)"),
    "rim_rate": _ratio("sum(rim_attempts)", "sum(total_fga)"),
    "midrange_rate": _ratio("sum(midrange_attempts)", "sum(total_fga)"),
}


def team_rates(*names: str) -> str:
    return ", ".join(f'{_TEAM_RATE[n]} as "{n}"' for n in (names or _TEAM_RATE))


_TS_DEN = "(cast(sum(fga) as double) + 0.44::double * cast(sum(fta) as double))"
PLAYER_RATES = ", ".join(
    (
        f"case when {_TS_DEN} > 0 then cast(sum(pts) as double) / (2.0::double * {_TS_DEN})"
        ' else 0.0 end as "TS_pct"',
        "case when sum(fga) > 0 then (cast(sum(fgm) as double) + 0.5::double *"
        ' cast(sum(fg3m) as double)) / cast(sum(fga) as double) else 0.0 end as "eFG_pct"',
        _ratio("sum(fg3m)", "sum(fg3a)") + " as three_point_efficiency",
    )
)
ZONE_RATES = ", ".join(
    f"cast(count(*) filter (where {test}) as double) / count(*) as {name}"
    for test, name in (
        ("shot_zone = 'Restricted Area'", "rim_rate"),
        ("shot_zone = 'Midrange'", "midrange_rate"),
        ("shot_zone in ('Corner 3', 'Above Break 3') or shot_zone like '%3%'", "three_point_rate"),
    )
)


def _needed(names: list[str]) -> list[str]:
    """CTE names in definition order up to the last one a statement needs."""
    order = list(_CTES)
    last = max(order.index(n) for n in names)
    return order[: last + 1]


def sql(final: str, *extra: tuple[str, str], upto: str) -> str:
    """Statement: the chain up to ``upto``, then ``extra`` CTEs, then the final SELECT."""
    ctes = [(n, _CTES[n]) for n in _needed([upto])] + list(extra)
    return "with " + ",\n".join(f"{n} as ({body.strip()})" for n, body in ctes) + "\n" + final
