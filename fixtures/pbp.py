"""Play-by-play view over the test table ``events`` (see FIXTURES.md).

One row in, one row out. The expressions are written once as text that Spark SQL and DuckDB read
alike; only the quoting of ``desc`` differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.schema import RAW_EVENTS

# The mapping of FIXTURES.md, in stages, as (column, expression).
STAGES = (
    (
        ("k", "cast(regexp_extract(props, '([0-9]+)', 1) as int)"),
        (
            "secs",
            "cast(720 - 10 * floor(((day(ts)-1) % 6 * 86400 + hour(ts)*3600 + minute(ts)*60)"
            " / 7200) as int)",
        ),
    ),
    (
        (
            "type",
            "case event_type when 'click' then 'Made Shot' when 'view' then 'Missed Shot'"
            " when 'error' then case when k % 3 = 0 then 'Turnover' else 'Rebound' end"
            " when 'purchase' then 'Free Throw'"
            " else case when k % 4 = 0 then 'Jump Ball' when k % 4 = 1 then 'Foul'"
            " else 'Timeout' end end",
        ),
        ("sx", "cast(k*5 - 250 as double)"),
        ("sy", "cast(floor(least(value * 3 - 47, 420)) as double)"),
    ),
    (
        ("sd", "sqrt(sx*sx + sy*sy) / 10"),
        ("scored", "(type = 'Made Shot' or (type = 'Free Throw' and k % 4 <> 0))"),
    ),
)
FINAL = {
    "event_seq": "event_id",
    "gameid": "concat('G', lpad(cast(user_id as string), 5, '0'))",
    "period": "cast(least(1 + floor((day(ts) - 1) / 6), 5) as int)",
    "clock": "concat('PT', lpad(cast(cast(floor(secs / 60) as int) as string), 2, '0'), 'M',"
    " lpad(cast(cast(secs % 60 as int) as string), 2, '0'), '.00S')",
    "h_pts": "case when scored then cast(floor(day(ts) * 3.5) + k % 9 as double) end",
    "a_pts": "case when scored then cast(floor(day(ts) * 3.5) + (k * 7) % 12 as double) end",
    "team": "case when event_type = 'signup' and k % 7 = 0 then null"
    " when (k + event_id) % 2 = 0 then concat('T', cast(user_id % 6 as string))"
    " else concat('T', cast((user_id + 1 + user_id % 4) % 6 as string)) end",
    "playerid": "cast((user_id + k) % 20 as string)",
    "player": "case when k % 13 = 0 then null when k % 11 = 0 then ''"
    " else concat('P. Player', cast((user_id + k) % 20 as string)) end",
    "type": "type",
    "subtype": "cast(null as string)",
    "result": "case when type = 'Made Shot' then 'Made' when type = 'Missed Shot' then 'Missed' end",
    "x": "sx",
    "y": "sy",
    "dist": "sd",
    "desc": "case type when 'Made Shot' then concat('Player ', case when sd > 22 then '3PT ' else ''"
    " end, 'Jump Shot (', cast(k as string), ' PTS)',"
    " case when k % 3 = 0 then ' (Mate 3 AST)' else '' end)"
    " when 'Missed Shot' then concat('MISS Player ', case when sd > 22 then '3PT ' else '' end,"
    " 'Jump Shot')"
    " when 'Free Throw' then case when k % 4 <> 0"
    " then concat('Player Free Throw 1 of 2 (', cast(k as string), ' PTS)')"
    " else 'MISS Player Free Throw 1 of 2' end"
    " else concat('Player ', type) end",
    "season": "cast(2015 + user_id % 10 as int)",
}


def pbp_frame(events: DataFrame) -> DataFrame:
    """Raw 16 columns and event_seq from an ``events`` frame."""
    df = events
    for stage in STAGES:
        df = df.selectExpr("*", *(f"{expr} as `{name}`" for name, expr in stage))
    return df.selectExpr(*(f"{FINAL[c]} as `{c}`" for c in (*RAW_EVENTS.fieldNames(), "event_seq")))


def read_pbp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pbp_frame(spark.read.parquet(f"{sf_dir}/events.parquet"))


def pbp_ctes() -> list[tuple[str, str]]:
    """The same view as common table expressions for DuckDB."""
    ctes, source = [], "events"
    for i, stage in enumerate(STAGES):
        columns = ", ".join(f'{expr} as "{name}"' for name, expr in stage)
        ctes.append((f"stage{i}", f"select *, {columns} from {source}"))
        source = f"stage{i}"
    names = (*RAW_EVENTS.fieldNames(), "event_seq")
    columns = ", ".join(f'{FINAL[c]} as "{c}"' for c in names)
    return [*ctes, ("pbp", f"select {columns} from {source}")]
