"""Small hand-written event frames."""

from __future__ import annotations

from courtline.schema import RAW_EVENTS

DEFAULTS = dict.fromkeys(RAW_EVENTS.fieldNames())
SCHEMA_WITH_SEQ = "event_seq bigint"


def events(spark, rows: list[dict], seq: bool = True):
    """Raw events from dicts; missing columns are NULL and event_seq counts up from 1."""
    from pyspark.sql import types as T

    schema = T.StructType([*RAW_EVENTS.fields, T.StructField("event_seq", T.LongType())])
    data = []
    for i, row in enumerate(rows, 1):
        full = {**DEFAULTS, "event_seq": i, **row}
        data.append(tuple(full[name] for name in schema.fieldNames()))
    return spark.createDataFrame(data, schema)


def rows(df, *columns):
    """Collected tuples of the columns, sorted with NULL first."""
    data = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))


def worked_example(spark):
    """Golden G1 of FIXTURES.md: miss, rebound, make."""
    base = {"gameid": "G1", "period": 4, "team": "LAL", "season": 2024}
    return events(
        spark,
        [
            {**base, "clock": "PT02M30.00S", "player": "LeBron", "type": "Missed Shot",
             "dist": 22.0, "desc": "MISS LeBron Jump Shot"},
            {**base, "clock": "PT02M27.00S", "player": "Davis", "type": "Rebound",
             "desc": "Davis REBOUND"},
            {**base, "clock": "PT02M25.00S", "player": "LeBron", "type": "Made Shot",
             "dist": 16.0, "desc": "LeBron Jump Shot (2 PTS)", "h_pts": 90.0, "a_pts": 87.0},
        ],
    )


def tied_game(spark, gameid="G2"):
    """Golden G2 of FIXTURES.md: clock ties, period change, leading neutral event."""
    steps = [
        (1, "PT12M00.00S", "BOS", "Foul", "Foul"),
        (1, "PT11M40.00S", "BOS", "Made Shot", "Layup (2 PTS)"),
        (1, "PT11M20.00S", "BOS", "Missed Shot", "MISS Layup"),
        (1, "PT11M20.00S", "LAL", "Rebound", "REBOUND"),
        (1, "PT11M00.00S", None, "Timeout", "Timeout"),
        (2, "PT12M00.00S", None, "Timeout", "Timeout"),
        (2, "PT11M50.00S", "LAL", "Made Shot", "Layup (13 PTS)"),
    ]
    return events(
        spark,
        [
            {"gameid": gameid, "season": 2024, "period": p, "clock": c, "team": t, "type": k, "desc": d}
            for p, c, t, k, d in steps
        ],
    )
