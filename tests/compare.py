"""Exact comparison of a Spark result with a DuckDB statement."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _key(row: tuple):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def normal(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    out = []
    for row in rows:
        values = []
        for i in order:
            v = row[i]
            if isinstance(v, float):
                v = None if math.isnan(v) else float(repr(v + 0.0))
            values.append(v)
        out.append(tuple(values))
    return sorted(out, key=_key)


def same(spark_df, con, statement: str) -> tuple[bool, str]:
    result = con.execute(statement)
    duck_columns = [d[0] for d in result.description]
    if sorted(duck_columns) != sorted(spark_df.columns):
        return False, f"columns {sorted(spark_df.columns)} != {sorted(duck_columns)}"
    ours = normal([tuple(r) for r in spark_df.collect()], spark_df.columns)
    theirs = normal(result.fetchall(), duck_columns)
    if len(ours) != len(theirs):
        return False, f"{len(ours)} rows, expected {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    types = {type(v) for r in ours for v in r} ^ {type(v) for r in theirs for v in r}
    if types:
        return False, f"value types differ: {types}"
    return not wrong, f"{len(ours)} rows" if not wrong else f"{len(wrong)} differ, e.g. {wrong[0]}"
