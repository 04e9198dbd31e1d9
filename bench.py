"""Benchmark: prints one JSON line.

Times the pipeline from a CSV feed with all events of BENCH_SF_DIR, then each serving query over the
fact tables that the pipeline wrote (median of three runs after one warm-up). With BENCH_COPIES=n
the pipeline also runs from CSV files that hold n shifted copies of the games; 180 copies of sf0.1
are 18 million events, the scale of the published baseline.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from courtline.plans.pipeline import run_pipeline  # noqa: E402
from courtline.schema import RAW_EVENTS  # noqa: E402
from courtline.sources.fact_store import FactStore  # noqa: E402
from fixtures import catalog  # noqa: E402
from fixtures.pbp import read_pbp  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
MEMORY = os.environ.get("BENCH_MEMORY", "16g")

SERVING = (
    "team_evolution", "team_evolution_clutch", "league_evolution", "league_evolution_subset",
    "player_stats", "league_player_stats", "team_shot_points", "player_shot_points",
    "player_shot_profile", "clutch_dynamic_window", "all_teams", "all_players",
    "topk_team_seasons", "topk_player_seasons", "player_true_shooting", "team_ratings_latest",
    "league_three_point_era", "league_baseline", "team_efficiency_table", "shot_distribution_long",
    "pace_series", "shot_chart_points", "shot_density_grid", "offensive_radar",
    "efficiency_compare", "era_league_summary",
)

# One query per chart, timed again over the fact tables of the copies.
CHARTS = (
    "league_evolution", "team_evolution", "player_stats", "player_shot_profile",
    "player_shot_points", "team_shot_points", "shot_chart_points",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("courtline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="courtline-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    started = time.monotonic()
    action()
    return time.monotonic() - started


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def serving_times(frames: catalog.Frames, keys: tuple[str, ...]) -> dict[str, float]:
    """Median of three runs after a warm-up, plan building included."""
    seconds = {}
    for key in keys:
        run = catalog.QUERIES[key]
        drain(run(frames))
        seconds[key] = statistics.median(timed(lambda: drain(run(frames))) for _ in range(3))
    return seconds


def csv_feed(spark: SparkSession, root: str, copies: int) -> str:
    """CSV files with ``copies`` shifted copies of every game, whole games together."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    events = read_pbp(spark, SF_DIR).repartition(int(CPUS) * 2, "gameid")
    many = events.withColumn("copy", copy).withColumn(
        "gameid", F.concat_ws("x", "gameid", F.col("copy").cast("string"))
    )
    ordered = many.repartition(int(CPUS) * 2, "gameid").sortWithinPartitions("gameid", "event_seq")
    path = f"{root}/play_by_play_{copies}"
    ordered.select(*RAW_EVENTS.fieldNames()).write.option("header", True).csv(path)
    return f"{path}/*.csv"


def main() -> None:
    spark = session()
    root = spark.conf.get("spark.checkpoint.dir")
    frames = catalog.frames(spark, SF_DIR)
    n_events = frames.events.count()
    queries: dict[str, float] = {}

    drain(frames.store.read("fact_shots"))  # first run: compiles code and writes the fact tables
    feed = csv_feed(spark, root, 1)
    runs = [run_pipeline(spark, feed, f"{root}/facts{i}") for i in range(2)]
    steps = min(runs, key=lambda s: s["total"])
    queries["etl_pipeline"] = steps["total"]
    queries |= serving_times(frames, SERVING)

    extra = {
        "etl_steps": {k: round(v, 3) for k, v in steps.items()},
        "etl_events": n_events,
        "etl_events_per_sec": round(n_events / steps["total"]),
        "query_median_sec": round(statistics.median(queries[k] for k in SERVING), 3),
        "query_max_sec": round(max(queries[k] for k in SERVING), 3),
    }
    if COPIES > 0:
        source = csv_feed(spark, root, COPIES)
        spark.conf.set("spark.sql.shuffle.partitions", str(8 * int(CPUS)))
        steps = run_pipeline(spark, source, f"{root}/copies")
        extra["etl_copies"] = {
            "copies": COPIES,
            "events": n_events * COPIES,
            "sec": round(steps["total"], 3),
            "events_per_sec": round(n_events * COPIES / steps["total"]),
            "steps": {k: round(v, 3) for k, v in steps.items()},
            "queries": {
                k: round(v, 3)
                for k, v in serving_times(
                    catalog.Frames(spark, SF_DIR, FactStore(spark, f"{root}/copies")), CHARTS
                ).items()
            },
        }
    print(
        json.dumps(
            {
                "metric": "courtline: pipeline and serving queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in queries.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
