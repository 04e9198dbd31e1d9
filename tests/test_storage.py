"""CSV scan, fact store, pipeline and dashboard pages."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from courtline.operators import serving
from courtline.plans.pages import player_page, team_page
from courtline.plans.pipeline import run_pipeline, table_counts
from courtline.plans.staging import STAGED_BYTES_PER_PARTITION, Staging, partitions_for, work_dir
from courtline.schema import FACT_SCHEMAS, RAW_EVENTS
from courtline.sources.event_files import get_raw_schema, ingest_data
from courtline.sources.fact_store import FactStore

from .helpers import rows, tied_game

HEADER = ",".join(RAW_EVENTS.fieldNames())


def _line(i: int) -> str:
    return f"G,1,PT{i // 60:02d}M{i % 60:02d}.00S,,,A,1,P,Rebound,,,,,,row {i},2020"


def test_scan_is_typed_ordered_and_tolerant(spark, tmp_path):
    lines = [HEADER, *(_line(i) for i in range(400)), 'G,one,PT01M00.00S,x,,A,1,,Foul,,,,,,"a, b",2020']
    (tmp_path / "play_by_play.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "team_metadata.csv").write_text("id,name\n1,A\n")
    df = ingest_data(spark, f"{tmp_path}/play_by_play*.csv")
    assert get_raw_schema() == RAW_EVENTS
    assert [(f.name, f.dataType) for f in df.schema][:16] == [(f.name, f.dataType) for f in RAW_EVENTS]
    assert df.count() == 401
    odd = df.filter("type = 'Foul'").first()
    assert (odd.period, odd.h_pts, odd.player, odd.desc) == (None, None, None, 'a, b')


def test_event_order_is_file_order_for_any_split(spark, tmp_path):
    (tmp_path / "play_by_play.csv").write_text("\n".join([HEADER, *(_line(i) for i in range(2000))]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = ingest_data(spark, f"{tmp_path}/*.csv")
        assert df.rdd.getNumPartitions() > 4
        ordered = [r.desc for r in df.orderBy("event_seq").select("desc").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == [f"row {i}" for i in range(2000)]


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "play_by_play.csv").write_text(HEADER.replace("gameid", "game") + "\n" + _line(1))
    with pytest.raises(Exception, match="header"):
        ingest_data(spark, f"{tmp_path}/*.csv").collect()
    assert ingest_data(spark, f"{tmp_path}/*.csv", check_header=False).count() == 1


def test_store_prunes_and_skips(frames):
    df = serving.player_shot_points(frames.shots, "P. Player3", 2016, 2018)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "season" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "EqualTo(shooter,P. Player3)" in plan
    assert "score_margin" not in plan.split("ReadSchema:")[1]


def test_missing_table(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "none"))
    assert serving.all_teams(store.read_or_empty("fact_team_metrics")).count() == 0
    with pytest.raises(AnalysisException):
        store.read("fact_team_metrics")
    (tmp_path / "none" / "fact_shots").mkdir(parents=True)
    (tmp_path / "none" / "fact_shots" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        store.read_or_empty("fact_shots").count()
    with pytest.raises(KeyError):
        store.read("fact_coaches")


def test_null_season_directory_and_overwrite(spark, tmp_path):
    store = FactStore(spark, str(tmp_path))
    schema = FACT_SCHEMAS["fact_player_metrics"]
    make = lambda data: spark.createDataFrame([(n, 0, p, 0, 0, 0, 0, 0, 0, s) for n, p, s in data], schema)
    store.write("fact_player_metrics", make([("A", 1, 2020), ("B", 2, None), ("C", 3, 2021)]))
    assert "season=__HIVE_DEFAULT_PARTITION__" in os.listdir(tmp_path / "fact_player_metrics")
    store.write("fact_player_metrics", make([("D", 4, 2021)]), overwrite="dynamic")
    table = store.read("fact_player_metrics")
    assert rows(table, "player", "season") == [("A", 2020), ("B", None), ("D", 2021)]
    store.write("fact_player_metrics", make([("E", 5, 2022)]))
    assert rows(store.read("fact_player_metrics"), "player", "season") == [("E", 2022)]
    with pytest.raises(ValueError):
        store.write("fact_player_metrics", table, overwrite="some")


def test_one_file_per_small_season(spark, frames):
    root = frames.store.path("fact_shots")
    files = {d: [f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")] for d in os.listdir(root) if "=" in d}
    assert len(files) == 10 and all(len(f) == 1 for f in files.values())


def test_pipeline_from_csv_equals_lazy_facts(spark, frames, tmp_path):
    source = tmp_path / "raw"
    names = RAW_EVENTS.fieldNames()
    # Tie order comes from the file, so write the events in their own order.
    ordered = frames.events.coalesce(1).sortWithinPartitions("event_seq").select(*names)
    ordered.write.option("header", True).csv(str(source))
    seconds = run_pipeline(spark, f"{source}/*.csv", str(tmp_path / "out"))
    assert {"ingest", "mark", "total"} <= set(seconds)
    store = FactStore(spark, str(tmp_path / "out"))
    for table, schema in FACT_SCHEMAS.items():
        columns = [f.name for f in schema]
        ours, lazy = store.read(table), frames.facts[table]
        if table == "fact_shots":  # an empty name is NULL in a text file
            lazy = lazy.withColumn("shooter", F.nullif("shooter", F.lit("")))
        assert rows(ours, *columns) == rows(lazy, *columns), table


def test_season_backfill_touches_its_seasons_only(spark, frames, tmp_path):
    out = str(tmp_path / "out")
    run_pipeline(spark, frames.events, out)
    store = FactStore(spark, out)
    before = {t: rows(store.read(t), *s.fieldNames()) for t, s in FACT_SCHEMAS.items()}
    late = frames.events.filter("season = 2020")
    run_pipeline(spark, late, out, overwrite="dynamic")
    assert {t: rows(store.read(t), *s.fieldNames()) for t, s in FACT_SCHEMAS.items()} == before


def test_staging_lives_in_the_shared_folder_and_is_removed(spark):
    staging = Staging(spark)
    assert staging.root.startswith(spark.conf.get("spark.checkpoint.dir")) and work_dir(spark) in staging.root
    kept = staging.keep(tied_game(spark), "game")
    assert kept.count() == 7 and os.path.isdir(staging.root)
    assert 0 < staging.bytes("game") < 100_000
    staging.drop()
    assert not os.path.exists(staging.root)


def test_shuffles_follow_the_bytes_that_were_staged(spark, frames):
    staging = Staging(spark)
    try:
        # An optimizer multiplies the sizes of the two sides of this join; the staged bytes do not.
        joined = frames.events.join(frames.events.select("event_seq").distinct(), "event_seq")
        staging.keep(joined, "joined")
        assert partitions_for(spark, staging.bytes("joined")) == 8
    finally:
        staging.drop()
    assert partitions_for(spark, 1000 * STAGED_BYTES_PER_PARTITION) == 1000


@pytest.mark.parametrize("folder", ["a", "b", "deep/er", "z 9"])
def test_event_order_does_not_depend_on_the_folder(spark, tmp_path, folder):
    source = tmp_path / folder
    source.mkdir(parents=True)
    for name, first in (("part_10.csv", 20), ("part_2.csv", 10), ("part_1.csv", 0)):
        lines = [HEADER, *(_line(i) for i in range(first, first + 10))]
        (source / name).write_text("\n".join(lines))
    ordered = ingest_data(spark, str(source)).orderBy("event_seq").select("desc", "event_seq.file").collect()
    assert [r.desc for r in ordered] == [f"row {i}" for i in range(30)]
    files = [r.file for r in ordered]
    assert files == sorted(files) and [files.count(f) for f in dict.fromkeys(files)] == [10, 10, 10]


def test_a_players_shots_lie_in_few_files_of_a_split_season(spark, tmp_path):
    store, schema = FactStore(spark, str(tmp_path)), FACT_SCHEMAS["fact_shots"]
    shots = spark.range(20_000).selectExpr("concat('P', id % 50) as shooter", "double(id) as x")
    for field in schema:
        if field.name not in shots.columns:
            shots = shots.withColumn(field.name, F.lit(1).cast(field.dataType))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write("fact_shots", shots)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = store.read("fact_shots").select("shooter", F.input_file_name().alias("f")).distinct().groupBy("shooter").count()
    assert len([f for f in os.listdir(store.path("fact_shots") + "/season=1") if f.endswith(".parquet")]) == 8
    assert files.agg(F.max("count")).first()[0] <= 2


def test_counts(frames):
    got = dict(rows(table_counts(frames.store), "table_name", "n_rows"))
    assert got == {"fact_shots": 3988, "fact_possessions": 4333, "fact_team_metrics": 106, "fact_player_metrics": 400}


@pytest.mark.parametrize("teams", [None, ["T1"], ["T1", "T4"]])
def test_team_page(frames, teams):
    page = team_page(frames.store, 2015, 2024, teams=teams, result="Made")
    sizes = {name: df.count() for name, df in page.items()}
    n = len(teams or [])
    assert sizes["shot_distribution"] == 30
    assert sizes["shot_chart"] == min(2500, serving.team_shot_points(frames.shots, teams, 2015, 2024).filter("made_flag = 1").count())
    assert sizes["radar"] == 6 * (n or 1)
    assert sizes["efficiency_table"] == sizes["ratings"] == (n or 6)
    assert {r.series for r in page["pace"].select("series").distinct().collect()} == {
        None: {"League Average"}, 1: {"League Average", "Team Pace"}, 2: {"League Average", "T1", "T4"}
    }[n or None]


def test_player_page(frames):
    page = player_page(frames.store, "P. Player3", 2015, 2024)
    sizes = {name: df.count() for name, df in page.items()}
    assert sizes == {"efficiency": 3, "shot_profile": 30, "career": 40, "shot_chart": 164}
