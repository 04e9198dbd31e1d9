"""File order without a list, order checks inside the windows, tables that change together, file skipping."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from courtline.operators import game_order, serving
from courtline.operators.game_order import NO_ORDER, GameProfile
from courtline.plans import pipeline
from courtline.plans.pipeline import fact_frames, independent_facts, measure_events, run_pipeline, staged_marks
from courtline.plans.staging import Staging
from courtline.schema import FACT_SCHEMAS, RAW_EVENTS
from courtline.sources import fact_store
from courtline.sources import event_files
from courtline.sources.event_files import ingest_data, literal_folder, sortable_name
from courtline.sources.fact_store import FactStore

from .helpers import rows, tied_game
from .test_plans import exchanges, plan
from .test_storage import HEADER, _line


# ---- files -------------------------------------------------------------------------------------


def _natural(name):
    return [(1, int(p)) if p[0].isdigit() else (0, p) for p in re.findall(r"[0-9]+|[^0-9]+", name)]


def test_names_sort_by_the_value_of_their_numbers(spark):
    rng = random.Random(1)
    names = ["_".join(str(rng.choice([7, 70, 10**20 - 1, 10**20, 10**20 + 1, 10**23 + 5, 10**24, rng.randrange(10**6)])) for _ in range(3)) for _ in range(300)]
    names = sorted({f"part_{n}.csv" for n in names})
    df = spark.createDataFrame([(n,) for n in names], "n string").withColumn("k", sortable_name(F.col("n")))
    got = [r.n for r in df.orderBy("k").collect()]
    assert got == sorted(names, key=_natural)
    zeros = ["a" + "0" * 30 + "7", "a8", "a" + "0" * 3 + "9", "a10"]
    keys = spark.createDataFrame([(n,) for n in zeros], "n string").orderBy(sortable_name(F.col("n"))).collect()
    assert [r.n for r in keys] == zeros
    odd = ["a.csv", "a1.csv", "a01.csv", "a001.csv", "a0.csv", "a00.csv", "", "0", "b/2/x", "b/10/x"]
    keys = [r.k for r in spark.createDataFrame([(n,) for n in odd], "n string").select(sortable_name(F.col("n")).alias("k")).collect()]
    assert len(set(keys)) == len(odd)


def test_the_folder_named_by_the_paths_is_left_out():
    assert literal_folder("data/raw/*.csv") == "/data/raw/"
    assert literal_folder("file:///x/y/play*.csv") == "/x/y/"
    assert literal_folder(["a/b/*.csv", "a/c/*.csv"]) == "/a/"
    for unknown in ("*.csv", "../x/*.csv", "./*.csv", ["/a/*.csv", "b/*.csv"]):
        assert literal_folder(unknown) == ""


def test_the_scan_has_no_list_and_no_join(spark, tmp_path):
    (tmp_path / "play.csv").write_text("\n".join([HEADER, _line(1)]))
    df = ingest_data(spark, f"{tmp_path}/*.csv")
    text = plan(df)
    assert "Join" not in text and "Exchange" not in text and "LocalTableScan" not in text
    assert df.first().event_seq.file.startswith("play.csv")
    assert df.filter("event_seq.file like '%/%'").count() == 0


def test_ranks_follow_files_and_rows_without_a_sort_of_rows(spark, tmp_path):
    sizes = {"part_10.csv": 700, "part_2.csv": 3, "part_1 b.csv": 400, "part_3.csv": 0}
    for name, n in sizes.items():
        (tmp_path / name).write_text("\n".join([HEADER, *(_line(i) for i in range(n))]) + "\n")
    name = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(name)
    try:
        for most in (usual, "9000"):
            spark.conf.set(name, most)
            df = event_files.ranked_events(spark, f"{tmp_path}/*.csv")
            want = [r[:-1] for r in ingest_data(spark, f"{tmp_path}/*.csv").orderBy("event_seq").collect()]
            got = sorted((tuple(r) for r in df.collect()), key=lambda r: r[-1])
            assert [r[-1] for r in got] == list(range(1, 1104))
            assert [r[:-1] for r in got] == want
            # What is sorted and windowed is a row per split: the rows themselves are on the side without an exchange.
            assert "rangepartitioning" not in plan(df) and plan(df).count("Window") >= 1
            assert "BroadcastHashJoin" in plan(df)
    finally:
        spark.conf.set(name, usual)


def test_ten_folders_give_equal_facts(spark, frames, tmp_path):
    names = RAW_EVENTS.fieldNames()
    game = [r for r in frames.events.filter("gameid in ('G00001', 'G00002')").orderBy("event_seq").select(*names).collect()]
    schema = RAW_EVENTS
    seen = []
    for folder in ("a", "b c", "d+e", "f%g", "9", "10", "x/y", "x1/y2", "ü", "deep/er/still"):
        source = tmp_path / folder
        for i, part in enumerate((game[:80], game[80:150], game[150:])):
            piece = spark.createDataFrame(part, schema).coalesce(1)
            piece.write.option("header", True).csv(str(source / f"w{i}"))
            found = [f for f in os.listdir(source / f"w{i}") if f.endswith(".csv")][0]
            # Parts 8, 9 and 10: by value, not by character.
            os.replace(source / f"w{i}" / found, source / f"events_{8 + i}.csv")
        events = ingest_data(spark, str(source) + "/events_*.csv" if "%" not in folder else str(source))
        if "%" in folder:
            events = events.filter("gameid is not null")
        facts = fact_frames(events, GameProfile(None, True))
        seen.append({t: rows(facts[t], *s.fieldNames()) for t, s in FACT_SCHEMAS.items()})
    assert all(s == seen[0] for s in seen) and seen[0]["fact_possessions"]


# ---- order -------------------------------------------------------------------------------------


def _bad_orders(frames):
    return {
        "repeated": frames.events.withColumn("event_seq", F.expr("event_seq div 1000")),
        "unknown": frames.events.withColumn("event_seq", F.expr("if(event_seq > 9, event_seq, null)")),
    }


@pytest.mark.parametrize("kind", ["repeated", "unknown"])
@pytest.mark.parametrize("hot_rows", [1_000_000, 0], ids=["per game", "split"])
def test_the_windows_refuse_numbers_that_tell_no_order(spark, frames, tmp_path, monkeypatch, kind, hot_rows):
    monkeypatch.setattr(game_order, "HOT_GAME_ROWS", hot_rows)
    monkeypatch.setattr(game_order, "check_event_order", lambda events: pytest.fail("a pass of its own"))
    with pytest.raises(ValueError, match=NO_ORDER):
        run_pipeline(spark, _bad_orders(frames)[kind], str(tmp_path / "out"))
    assert not [f for f in os.listdir(tmp_path / "out") if not f.startswith(".")] if (tmp_path / "out").exists() else True


def test_a_number_may_come_back_at_another_clock_value(spark, frames, tmp_path):
    game = tied_game(spark)
    again = game.withColumn("event_seq", F.expr("if(clock = 'PT11M20.00S', event_seq, 1)"))
    ours = fact_frames(again, GameProfile(None, True))["fact_possessions"]
    want = fact_frames(game, GameProfile(None, True))["fact_possessions"]
    assert rows(ours, *FACT_SCHEMAS["fact_possessions"].fieldNames()) == rows(want, *FACT_SCHEMAS["fact_possessions"].fieldNames())


def test_no_exchange_on_event_numbers(spark, frames, tmp_path, monkeypatch):
    """Every frame that the pipeline runs over a DataFrame of events, by its plan."""
    seen = []
    keep, write = Staging.keep, FactStore.write
    monkeypatch.setattr(Staging, "keep", lambda self, df, *a, **k: (seen.append(plan(df)), keep(self, df, *a, **k))[1])
    monkeypatch.setattr(FactStore, "write", lambda self, t, df, *a, **k: (seen.append(plan(df)), write(self, t, df, *a, **k))[1])
    run_pipeline(spark, frames.events, str(tmp_path / "out"))
    assert len(seen) == 6
    assert not [e for text in seen for e in exchanges(text) if "event_seq" in e]


# ---- oversized games beside ordinary ones ------------------------------------------------------


def test_one_large_game_leaves_the_buckets_to_the_others(spark, frames):
    profile = GameProfile(spark.createDataFrame([("G00003",)], "gameid string"), True)
    staging = Staging(spark)
    try:
        parts = staged_marks(staging, measure_events(frames.events), profile, 8)
        assert len(parts) == 2
        assert rows(parts[1].select("gameid").distinct(), "gameid") == [("G00003",)]
        assert exchanges(plan(independent_facts(parts[:1], profile)["fact_possessions"])) == []
        both = plan(independent_facts(parts, profile)["fact_possessions"])
        assert len(exchanges(both)) == 1  # the large game's own
        facts = independent_facts(parts, profile)
        for table in ("fact_shots", "fact_possessions", "fact_player_metrics"):
            names = FACT_SCHEMAS[table].fieldNames()
            assert rows(facts[table], *names) == rows(frames.facts[table], *names), table
    finally:
        staging.drop()


# ---- tables that change together ---------------------------------------------------------------


def _all(store):
    return {t: rows(store.read(t), *s.fieldNames()) for t, s in FACT_SCHEMAS.items()}


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
@pytest.mark.parametrize("failing", ["fact_shots", "fact_player_metrics", "fact_team_metrics"])
def test_a_failed_run_leaves_the_old_tables(spark, frames, tmp_path, monkeypatch, overwrite, failing):
    out = str(tmp_path / "out")
    run_pipeline(spark, frames.events.filter("season < 2018"), out)
    store = FactStore(spark, out)
    before = _all(store)
    write = FactStore.write

    def fail(self, table, *args):
        if table == failing:
            raise OSError("disk full")
        write(self, table, *args)

    monkeypatch.setattr(FactStore, "write", fail)
    with pytest.raises(OSError, match="disk full"):
        run_pipeline(spark, frames.events, out, overwrite=overwrite)
    assert _all(store) == before
    assert sorted(os.listdir(out)) == sorted(FACT_SCHEMAS)
    monkeypatch.undo()
    run_pipeline(spark, frames.events, out, overwrite=overwrite)
    assert _all(store) == _all(frames.store)


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_complete_set_is_put_in_place_by_the_next_reader(spark, frames, tmp_path, monkeypatch, overwrite, moves):
    out = str(tmp_path / "out")
    run_pipeline(spark, frames.events.filter("season < 2018"), out)
    move, done = FactStore._move, []

    def crash(self, source, target):
        if len(done) == moves:
            raise KeyboardInterrupt
        done.append(target)
        move(self, source, target)

    monkeypatch.setattr(FactStore, "_move", crash)
    with pytest.raises(KeyboardInterrupt):
        run_pipeline(spark, frames.events, out, overwrite=overwrite)
    monkeypatch.undo()
    assert _all(FactStore(spark, out)) == _all(frames.store)
    assert sorted(os.listdir(out)) == sorted(FACT_SCHEMAS)


def test_what_was_never_complete_can_be_removed(spark, frames, tmp_path):
    store = FactStore(spark, str(tmp_path))
    commit = store.commit()
    commit.write("fact_player_metrics", frames.player_metrics)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("fact_player_metrics")
    store.discard_unfinished()
    assert os.listdir(tmp_path) == []
    with pytest.raises(ValueError):
        store.commit("some")


# ---- file skipping -----------------------------------------------------------------------------


def _rows_scanned(df):
    """Rows that the scan handed on, whole row groups being read or skipped."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("by", ["bloom", "dictionary", "nothing"])
def test_row_groups_without_the_shooter_or_team_are_skipped(spark, tmp_path, monkeypatch, by):
    """Many files of a season, every file with shooters and teams from the whole range of names, so that
    neither minima and maxima nor the layout can skip any. Small dictionaries tell a reader as much as a
    Bloom filter, which is written where they spill; here, where they are turned off."""
    if by != "bloom":
        monkeypatch.setattr(fact_store, "BLOOM", {})
    monkeypatch.setattr(fact_store, "CLUSTERING", {**fact_store.CLUSTERING, "fact_shots": ("x",)})
    schema = FACT_SCHEMAS["fact_shots"]
    # 8 ranges of x; shooter and team follow from the range and lie all over the alphabet.
    shots = spark.range(16_000).selectExpr(
        "double(id) as x", "concat(if(id % 2 = 0, 'A', 'Z'), id div 2000, '-', id % 97) as shooter",
        "concat(if(id % 3 = 0, 'A', 'Z'), id div 2000) as team",
    )
    for field in schema:
        if field.name not in shots.columns:
            shots = shots.withColumn(field.name, F.lit(2020).cast(field.dataType))
    settings = {
        "spark.sql.adaptive.enabled": "false", "parquet.filter.columnindex.enabled": "false",
        "parquet.filter.stats.enabled": "false", "parquet.enable.dictionary": str(by == "dictionary").lower(),
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        store = FactStore(spark, str(tmp_path))
        store.write("fact_shots", shots)
        table = store.read("fact_shots")
        files = table.select(F.input_file_name()).distinct().count()
        assert files == 8
        one_shooter = serving.player_shot_points(table, "A3-41", 2020, 2020)
        one_team = serving.team_shot_points(table, ["Z5"], 2020, 2020)
        assert one_shooter.count() == shots.filter("shooter = 'A3-41'").count() > 0
        scanned = [_rows_scanned(one_shooter), _rows_scanned(one_team)]
        nobody = _rows_scanned(serving.player_shot_points(table, "M3-41", 2020, 2020))
    finally:
        for key in settings:
            spark.conf.unset(key)
    if by == "nothing":
        assert scanned == [16_000] * 2 and nobody == 16_000
    else:
        assert max(scanned) <= 16_000 * 3 // 8 and nobody == 0
