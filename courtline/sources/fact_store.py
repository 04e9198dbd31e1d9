"""The four fact tables as Parquet, one directory per season."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FACT_SCHEMAS

# Columns that order the rows inside a season, so that row-group statistics can skip most of a
# season when a query asks for one shooter, and the rows of a game lie together.
CLUSTERING = {
    "fact_shots": ("shooter",),
    "fact_possessions": ("gameid",),
    "fact_team_metrics": ("team",),
    "fact_player_metrics": ("player",),
}

RANGED = ("fact_shots",)

# Columns with a Bloom filter per row group, and the distinct values that a season may have of them: some
# 6 KB per filter. Parquet writes one where a column's dictionary spills; a whole dictionary tells as much.
BLOOM = {
    "fact_shots": {"shooter": 5_000, "team": 500},
    "fact_player_metrics": {"player": 5_000, "team": 500},
}

# Written beside the tables: a set of tables on its way, and the note that it is complete.
STAGED, READY = "_staged-", "_ready-"


class FactStore:
    """Fact tables under one root path.

    Several tables can be replaced together, see ``commit``. A set that is complete but not yet in its
    place, because the program ended meanwhile, is put there by the next read or write.
    """

    def __init__(self, spark: SparkSession, root: str = "data/processed"):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        if table not in FACT_SCHEMAS:
            raise KeyError(f"unknown fact table {table!r}; known: {', '.join(FACT_SCHEMAS)}")
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """Scan with the declared schema; season comes from the directory names."""
        self.settle()
        return self.spark.read.schema(FACT_SCHEMAS[table]).parquet(self.path(table))

    def read_or_empty(self, table: str) -> DataFrame:
        """Like read, but a table that was never written is empty. Other errors are raised."""
        try:
            return self.read(table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], FACT_SCHEMAS[table])

    def write(self, table: str, rows: DataFrame, overwrite: str = "static") -> None:
        """Replace the table, or with ``overwrite="dynamic"`` only the seasons in ``rows``.

        The rebalance gathers a season into files of the advisory size and splits large seasons,
        instead of one small file per task and season. Shots are dealt out by ranges of season and
        shooter instead, so that in a season of many files one player's shots lie in few of them;
        a hash of the row splits a shooter, or NULL, that fills a range alone.
        """
        if overwrite not in ("static", "dynamic"):
            raise ValueError(f"overwrite must be static or dynamic, not {overwrite!r}")
        self.settle()
        named = rows.select(*FACT_SCHEMAS[table].fieldNames())
        if table in RANGED:
            spread = F.xxhash64(*named.columns)
            dealt = named.repartitionByRange("season", *CLUSTERING[table], spread)
        else:
            dealt = named.hint("rebalance", "season")
        writer = dealt.sortWithinPartitions("season", *CLUSTERING[table]).write
        for column, distinct in BLOOM.get(table, {}).items():
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
        (
            writer.option("partitionOverwriteMode", overwrite)
            .partitionBy("season")
            .mode("overwrite")
            .parquet(self.path(table))
        )

    # ---- several tables at once --------------------------------------------------------------

    def commit(self, overwrite: str = "static") -> FactCommit:
        """Tables written in the ``with`` block replace the present ones together when it ends, or none of
        them does when it fails. One commit at a time."""
        return FactCommit(self, overwrite)

    def settle(self) -> None:
        """Put complete sets in their place. Moves folders only, and can be repeated at any point."""
        for note in self._names(self.root, READY):
            mode, number = note.removeprefix(READY).split("-", 1)
            staged = f"{self.root}/{STAGED}{number}"
            for table in self._names(staged, "fact_"):
                if mode == "static":
                    self._move(f"{staged}/{table}", f"{self.root}/{table}")
                    continue
                for season in self._names(f"{staged}/{table}", "season="):
                    self._move(f"{staged}/{table}/{season}", f"{self.root}/{table}/{season}")
            self._delete(staged)
            self._delete(f"{self.root}/{note}")

    def discard_unfinished(self) -> None:
        """Remove sets that a program left behind before they were complete. Not while one is written."""
        self.settle()
        for name in self._names(self.root, STAGED):
            self._delete(f"{self.root}/{name}")

    def _files(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        at = hadoop.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, folder: str, prefix: str) -> list[str]:
        files, at = self._files(folder)
        if not files.exists(at):
            return []
        return sorted(n for n in (s.getPath().getName() for s in files.listStatus(at)) if n.startswith(prefix))

    def _delete(self, path: str) -> None:
        files, at = self._files(path)
        files.delete(at, True)

    def _move(self, source: str, target: str) -> None:
        files, at = self._files(target)
        files.delete(at, True)
        files.mkdirs(at.getParent())
        if not files.rename(self._files(source)[1], at):
            raise OSError(f"cannot move {source} to {target}")

    def _create(self, path: str) -> None:
        files, at = self._files(path)
        files.create(at, False).close()


class FactCommit:
    """Tables on their way into a store. They are written beside the present ones; one small file then
    says that the set is complete, and from there on every reader gets the new set."""

    def __init__(self, store: FactStore, overwrite: str = "static"):
        if overwrite not in ("static", "dynamic"):
            raise ValueError(f"overwrite must be static or dynamic, not {overwrite!r}")
        self.store, self.overwrite = store, overwrite
        self.number = uuid.uuid4().hex
        self.staged = FactStore(store.spark, f"{store.root}/{STAGED}{self.number}")

    def write(self, table: str, rows: DataFrame) -> None:
        self.staged.write(table, rows)

    def read(self, table: str) -> DataFrame:
        """What was written in this block."""
        return self.staged.read(table)

    def __enter__(self) -> FactCommit:
        self.store.settle()
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is not None:
            self.store._delete(self.staged.root)
            return
        self.store._create(f"{self.store.root}/{READY}{self.overwrite}-{self.number}")
        self.store.settle()
