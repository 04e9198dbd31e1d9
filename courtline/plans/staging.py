"""Intermediate tables in the shared working folder of the cluster.

A frame that feeds several jobs is written once and read back. The tables survive the loss of
executors and cut the lineage, and each reader scans only the columns it needs. They are managed
tables of a database of their own, so that dropping the database removes their files.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, one temporary folder for this
    process in local mode, removed at its end; on a cluster an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="courtline-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    return _LOCAL["dir"]


class Staging:
    """A database for the intermediate tables of one run, in a subfolder of the working folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"stage_{uuid.uuid4().hex}"
        self.root = f"{work_dir(spark)}/{self.name}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{self.root}'")

    def keep(
        self, df: DataFrame, name: str, key: str | None = None, buckets: int | None = None
    ) -> DataFrame:
        """Write and read back; with ``key``, bucketed so that grouping by it needs no exchange."""
        writer = df.write.format("parquet")
        if key is not None and buckets is not None:
            writer = writer.bucketBy(buckets, key)
        writer.saveAsTable(f"{self.name}.{name}")
        return self.spark.table(f"{self.name}.{name}")

    def bytes(self, name: str) -> int:
        """Size of the files of a kept table."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        sizes = files.option("pathGlobFilter", "*.parquet").load(f"{self.root}/{name}")
        return sizes.agg(F.sum("length")).first()[0] or 0

    def drop(self) -> None:
        """Remove the tables, their files and the subfolder."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")


#: Compressed bytes of a staged table per shuffle partition: some 0.5 to 1 GB of rows.
STAGED_BYTES_PER_PARTITION = 256 * 1024 * 1024


def partitions_for(spark: SparkSession, staged_bytes: int) -> int:
    """Shuffle partitions for a staged table, never fewer than the session asks for."""
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, math.ceil(staged_bytes / STAGED_BYTES_PER_PARTITION))


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Plans made inside have ``n`` shuffle partitions.

    Adaptive execution merges partitions that turn out small but cannot split those of a window,
    so the number must be right for large inputs before the job starts. The setting belongs to the
    session: do not run other jobs in the same session meanwhile.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)
