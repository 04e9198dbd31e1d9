"""Helpers shared by the operators: staging in the shared folder, lookups of small tables, global
positions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A lookup table is broadcast up to this many rows of a few hundred bytes; beyond, it is dealt out.
BROADCAST_ROWS = 100_000
# Copies of each lookup row, and parts of each hot key, when a lookup is dealt out.
SALTS = 32

# ASCII white space, as in the pattern [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (tests), one is made, set and at the end of
    this process removed."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "dir" not in _OWN:
            _OWN["dir"] = tempfile.mkdtemp(prefix="llm-shared-")
            atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
        folder = _OWN["dir"]
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_OWN: dict[str, str] = {}
#: By application and shared folder, the database in whose folder its staged tables lie.
_SCRATCH: dict[tuple[str, str], str] = {}


def scratch(spark: SparkSession) -> str:
    """A folder of this application in the shared one. It is the place of a database without tables,
    through which Spark itself removes it, see ``release``."""
    own = (spark.sparkContext.applicationId, shared_dir(spark))
    if own not in _SCRATCH:
        name = f"llm_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{own[1]}/{name}'")
        _SCRATCH[own] = name
    return f"{own[1]}/{_SCRATCH[own]}"


def release(spark: SparkSession) -> None:
    """Remove what operators of this application have staged and not removed themselves. Results that
    were not written or read by then cannot be read any more; what is staged later has a new folder."""
    name = _SCRATCH.pop((spark.sparkContext.applicationId, shared_dir(spark)), None)
    if name is not None:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def text_batches(spark: SparkSession) -> None:
    """Let rows with whole texts go to Python in batches of some MB, not of 10,000 rows or 64 MB. The
    settings stay: they are read when the plan runs, and only lower what a task holds at once."""
    for key, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors. The files
    stay until ``release``, as results read them."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Staged tables of one computation in a database of their own in the shared folder. On leaving the
    ``with`` block the database goes with its files: what is returned must not read them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.n = spark, 0
        self.name = f"llm_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{shared_dir(spark)}/{self.name}'")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        table = f"{self.name}.{name}_{self.n}"
        df.write.format("parquet").saveAsTable(table)
        return self.spark.table(table)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")


def small(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder, for tables that are small next to the input."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """A column name that does not occur in ``df`` (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lookup(
    df: DataFrame, table: DataFrame, keys: list[str], spread: Column | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join, NULL equal to NULL, of ``df`` with a staged ``table`` of one row per key.

    A table of at most ``limit`` rows is broadcast. A larger one is copied ``SALTS`` times and joined
    on the key and a salt, so that a key with a third of the rows is spread over SALTS tasks. Spark's
    estimate of its size leaves the copies out, so the hint keeps it from broadcasting all of them.
    """
    renamed = {k: unused(df, f"_k{i}_{k}") for i, k in enumerate(keys)}
    right = table.withColumnsRenamed(renamed)
    if table.limit(limit + 1).count() <= limit:
        right, extra = F.broadcast(right), []
    else:
        salt, other = unused(df, "_salt"), unused(df, "_salt_of")
        source = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)) if spread is None else spread
        df = df.withColumn(salt, F.pmod(source, F.lit(SALTS)).cast("int"))
        right = right.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        extra = [(salt, other)]
    condition = F.lit(True)
    for k, r in renamed.items():
        condition &= df[k].eqNullSafe(right[r])
    for a, b in extra:
        condition &= df[a] == right[b]
    joined = df.join(right, condition, "left")
    return joined.drop(*renamed.values(), *(x for pair in extra for x in pair))


def having(
    df: DataFrame, key: str, ids: DataFrame, limit: int = 2_000_000, how: str = "semi"
) -> DataFrame:
    """Rows of ``df`` whose key, NULL included, is in the staged one-column table ``ids`` of numbers, or
    with how="anti" is not.

    Up to ``limit`` ids (16 MB of numbers) are broadcast; more are joined by a shuffle.
    """
    (name,) = ids.columns
    other = unused(df, "_id_of")
    right = ids.select(F.col(name).alias(other)).distinct()
    if ids.limit(limit + 1).count() <= limit:
        right = F.broadcast(right)
    return df.join(right, df[key].eqNullSafe(right[other]), how)


def global_positions(
    df: DataFrame, order: list[Column], sums: dict[str, Column], parts: int | None = None,
    within: list[str] | None = None,
) -> DataFrame:
    """Running totals over the whole table in a total order, exclusive of the row itself.

    Rows are dealt out by ranges of the order and staged, a window adds up each range, and the
    totals of the ranges, one row per range and group, give every range its start. ``sums`` maps new
    column names to what is summed; ``within`` restarts the sums in every group of these columns,
    which must lead the order. No task sees more than one range.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    dealt = stage(dealt.withColumns({f"_v_{n}": c.cast("long") for n, c in sums.items()}), "ranges")
    keys = within or []
    totals = dealt.groupBy(*keys, "_range").agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums))
    # One row per range and group: bounded by the number of ranges plus groups.
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        *keys, "_range", *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums)
    )
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = dealt.withColumns(
        {f"_l_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in sums}
    )
    joined = lookup(local, small(starts), ["_range", *keys])
    placed = joined.withColumns({n: F.col(f"_l_{n}") + F.col(f"_s_{n}") for n in sums})
    return placed.drop("_range", *(f"_{x}_{n}" for n in sums for x in "vls"))


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
