"""Raw event files."""

from __future__ import annotations

import posixpath
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_EVENTS

# Fixed value: monotonically_increasing_id counts the rows of a task in its lower 33 bits.
ROW_BITS = (1 << 33) - 1
# All event files of the folder. A file that does not hold events fails by its header.
DEFAULT_PATH = "data/raw/*.csv"


def get_raw_schema() -> T.StructType:
    return RAW_EVENTS


def ingest_data(
    spark: SparkSession, data_path: str | list[str] = DEFAULT_PATH, check_header: bool = True
) -> DataFrame:
    """CSV files with a header -> 16 raw columns and ``event_seq``.

    The schema is given, so no pass over the data infers it. Malformed fields become NULL. With
    ``check_header`` a file whose header does not name the 16 columns fails, and is named in the error,
    instead of being read by position.

    ``event_seq`` is the place of a row: a sortable key of its file, and its position there (start of
    the split plus row number). A split has more bytes than rows, so positions of one file are
    unique and follow the file whatever its splits. Files come by their names, the first three numbers
    within a name by value ("part_2" before "part_10"). Both parts are computed in the row, so no list of files is
    made or joined. The folder that holds all files is the same part of every key, so the order does not
    depend on where it lies; what of it the given paths spell out is left out of the keys. ``event_seq``
    is taken at the scan and must be kept with the rows from there on.
    """
    # One projection per step: a column that is used several times is computed once.
    named = _placed(spark, data_path, check_header).withColumn("_name", _name(data_path))
    position = F.col("_start") + F.col("_row")
    place = F.struct(sortable_name(F.col("_name")).alias("file"), position.alias("position"))
    return named.select(*RAW_EVENTS.fieldNames(), place.alias("event_seq"))


def ranked_events(
    spark: SparkSession, data_path: str | list[str] = DEFAULT_PATH, check_header: bool = True
) -> DataFrame:
    """The 16 raw columns of ``ingest_data`` and ``event_rank``, the rank of ``event_seq`` from 1.

    A row's rank is the rows of all splits before its own plus its number within the split, so rows are neither
    sorted nor dealt out; one task sees no more than its splits. What is ordered in one place is a row per split.
    """
    rows = _placed(spark, data_path, check_header)
    splits = rows.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # The keys of the names are made here, per split; equal names have equal keys.
    keyed = splits.withColumn("_name", _name(data_path)).withColumn("_file", sortable_name(F.col("_name")))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    # A task numbers the rows of its splits on and on: the first number of a split is taken off.
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    ranked = rows.join(F.broadcast(keyed.select("_path", "_start", shift.alias("_shift"))), ["_path", "_start"])
    rank = (F.col("_row") + F.col("_shift")).cast("int")
    return ranked.select(*RAW_EVENTS.fieldNames(), rank.alias("event_rank"))


def _placed(spark: SparkSession, data_path: str | list[str], check_header: bool) -> DataFrame:
    """The raw columns with the path of the file, the start of the split and the number of the row in its task."""
    rows = (
        spark.read.schema(RAW_EVENTS)
        .option("header", True)
        .option("enforceSchema", not check_header)
        .csv(data_path)
    )
    return rows.withColumns(
        {
            "_path": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)),
        }
    )


def _name(data_path: str | list[str]) -> Column:
    """The decoded path without the folder that the given paths name."""
    return _below(_decoded(F.col("_path")), literal_folder(data_path))


def _decoded(path: Column) -> Column:
    """With percent codes resolved, where there are any."""
    # A plus sign stands for itself in a path.
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def literal_folder(data_path: str | list[str]) -> str:
    """The folder above all files that the paths name before any pattern, between slashes; "" for none."""
    folders = []
    for path in [data_path] if isinstance(data_path, str) else data_path:
        plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path)
        folders.append(posixpath.dirname(re.split(r"[*?\[{\\]", plain, maxsplit=1)[0]))
    if not all(folders) or len({f.startswith("/") for f in folders}) > 1:
        return ""
    common = posixpath.normpath(posixpath.commonpath(folders))
    return "" if common in (".", "/") or ".." in common.split("/") else f"/{common.strip('/')}/"


def _below(path: Column, folder: str) -> Column:
    """What follows the folder's first place in the path: the same place in the path of every file below it."""
    if not folder:
        return path
    at = F.instr(path, F.lit(folder))
    return F.when(at > 0, F.substr(path, at + F.lit(len(folder)))).otherwise(path)


# Numbers of a name that are taken by value, from the left; what follows them goes by characters.
NUMBERS = 3


def sortable_name(name: Column) -> Column:
    """A text that sorts by code points as the name does with its first NUMBERS numbers taken by value.

    Each of them, without leading zeros, has the number of its digits before it, in three places. Names
    that differ in leading zeros only are told apart by the name itself, put behind.
    """
    pattern = "^" + "([^0-9]*)0*([0-9]*)" * NUMBERS + "((?s).*)$"
    part = [F.regexp_extract(name, pattern, i + 1) for i in range(2 * NUMBERS + 1)]
    sized = [p if i % 2 == 0 else F.concat(F.lpad(F.length(p).cast("string"), 3, "0"), p) for i, p in enumerate(part)]
    key = F.concat(*sized)
    zeros = F.length(key) < F.length(name) + 3 * NUMBERS
    return F.when(zeros, F.concat(key, F.lit("\0"), name)).otherwise(key)
