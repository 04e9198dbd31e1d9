"""Sharding along a Hilbert curve (operator 6).

Source, language, document id and size are quantised to a few bits each; documents are ordered by the
index of their cell on the Hilbert curve and the order is cut into runs of equal length. Neighbours on
the curve are alike in all four, so the statistics of a shard's files prune on any of them.

Law ``rows``: shard sizes in documents differ by one at most. Equal texts are neighbours: all of them are
placed by the cell of the first one, that with the least doc_id, so only a cut between two shards, of which
there is one less than shards, can part them.

Defined results: NULL text has 8 bytes and is equal to empty text; very long texts count by their bytes; NULL
ids, sources and languages have cells of their own value (ordered last, ids first); within a cell documents go
by text, then by doc_id, size, source and language, and rows that repeat all of these take neighbouring slots;
fewer documents than shards leave shards empty; an empty table gives an empty result; other columns, of any
name, are not read, and ``write_shards`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import global_positions, lookup, small, stage, unused

SHARDS = 24
BITS = 6
OVERHEAD = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of rows of ``n`` coordinates below 2^bits (n * bits <= 62).

    Transposed form of the published method by rotations and reflections of subcubes: work down from
    the high bit, exchange or invert the lower bits of each axis against the first, then undo the
    Gray code and interleave the bits.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ flip) >> b) & 1)
    return index


@F.pandas_udf(LongType())
def _curve(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for columns in batches:
        yield pd.Series(hilbert_index(np.column_stack([c.to_numpy(np.int64) for c in columns]), BITS))


def _ordinal(df: DataFrame, column: str, name: str, total: int) -> DataFrame:
    """Quantise a text column: the share of rows with smaller values, in 2^BITS steps."""
    counts = small(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    placed = global_positions(counts, [F.col(column).asc_nulls_last()], {"_before": F.col("_n")})
    cell = F.expr(f"cast(_before * {1 << BITS} div {max(total, 1)} as int)").alias(name)
    return lookup(df, small(placed.select(column, cell)), [column])


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, source, lang, size, text_crc32, hilbert, shard, slot of every document."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    meta = stage(
        docs.select("doc_id", "source", "lang", size.alias("size"), crc.alias("text_crc32"), text.alias("_text")), "meta"
    )
    facts = meta.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    total, low, high = facts[0], facts[1] or 0, facts[2] or 0
    top = (1 << BITS) - 1
    cells = _ordinal(_ordinal(meta, "source", "_c0", total), "lang", "_c1", total)
    step = (high - low) // (top + 1) + 1
    by_id = F.coalesce(F.floor((F.col("doc_id") - low) / step), F.lit(0)).cast("int")
    by_size = F.least(F.floor(F.log2(F.col("size") / OVERHEAD) * 4), F.lit(top)).cast("int")
    indexed = cells.withColumn("hilbert", _curve("_c0", "_c1", by_id, by_size)).drop("_c0", "_c1")
    indexed = _beside_equals(stage(indexed, "cells"))
    order = [F.col(c) for c in ("hilbert", *_TEXT, "doc_id", "source", "lang")]
    ranked = global_positions(indexed, order, {"_rank": F.lit(1)})
    n = max(total, 1)
    cut = ranked.withColumn("shard", F.expr(f"cast(_rank * {shards} div {n} as int)"))
    slot = F.expr(f"_rank - (cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return cut.withColumn("slot", slot).drop("_rank", "_text")


# What tells texts apart: 96 bits of hashes and the size.
_TEXT = ("text_crc32", "_text", "size")


def _beside_equals(indexed: DataFrame) -> DataFrame:
    """Equal texts at the place of the first of them. Cells are added up before the shuffle, so a text of very
    many rows is no hot key; what is looked up are the texts whose rows have different cells."""
    cells = indexed.groupBy(*_TEXT).agg(
        F.min(F.struct("doc_id", "hilbert"))["hilbert"].alias("_first"),
        F.min("hilbert").alias("_low"), F.max("hilbert").alias("_high"),
    )
    moved = stage(cells.filter("_low < _high").select(*_TEXT, "_first"), "moved")
    placed = lookup(indexed, moved, list(_TEXT), F.xxhash64("doc_id", "source", "hilbert"))
    return placed.withColumn("hilbert", F.coalesce("_first", "hilbert")).drop("_first")


def contract(sharded: DataFrame) -> DataFrame:
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents in ``path``, one folder per shard, sorted along the curve.

    A shard is written by as many tasks as its rows ask for: the rebalance splits large ones.
    """
    row = unused(docs, "_row")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    placed = shard(held.drop("doc_id").withColumn("doc_id", F.col(row)), shards)
    place = placed.select(F.col("doc_id").alias(row), "shard", "slot")
    joined = held.join(place, row).drop(row)
    joined.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
