"""Centroid clustering with exact integer distances by bit planes (operator 13).

Vectors of WIDTH = 64 components, scaled to integers, are kept as bit planes: bit j of all 64 components of a
vector is one unsigned 64-bit number, the top plane being the sign. The inner product of a vector and a centroid
is the sum over pairs of planes of 2^i 2^j times the bits that the planes share (an AND and a population
count), the sign planes counting negative; distances follow from it and the squared lengths. All of it is exact.

Vectors are packed and staged once, in blocks of at most BLOCK, and every round reads the blocks: each task
assigns its vectors and adds up the members of every centroid; one row per centroid, component and task is
shuffled, and K * 64 totals come to the driver, whatever the size of the table. Centroids are K vectors, so what
goes to the tasks is bounded as well.

Defined results: vectors that are NULL, have another number of components, or hold NULL or non-finite ones, are
left out; scaled components are held within +-2^24, beyond which no embedding lies; a NULL vec_id takes part but
starts no centroid while others can; repeated rows are vectors of their own; equal distances go to the smaller
centroid number; of start vectors with one vec_id the one with smaller components comes first; with fewer
vectors than centroids all of them start one; an empty table gives an empty result; other columns, of any
name, are not read. There is no text here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, stage
from .vectors import integer_vectors, matrix, numbers

WIDTH = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: Largest scaled component either way.
BOUND = 1 << 24
#: Vectors packed together, and vectors compared at once.
BLOCK, STRIP = 8192, 1024


def pack(values: np.ndarray) -> np.ndarray:
    """(planes, n) unsigned 64-bit numbers of n vectors of 64 integers, in two's complement with as many
    planes as the largest needs."""
    most = int(np.maximum(values, ~values).max()) if values.size else 0
    planes = most.bit_length() + 1
    out = np.empty((planes, len(values)), "<u8")
    for j in range(planes):
        bits = ((values >> j) & 1).astype(np.uint8)
        out[j] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def unpack(planes: np.ndarray) -> np.ndarray:
    """The (n, 64) integers of packed vectors."""
    out = np.zeros((planes.shape[1], WIDTH), np.int64)
    for weight, plane in zip(_weights(len(planes)), planes):
        bits = np.unpackbits(np.ascontiguousarray(plane).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits * np.int64(weight)
    return out


def _weights(planes: int) -> list[int]:
    return [1 << j for j in range(planes - 1)] + [-(1 << (planes - 1))]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(vectors, centroids) inner products of packed vectors and packed centroids."""
    out = np.zeros((x.shape[1], c.shape[1]), np.int64)
    wx, wc = _weights(len(x)), _weights(len(c))
    for i, a in enumerate(x):
        for j, b in enumerate(c):
            out += np.bitwise_count(a[:, None] & b[None, :]) * np.int64(wx[i] * wc[j])
    return out


def nearest(x: np.ndarray, squares: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid number, squared distance) of packed vectors with their squared lengths."""
    c, own = pack(centroids), (centroids * centroids).sum(axis=1)
    cluster, distance = np.empty(len(squares), np.int64), np.empty(len(squares), np.int64)
    for i in range(0, len(squares), STRIP):
        j = min(i + STRIP, len(squares))
        apart = own[None, :] - 2 * products(x[:, i:j], c)
        cluster[i:j] = apart.argmin(axis=1)  # the first of equal ones
        distance[i:j] = apart[np.arange(j - i), cluster[i:j]] + squares[i:j]
    return cluster, distance


# ---- blocks ----------------------------------------------------------------------------------

_BLOCKS = "n int, ids binary, named binary, squares binary, planes binary"


def _packed(vectors: DataFrame) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                values = matrix(part.column(1)).astype(np.int64)
                ids, named = numbers(part.column(0))
                content = (ids, named, (values * values).sum(axis=1), pack(values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in content)],
                    ["n", "ids", "named", "squares", "planes"],
                )

    return vectors.mapInArrow(blocks, _BLOCKS)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, named, squares, planes) of every block."""
    types = (np.int64, bool, np.int64, "<u8")
    for batch in batches:
        for r in range(batch.num_rows):
            n = batch.column(0)[r].as_py()
            content = [np.frombuffer(batch.column(1 + i)[r].as_buffer(), t) for i, t in enumerate(types)]
            yield (*content[:3], content[3].reshape(-1, n))


def _totals(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """(members, sum of every component) of the centroids that have members."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for _, _, squares, planes in _opened(batches):
            cluster, _ = nearest(planes, squares, centroids)
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            present = cluster[order][first]
            sums[present] += np.add.reduceat(unpack(planes)[order], first, axis=0)
            members += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, WIDTH).astype(np.int32)),
                pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(met))),
                pa.array(np.repeat(members[met], WIDTH)),
                pa.array(sums[met].ravel()),
            ],
            ["cluster", "component", "n", "total"],
        )

    parts = blocks.mapInArrow(add, "cluster int, component int, n bigint, total bigint")
    wide = F.sum(F.col("total").cast("decimal(20,0)"))
    # At most CENTROIDS * WIDTH rows.
    rows = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), wide.alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * WIDTH))[1][r["component"]] = int(r["total"])
    return out


def start_vectors(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes of their vec_id, in order."""
    hashed = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(hashed.alias("h"), "values").orderBy(F.col("h").asc_nulls_last(), "values").limit(k)
    return np.array([r["values"] for r in rows.collect()], np.int64).reshape(-1, WIDTH)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    spark = vectors.sparkSession
    own = integer_vectors(vectors, scale, BOUND, WIDTH)
    centroids = start_vectors(own, k)
    with Workspace(spark) as work:
        blocks = work.stage(_packed(own), "blocks")
        for _ in range(rounds if len(centroids) else 0):
            totals = _totals(blocks, centroids)
            centroids = np.array(
                [[s // totals[c][0] for s in totals[c][1]] if c in totals else row for c, row in enumerate(centroids.tolist())],
                np.int64,
            )

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, named, squares, planes in _opened(batches):
                cluster_, distance = nearest(planes, squares, centroids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=~named), pa.array(cluster_.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

        assigned = stage(blocks.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "assigned")
    # At most CENTROIDS rows.
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    texts = [",".join(map(str, row)).encode() for row in centroids.tolist()]
    known = [(c, s, sum(per.values()), hashlib.sha256(texts[c]).hexdigest()) for c, s in per.items()]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return assigned.join(F.broadcast(spark.createDataFrame(known, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
