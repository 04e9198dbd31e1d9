"""Exact top-k search by inner product, vectors grouped by length (operator 11).

Vectors are scaled to integers, dealt out by ranges of their length into buckets, longest first, and packed in
blocks of like length. A query first meets the block of the longest vectors; its k-th best product there is a
lower bound for what it looks for. With that bound, a block of vectors no longer than l needs a cosine of at
least bound / (|query| * l), the local threshold, which decides per query and block:

- above 1, the block is left out (and where that holds for all queries of a block of queries, never sent);
- high thresholds prune by coordinates: a unit vector within the threshold's angle of the query has every
  coordinate within known limits, so the narrowest of the query's largest coordinates is read from a
  sorted list of the block, the others are checked, and only what is left is verified;
- low thresholds, where those limits hold most of the block, prune by length: the block's vectors down to
  the length bound / |query| are verified at once as one product of matrices.

Verified products raise the bound for the blocks that follow. All scores are exact integers.

Queries go in blocks of QUERIES to every bucket that they need, and meet it in a join on the bucket's number;
no task holds more than a block of either side and k results per query of a block. A bucket is a share of all
vectors, so beyond GROUP blocks of queries its work is dealt out to several tasks.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part; a vector that is
shorter than another counts as zero behind its end, an empty one has the score 0 with all; components are
held within +-2^26 after scaling, so that products fit; a row is no candidate for itself, but rows that repeat it
are; of equal scores the smaller vec_id comes first, NULL last; a row with a NULL vec_id is a candidate and
no query; queries with fewer than k candidates get them all; an empty table gives an empty result; other
columns, of any name, are not read. There is no text here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, shuffle_parts, stage, text_batches
from .vectors import integer_vectors, matrix, numbers

SCALE = 64
K = 20
#: A row is a query if its vec_id is divisible by this.
EVERY = 20
BOUND = 1 << 26
#: Vectors and bytes of a block at most; queries of a block.
BLOCK, BLOCK_BYTES, QUERIES = 4096, 1 << 20, 1024
#: Blocks of queries that one task takes through a bucket.
GROUP = 64
#: Local threshold from which coordinates are tried, how many, and the share of a block that they may leave.
COORDINATES_FROM, FOCUS, SHARE = 0.8, 3, 8
#: No bound yet.
NONE = -(1 << 62)
_SLACK = 1e-9


@dataclass
class Block:
    """Vectors in descending length: row numbers, ids, which ids are known, squared lengths, components."""

    rows: np.ndarray
    ids: np.ndarray
    named: np.ndarray
    squares: np.ndarray
    values: np.ndarray

    def __post_init__(self) -> None:
        self.lengths = np.sqrt(self.squares.astype(np.float64))
        self.most = int(np.abs(self.values).max()) if self.values.size else 0
        self._as: dict[type, np.ndarray] = {}
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._unit: np.ndarray | None = None

    def as_type(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.values.astype(kind)
        return self._as[kind]

    @property
    def unit(self) -> np.ndarray:
        """Vectors of length one; those of length zero lie outside all limits."""
        if self._unit is None:
            with np.errstate(divide="ignore", invalid="ignore"):
                self._unit = np.where(self.lengths[:, None] > 0, self.values / self.lengths[:, None], 9.0)
        return self._unit

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, coordinates) in the order of coordinate f."""
        if f not in self._sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._sorted[f] = order, self.unit[order, f]
        return self._sorted[f]


def exact_type(q: Block, c: Block) -> type:
    """A type in which products of these blocks are exact; the floating ones are much faster."""
    largest = q.most * c.most * max(q.values.shape[1], 1)
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


class Best:
    """The k best scores of every query of a block so far, and the bounds that follow from them."""

    def __init__(self, n: int, theta: np.ndarray | None = None, k: int = K) -> None:
        self.k = k
        self.theta = np.full(n, NONE, np.int64) if theta is None else theta.copy()
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.named = np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray, named: np.ndarray) -> None:
        if not len(query):
            return
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        id_, named = np.concatenate([self.id, id_]), np.concatenate([self.named, named])
        order = np.lexsort((id_, ~named, -score, query))
        query, score, id_, named = query[order], score[order], id_[order], named[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        last = np.flatnonzero(place == self.k - 1)
        self.theta[query[last]] = np.maximum(self.theta[query[last]], score[last])
        keep = place < self.k
        self.query, self.score, self.id, self.named = query[keep], score[keep], id_[keep], named[keep]


def local_thresholds(q: Block, c: Block, theta: np.ndarray) -> np.ndarray:
    """The cosine with a vector of the block that a query needs at least; -inf where no bound helps."""
    longest = c.lengths[0] if len(c.lengths) else 0.0
    with np.errstate(divide="ignore"):
        local = theta / (q.lengths * longest)
    return np.where(theta > 0, local * (1 - _SLACK), -np.inf)


def search(q: Block, c: Block, best: Best) -> None:
    """Meet a block of queries with a block of vectors."""
    width = min(q.values.shape[1], c.values.shape[1])
    if not len(c.rows) or not len(q.rows):
        return
    local = local_thresholds(q, c, best.theta)
    alive = local <= 1
    # How many vectors are long enough.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(best.theta > 0, best.theta / q.lengths * (1 - _SLACK), 0.0)
    enough = len(c.rows) - np.searchsorted(c.lengths[::-1], need, "left")
    by_coordinate = np.zeros(len(q.rows), bool)
    tried = np.flatnonzero(alive & (local >= COORDINATES_FROM))
    if len(tried) and width >= FOCUS:
        by_coordinate[tried] = _by_coordinates(q, c, tried, local, enough, best)
    at = np.flatnonzero(alive & ~by_coordinate & (enough > 0))
    if len(at):
        _by_length(q, c, at, enough, width, best)


def _by_length(q: Block, c: Block, at: np.ndarray, enough: np.ndarray, width: int, best: Best) -> None:
    kind = exact_type(q, c)
    n = int(enough[at].max())
    scores = q.as_type(kind)[at, :width] @ c.as_type(kind)[:n, :width].T
    theta = best.theta[at]
    bound = theta if kind is np.int64 else np.where(theta == NONE, -np.inf, theta).astype(kind)
    query, place = np.nonzero(scores >= bound[:, None])
    score, query = scores[query, place].astype(np.int64), at[query]
    other = q.rows[query] != c.rows[place]
    query, place, score = query[other], place[other], score[other]
    best.add(query, score, c.ids[place], c.named[place])


def _by_coordinates(
    q: Block, c: Block, tried: np.ndarray, local: np.ndarray, enough: np.ndarray, best: Best
) -> np.ndarray:
    """Search the queries ``tried`` whose limits are narrow; which of them were searched."""
    t = local[tried]
    unit = q.unit[tried, : min(q.values.shape[1], c.values.shape[1])]
    focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
    own = np.take_along_axis(unit, focus, axis=1)
    # The angle to an axis differs from the query's own by the threshold's angle at most.
    angle, reach = np.arccos(np.clip(own, -1, 1)), np.arccos(np.clip(t, -1, 1))[:, None]
    low = np.cos(np.minimum(angle + reach, np.pi)) - _SLACK
    high = np.cos(np.maximum(angle - reach, 0)) + _SLACK
    from_, to = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus):
        r, j = np.nonzero(focus == f)
        values = c.by_coordinate(f)[1]
        from_[r, j] = np.searchsorted(values, low[r, j], "left")
        to[r, j] = np.searchsorted(values, high[r, j], "right")
    narrowest = (to - from_).argmin(axis=1)
    row = np.arange(len(tried))
    few = (to - from_)[row, narrowest] * SHARE <= enough[tried]
    kind = exact_type(q, c)
    width = unit.shape[1]
    found: list[tuple[np.ndarray, ...]] = []
    for i in np.flatnonzero(few):
        j, query = narrowest[i], tried[i]
        place = c.by_coordinate(focus[i, j])[0][from_[i, j] : to[i, j]]
        place = place[place < enough[query]]
        for other in range(FOCUS):
            if other != j and len(place):
                x = c.unit[place, focus[i, other]]
                place = place[(x >= low[i, other]) & (x <= high[i, other])]
        place = place[c.rows[place] != q.rows[query]]
        score = (c.as_type(kind)[place, :width] @ q.as_type(kind)[query, :width]).astype(np.int64)
        hit = score >= best.theta[query]
        place, score = place[hit], score[hit]
        found.append((np.full(len(place), query), score, c.ids[place], c.named[place]))
    if found:
        best.add(*(np.concatenate(x) for x in zip(*found)))
    return few


# ---- blocks in tables --------------------------------------------------------------------------

_BINARY = ("rows", "ids", "named", "squares", "content")
_BLOCK = "n int, width int, bytes int, longest double, queries int, rows binary, ids binary, named binary, squares binary, content binary"
_NAMES = ["n", "width", "bytes", "longest", "queries", *_BINARY]


def _packed(block: Block) -> list:
    small = block.most < 1 << 15
    values = block.values.astype(np.int16 if small else np.int32)
    queries = int((block.named & (block.ids % EVERY == 0)).sum())
    return [
        len(block.rows), values.shape[1], values.itemsize, float(block.lengths[0]), queries,
        *(x.tobytes() for x in (block.rows, block.ids, block.named, block.squares, values)),
    ]


def _block(batch: pa.RecordBatch, r: int, prefix: str = "") -> Block:
    def get(name: str) -> pa.Scalar:
        return batch.column(batch.schema.get_field_index(prefix + name))[r]

    n, width, size = (get(x).as_py() for x in ("n", "width", "bytes"))
    types = (np.int64, np.int64, bool, np.int64, np.int16 if size == 2 else np.int32)
    content = [np.frombuffer(get(x).as_buffer(), t) for x, t in zip(_BINARY, types)]
    return Block(*content[:4], content[4].reshape(n, width))


def _merged(blocks: list[Block]) -> Block:
    """One block of several, in descending length."""
    width = max(b.values.shape[1] for b in blocks)
    values = np.concatenate([np.pad(b.values.astype(np.int32), ((0, 0), (0, width - b.values.shape[1]))) for b in blocks])
    rest = [np.concatenate([getattr(b, x) for b in blocks]) for x in _BINARY[:4]]
    order = np.argsort(-rest[3], kind="stable")
    return Block(*(x[order] for x in rest), values[order])


def _pack_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Block]:
    """Blocks of rows (row, vec_id, square, values) in their order."""
    held: list[Block] = []
    n = width = 0
    for batch in batches:
        values = matrix(batch.column(3))
        own = max(values.shape[1], 1)
        step = max(1, min(most, BLOCK_BYTES // (4 * own)))
        ids, named = numbers(batch.column(1))
        rows, squares = (batch.column(i).to_numpy() for i in (0, 2))
        for i in range(0, batch.num_rows, step):
            part = slice(i, i + step)
            block = Block(rows[part], ids[part], named[part], squares[part], values[part])
            width = max(width, own)
            if held and (n + len(block.rows) > most or (n + len(block.rows)) * width * 4 > BLOCK_BYTES):
                yield _merged(held)
                held, n, width = [], 0, own
            held.append(block)
            n += len(block.rows)
    if held:
        yield _merged(held)


def _table(blocks: list[Block]) -> pa.RecordBatch:
    columns = list(zip(*map(_packed, blocks)))
    types = [pa.int32()] * 3 + [pa.float64(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _NAMES)


def _numbered(own: DataFrame) -> DataFrame:
    """(row, vec_id, square, values) with a number per row and its squared length."""
    square = F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
    return own.select(F.monotonically_increasing_id().alias("row"), "vec_id", square.alias("square"), "values")


def _candidates(rows: DataFrame, buckets: int, work: Workspace) -> DataFrame:
    """Staged blocks with the number of their bucket; lengths fall from bucket to bucket."""
    order = [F.col("square").desc(), F.xxhash64("row")]  # equal lengths, however many, go to several buckets
    dealt = rows.repartitionByRange(buckets, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _pack_rows(batches, BLOCK):
            yield _table([block])

    packed = dealt.select("row", "vec_id", "square", "values").mapInArrow(pack, _BLOCK)
    return work.stage(packed.withColumn("bucket", F.spark_partition_id()), "vectors")


def _queries(blocks: DataFrame, work: Workspace) -> DataFrame:
    """Staged blocks of queries with their bounds, numbered, and the length that any of them needs."""
    total = blocks.agg(F.sum("queries")).first()[0] or 0
    # One block: the longest vectors.
    first = blocks.select("bucket", "longest", F.xxhash64("rows").alias("h")).orderBy(F.desc("longest"), "bucket", "h").first()
    longest = blocks.filter((F.col("bucket") == first["bucket"]) & (F.xxhash64("rows") == first["h"]))
    seed = longest.select(*_NAMES).limit(1).toArrow().to_batches()[0]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = _block(batch, r)
                at = np.flatnonzero(block.named & (block.ids % EVERY == 0))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block.rows[at]), pa.array(block.ids[at]), pa.array(block.squares[at]),
                            pa.array(list(block.values[at].astype(np.int32)), pa.list_(pa.int32())),
                        ],
                        ["row", "vec_id", "square", "values"],
                    )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _block(seed, 0)
        for block in _pack_rows(batches, QUERIES):
            best = Best(len(block.rows))
            search(block, known, best)
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(best.theta > 0, best.theta / block.lengths * (1 - _SLACK), 0.0).min()
            table = _table([block])
            columns = [*table.columns, pa.array([need]), pa.array([best.theta.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*_NAMES, "need", "theta"])

    rows = "row bigint, vec_id bigint, square bigint, values array<int>"
    chosen = blocks.select(*_NAMES).mapInArrow(choose, rows)
    dealt = chosen.repartition(max(1, -(-total // QUERIES)))
    bounded = dealt.mapInArrow(bound, f"{_BLOCK}, need double, theta binary")
    return work.stage(bounded.withColumn("block", F.monotonically_increasing_id()), "queries")


_FOUND = "row bigint, query_id bigint, vec_id bigint, score bigint"


def top_k(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the K best other rows of every query."""
    spark = vectors.sparkSession
    text_batches(spark)
    own = integer_vectors(vectors, scale, BOUND)
    n = own.count()
    if not n:
        nothing = "query_id bigint, rank int, vec_id bigint, score bigint"
        return spark.createDataFrame([], nothing)
    buckets = max(1, min(shuffle_parts(own), -(-n // BLOCK)))
    with Workspace(spark) as work:
        blocks = _candidates(_numbered(own), buckets, work)
        queries = _queries(blocks, work)
        found = stage(_met(queries, blocks, buckets), "found")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _met(queries: DataFrame, blocks: DataFrame, buckets: int) -> DataFrame:
    """The best of every query in every task that it comes to."""
    groups = max(1, -(-queries.count() // GROUP))
    of = blocks.agg(F.max("bucket")).first()[0]
    left = queries.select(*(F.col(c).alias(f"q_{c}") for c in (*_NAMES, "need", "theta", "block")))
    left = left.withColumns(
        {"q_bucket": F.explode(F.sequence(F.lit(0), F.lit(of))), "q_group": F.pmod(F.xxhash64("q_block"), F.lit(groups))}
    )
    right = blocks.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    # As many tasks as buckets and groups: the work grows with the pairs, not with the bytes.
    tasks = (of + 1) * groups
    left = left.repartition(tasks, "q_bucket", "q_group")
    right = right.repartition(tasks, "bucket", "group")
    same = (left["q_bucket"] == right["bucket"]) & (left["q_group"] == right["group"])
    pairs = left.join(right.hint("merge"), same).filter(F.col("q_need") <= F.col("longest"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, best = None, None, None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(block.rows[best.query]), pa.array(block.ids[best.query]),
                    pa.array(best.id, mask=~best.named), pa.array(best.score),
                ],
                ["row", "query_id", "vec_id", "score"],
            )

        for batch in batches:
            number = batch.column(batch.schema.get_field_index("q_block"))
            theta = batch.column(batch.schema.get_field_index("q_theta"))
            for r in range(batch.num_rows):
                if number[r].as_py() != key:
                    if best is not None:
                        yield flush()
                    key, block = number[r].as_py(), _block(batch, r, "q_")
                    best = Best(len(block.rows), np.frombuffer(theta[r].as_buffer(), np.int64))
                search(block, _block(batch, r), best)
        if best is not None:
            yield flush()

    columns = [*(f"q_{c}" for c in (*_NAMES, "theta", "block")), *_NAMES]
    return pairs.select(*columns).mapInArrow(meet, _FOUND)
