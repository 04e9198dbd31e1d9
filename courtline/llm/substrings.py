"""Exact substring deduplication with suffix arrays (operator 10).

A byte is removed when a string of LENGTH bytes that covers it also starts in a document with a smaller
doc_id. Strings are judged on the input.

Copies of whole texts go first. Every window of LENGTH bytes has an anchor, the GRAM-byte string within it that has the smallest hash, so
equal windows have equal anchors. A document is a row of fragments, the windows of one anchor together, a
few dozen bytes longer than LENGTH at most. Fragments are dealt out by anchor. Anchors of one document
only are dropped; a fragment that shares no half with a different one of its anchor repeats as a whole or
not at all. The others are buckets: the suffixes of their different fragments are ordered by ``suffixes``
as far as LENGTH bytes, neighbours in the suffix array that agree in these form the
runs of equal windows, and the smallest doc_id of a run removes the window from all other documents.

A bucket of more than BUCKET different fragments, as at the edge of a passage that very many documents
quote, is dealt out again: its windows, by their place around the anchor, are halved, and fragments meet
where they share what all windows of a half hold. Parts that are still large are halved again, down to single
windows, which are equal strings; the others are ordered as usual. Windows that repeat nowhere drop out on the
way, no task holds a large bucket, and nothing is left out.

Defined results: NULL and empty texts have nothing to remove; texts below LENGTH bytes keep all; very long texts
are cut into fragments in parts; rows that
share a doc_id are separate documents of which neither is smaller; a NULL doc_id is smaller than any
other, or with ``nulls_smallest=False`` neither smaller nor larger than any; repeated text within a document is not removed; an empty table gives an empty result; other columns,
of any name, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .common import Workspace, global_positions, having, lookup, shuffle_parts, small, stage, text_batches
from .shingles import _VALUES, mix64, running_hash, span_hash, text_slices
from .suffixes import suffix_arrays

LENGTH = 50
GRAM = 16
HALF = (LENGTH - GRAM) // 2
#: Windows hashed at once, and the bits for a place among their bytes.
PART, PLACE_BITS = 8_000_000, 23
#: Different fragments of one anchor that are ordered as one bucket.
BUCKET = 256
#: Bytes of buckets that a task orders side by side.
SIDE_BY_SIDE = 2_000_000

#: A fragment's place and shape in one number.
SHAPE_BITS = 12
_FRAGMENT = "key bigint, ctx bigint, doc bigint, at bigint, halves int"


# ---- fragments -------------------------------------------------------------------------------


def fragments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, shape, halves, anchor hash, content hash) of all fragments of a slice of texts; starts
    count from the text's first byte, a fragment ends LENGTH - 1 bytes behind its last window's start, and
    shape is the number of windows plus 64 times the anchor's place in the fragment. ``halves`` has 15 bits
    each of what any window of the fragment holds at least one of, with the anchor: the HALF bytes before it
    and those behind it; 0 where no window needs them.

    A slice is taken in parts of at most PART windows, so that a place fits the bits that it shares with
    the hash in the search for the smallest; a fragment that a part's end cuts is two.
    """
    parts = [_part(data, offsets, i) for i in range(0, max(len(data) - LENGTH + 1, 0), PART)]
    if not parts:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*parts))


def _part(whole: np.ndarray, offsets: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
    span = LENGTH - GRAM + 1
    data = whole[base : base + PART + LENGTH - 1]
    n = len(data) - LENGTH + 1
    sums = running_hash(data, _VALUES)
    at = np.arange(len(data) - GRAM + 1)
    hashes = mix64(span_hash(sums, at, at + GRAM))
    # The smallest of every ``span`` hashes, by their upper bits and then from the left: minima of
    # doubling runs, then of two that overlap.
    low = np.uint64((1 << PLACE_BITS) - 1)
    best, done = (hashes & ~low) | at.astype(np.uint64), 1
    while 2 * done <= span:
        best = np.minimum(best[:-done], best[done:])
        done *= 2
    if done < span:
        best = np.minimum(best[: done - span], best[span - done :])
    where = (best & low).astype(np.int64)
    # Windows that lie within one row; the row of each.
    starts, ends = offsets[:-1] - base, offsets[1:] - base
    first_row, last_row = np.searchsorted(ends, 0, "right"), np.searchsorted(starts, n, "left")
    from_, to = np.maximum(starts[first_row:last_row], 0), np.minimum(ends[first_row:last_row] - LENGTH + 1, n)
    counts = np.maximum(to - from_, 0)
    rows = np.repeat(np.arange(first_row, last_row), counts)
    window = np.repeat(from_ - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    where = where[window]
    new = np.ones(len(window), bool)
    new[1:] = (where[1:] != where[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(window)))
    first, anchor, row = window[begin], where[begin], rows[begin]
    shape = (anchor - first) << 6 | count
    content = span_hash(sums, first, first + count + LENGTH - 1)
    content = mix64(content + shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    halves = np.zeros(len(first), np.int64)
    for has, low, high, bits in (
        (anchor - first >= HALF, anchor - HALF, anchor + GRAM, 16),
        (anchor - first - count < HALF, anchor, anchor + GRAM + HALF, 0),
    ):
        at_ = np.flatnonzero(has)
        code = (mix64(span_hash(sums, low[at_], high[at_])) >> np.uint64(50)).astype(np.int64) + 1
        halves[at_] |= code << bits
    return row, first + base - offsets[row], shape, halves, hashes[anchor], content


def _fragment_rows(own: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_slices(batch.column(1)):
                row, at, shape, halves, key, ctx = fragments(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)),
                        pa.array(docs[first:last][row]), pa.array(at << SHAPE_BITS | shape),
                        pa.array(halves.astype(np.int32)),
                    ],
                    ["key", "ctx", "doc", "at", "halves"],
                )

    return own.select("doc", "text").mapInArrow(cut, _FRAGMENT)


# ---- buckets ---------------------------------------------------------------------------------


def _texts_of(own: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """(key, ctx, shape, m, most, bytes): the classes with the bytes of their first fragment."""
    by_doc = classes.groupBy(F.col("first.doc").alias("doc")).agg(
        F.collect_list(F.struct(F.col("first.at").alias("at"), "key", "ctx", "most")).alias("cuts")
    )
    wanted = work.stage(by_doc, "cuts")
    texts = having(own.select("doc", "text"), "doc", wanted.select("doc"))
    joined = texts.join(wanted, "doc").select("doc", F.col("text").cast("binary").alias("text"), "cuts")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer().to_pybytes()
                cuts = batch.column(2)[i].values
                at = cuts.field(0).to_numpy()
                at, shape = at >> SHAPE_BITS, at & ((1 << SHAPE_BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        cuts.field(1), cuts.field(2), pa.array(shape.astype(np.int32)),
                        pa.array(np.full(len(at), doc)), cuts.field(3),
                        pa.array([text[a : a + k + LENGTH - 1] for a, k in zip(at, shape & 63)], pa.binary()),
                    ],
                    ["key", "ctx", "shape", "m", "most", "bytes"],
                )

    return joined.mapInArrow(take, "key bigint, ctx bigint, shape int, m bigint, most bigint, bytes binary")


def equal_windows(
    keys: np.ndarray, lengths: np.ndarray, text: np.ndarray, docs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, window, smallest doc of the same window) for all windows of fragments sorted by key."""
    strings = np.concatenate([[0], np.cumsum(lengths)])
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    buckets = strings[np.append(first, len(keys))]
    order = suffix_arrays(text, strings, buckets, LENGTH)
    of = np.repeat(np.arange(len(lengths)), lengths)[order]
    # Neighbours in the suffix array that agree in LENGTH bytes, in the same bucket.
    same = np.zeros(len(order), bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    step = 20_000
    for i in range(1, len(order), step):
        j = min(i + step, len(order))
        same[i:j] = (windows[order[i:j]] == windows[order[i - 1 : j - 1]]).all(axis=1)
    same[1:] &= keys[of[1:]] == keys[of[:-1]]
    run = np.flatnonzero(~same)
    least = np.minimum.reduceat(docs[of], run) if len(run) else np.zeros(0, np.int64)
    per_window = np.repeat(least, np.diff(np.append(run, len(order))))
    return of, order - strings[of], per_window


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(n)]


def _may_repeat(keys: np.ndarray, anchor: np.ndarray, n: np.ndarray, starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Fragments that share with another of their bucket what any window they had in common would hold:
    half of the bytes around the anchor before it, or half behind it."""
    sums = running_hash(data, _VALUES)
    place = starts + anchor
    keep = np.zeros(len(keys), bool)
    for has, low, high in (
        (anchor >= HALF, place - HALF, place + GRAM),
        (anchor - n < HALF, place, place + GRAM + HALF),
    ):
        at = np.flatnonzero(has)
        code = mix64(span_hash(sums, low[at], high[at]) + mix64(keys[at].view(np.uint64)))
        _, of, count = np.unique(code, return_inverse=True, return_counts=True)
        keep[at] |= count[of] > 1
    return keep


def judge_buckets(keys: np.ndarray, shape: np.ndarray, m: np.ndarray, most: np.ndarray, starts: np.ndarray,
                  data: np.ndarray) -> list[np.ndarray]:
    """[fragment, first window, last window, smallest doc] of whole buckets of fragments sorted by key."""
    n, anchor = shape & 63, shape >> 6
    compare = _may_repeat(keys, anchor, n, starts, data)
    # A fragment of several documents that shares nothing with others repeats by itself, in all windows.
    alone = np.flatnonzero((m < most) & ~compare)
    out = [(alone, np.zeros(len(alone), np.int64), n[alone] - 1, m[alone])]
    keep = np.flatnonzero(compare)
    if not len(keep):
        return list(out[0])
    keys, m, most, starts = (x[keep] for x in (keys, m, most, starts))
    lengths = n[keep] + LENGTH - 1
    of, window, least = equal_windows(keys, lengths, _gather(data, starts, lengths), m)
    hit = least < most[of]
    of, window, least = of[hit], window[hit], least[hit]
    if len(of):
        by = np.argsort(of << 6 | window)
        of, window, least = of[by], window[by], least[by]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (window[1:] != window[:-1] + 1) | (least[1:] != least[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(of)) - 1
        out.append((keep[of[begin]], window[begin], window[end], least[begin]))
    return [np.concatenate(c) for c in zip(*out)]


def _verdicts_of_buckets(pieces: DataFrame) -> DataFrame:
    """(key, ctx, a, b, m): windows a to b of the class also start in document m, the smallest. A piece's own
    windows count from ``skip``; pieces of one ``bucket`` meet."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "ctx", "a", "b", "m"]

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = [table.column(i).to_numpy() for i in range(5)]
            text = table.column(5).combine_chunks()
            ends = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
            data = np.frombuffer(text.buffers()[2], np.uint8)[ends[0] : ends[-1]]
            columns[2] = columns[2].astype(np.int64)
            of, a, b, m = judge_buckets(columns[0], *columns[2:], ends[:-1] - ends[0], data)
            if len(of):
                key, skip = table.column(6).to_numpy()[of], table.column(7).to_numpy()[of]
                found = (key, columns[1][of], a + skip, b + skip, m)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SIDE_BY_SIDE:
                table = pa.Table.from_batches(held)
                keys = table.column(0).to_numpy()
                cut = int(np.argmax(keys == keys[-1]))  # the last bucket may go on
                if cut:
                    yield from flush(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield from flush(pa.Table.from_batches(held))

    own = ["bucket", "ctx", "shape", "m", "most", "bytes", "key", "skip"]
    dealt = pieces.select(*own).repartition(shuffle_parts(pieces), "bucket")
    schema = "key bigint, ctx bigint, a bigint, b bigint, m bigint"
    return dealt.sortWithinPartitions("bucket", "ctx").mapInArrow(judge, schema)


def _halved(pieces: DataFrame) -> DataFrame:
    """Pieces of the lower and the upper half of the places that a window may have before the anchor, each cut to
    its windows there; ``bucket`` is what all windows of the half hold."""
    mid = F.expr("int((low + high) / 2)")
    lower, upper = pieces.withColumn("high", mid), pieces.withColumn("low", mid + 1)
    halves = lower.unionByName(upper).withColumns({"_n": F.expr("shape & 63"), "_anchor": F.expr("shape >> 6")})
    # The window i begins _anchor - i bytes before the anchor.
    halves = halves.withColumns(
        {"_from": F.expr("greatest(0, _anchor - high)"), "_to": F.expr("least(_n - 1, _anchor - low)")}
    ).filter("_from <= _to")
    held = F.expr(f"substring(bytes, _anchor - low + 1, {LENGTH} - high + low)")
    return halves.select(
        "key", "ctx", "m", "most", "low", "high", (F.col("skip") + F.col("_from")).alias("skip"),
        F.xxhash64("key", "low", "high", held).alias("bucket"),
        F.expr("shiftleft(_anchor - _from, 6) | (_to - _from + 1)").alias("shape"),
        F.expr(f"substring(bytes, _from + 1, _to - _from + {LENGTH})").alias("bytes"),
    )


def _parts_of_large(pieces: DataFrame, work: Workspace) -> tuple[DataFrame, list[DataFrame]]:
    """Verdicts on parts of large buckets that hold one string, and the other parts as buckets of the usual size.

    A part without another document to meet has no verdict. A single window is one string, so halving ends."""
    pieces = pieces.withColumns({"low": F.lit(0), "high": F.lit(LENGTH - GRAM)})
    verdicts, usual = [], []
    while True:
        halves = _halved(pieces).withColumn("_content", F.xxhash64("bytes"))
        met = halves.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("_of"), F.min("m").alias("_least"), F.max("most").alias("_most"),
            (F.min("_content") == F.max("_content")).alias("_one"),
        )
        halves = work.stage(halves.drop("_content").join(met.filter("_least < _most"), "bucket"), "halves")
        last = (F.col("skip") + F.expr("shape & 63") - 1).cast("long")
        one = halves.filter("_one and _least < most")
        verdicts.append(one.select("key", "ctx", F.col("skip").cast("long").alias("a"), last.alias("b"), F.col("_least").alias("m")))
        several = halves.filter("not _one").drop("_least", "_most", "_one")
        usual.append(several.filter(F.col("_of") <= BUCKET).drop("_of", "low", "high"))
        pieces = several.filter(F.col("_of") > BUCKET).drop("_of")
        if pieces.isEmpty():
            return reduce(DataFrame.unionByName, verdicts), usual


# ---- documents -------------------------------------------------------------------------------


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc, doc_id, text) with a number per row, and the bits of it that do not count in comparisons.

    The doc_id itself where it is unique and known; else its rank, with the place among equals below, in
    as many bits as the most frequent doc_id needs.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    per_id = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if per_id.filter("n > 1 or doc_id is null").isEmpty():
        return own.withColumn("doc", F.col("doc_id")), 0
    held = stage(own.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ids = small(held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")))
    n_ids, most = ids.agg(F.count(F.lit(1)), F.max("n")).first()
    bits = max(1, (most - 1).bit_length())
    if (n_ids - 1).bit_length() + bits > 63:
        raise ValueError("doc_id: too many ids and rows of one id for numbers of 63 bits")
    smallest = F.col("doc_id").asc_nulls_first()
    ranked = small(global_positions(ids.select("doc_id"), [smallest], {"rank": F.lit(1)}))
    # Dealt out by ranges of rows, so that an id with very many rows is numbered by several tasks.
    order = [smallest, F.col("_row").asc()]
    ties = global_positions(held.select("doc_id", "_row"), order, {"tie": F.lit(1)}, within=["doc_id"])
    ties = lookup(ties, ranked, ["doc_id"], F.col("_row"))
    numbers = ties.select("_row", (F.shiftleft("rank", bits) + F.col("tie")).alias("doc"))
    return stage(held.join(numbers, "_row").select("doc", "doc_id", "text"), "numbered"), bits


def _copies(own: DataFrame, shift: int = 0) -> DataFrame:
    """Staged (doc, doc_id, n_bytes): documents of LENGTH bytes or more whose whole text a smaller one has. All of
    it goes, so they need no fragments, and a group of copies, however large, is one document from here on, or
    as many as share its smallest doc_id."""
    n = F.octet_length("text").cast("long").alias("n_bytes")
    texts = own.select("doc", "doc_id", n, F.xxhash64("text").alias("_x"), F.xxhash64(F.reverse("text")).alias("_y"))
    texts = stage(texts.filter(F.col("n_bytes") >= LENGTH), "texts")
    keys = ["n_bytes", "_x", "_y"]
    first = texts.groupBy(*keys).agg(F.min("doc").alias("_first"), F.count(F.lit(1)).alias("_n"))
    smaller = F.shiftright("_first", shift) < F.shiftright("doc", shift)
    found = texts.join(first.filter("_n > 1"), keys).filter(smaller)
    return stage(found.select("doc", "doc_id", "n_bytes"), "copies")


def removed_intervals(own: DataFrame, work: Workspace, shift: int = 0) -> DataFrame:
    """(doc, a, b): bytes a to b, exclusive, of the document's text are covered by repeated windows."""

    def smaller(a: str, b: str) -> str:
        return f"shiftright({a}, {shift}) < shiftright({b}, {shift})" if shift else f"{a} < {b}"

    def over(*keys: str) -> WindowSpec:
        return Window.partitionBy("key", *keys)

    # One shuffle by anchor serves all windows. Fragments are compared where another of the bucket may
    # share a window with them: it has the same half.
    rows = _fragment_rows(own).withColumns(
        {"_first": F.min("doc").over(over()), "_last": F.max("doc").over(over())}
    )
    rows = rows.filter(smaller("_first", "_last")).withColumns(
        {"_left": F.shiftright("halves", 16), "_right": F.col("halves").bitwiseAND(F.lit(0xFFFF))}
    )
    compare = F.lit(False)
    for half in ("_left", "_right"):
        differ = F.min("ctx").over(over(half)) != F.max("ctx").over(over(half))
        compare |= (F.col(half) > 0) & differ
    rows = rows.withColumns({"compare": compare, "_own": F.min("doc").over(over("ctx"))})
    rows = rows.filter(F.col("compare") | F.expr(smaller("_own", "doc")))
    named = [F.when(F.col("compare"), F.col(c)).alias(c) for c in ("key", "ctx")]
    shared = work.stage(rows.select(*named, "doc", "at", "compare"), "shared")
    # Those with nothing to be compared with: all windows repeat the first document's of this fragment.
    start = F.shiftright("at", SHAPE_BITS).alias("start")
    plain = shared.filter("not compare").select("doc", start, (F.expr("shiftleft(1L, int(at & 63))") - 1).alias("bits"))
    several = shared.filter("compare")
    classes = several.groupBy("key", "ctx").agg(
        F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("most")
    )
    pieces = work.stage(_texts_of(own, classes, work), "pieces")
    pieces = pieces.dropDuplicates(["key", "ctx"]) if shift else pieces
    large = small(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BUCKET).select("key"))
    pieces = pieces.withColumns({"bucket": F.col("key"), "skip": F.lit(0)})
    if large.isEmpty():
        verdicts = _verdicts_of_buckets(pieces)
    else:
        right = large.withColumnRenamed("key", "_large")
        usual = pieces.join(right, pieces["key"] == right["_large"], "anti")
        equal, parts = _parts_of_large(having(pieces, "key", large), work)
        verdicts = _verdicts_of_buckets(reduce(DataFrame.unionByName, [usual, *parts])).unionByName(equal)
    # One row per class: the windows that each document takes, as bits. So a member meets one row.
    bits = F.expr("shiftleft(shiftleft(1L, int(b - a + 1)) - 1, int(a))")
    verdicts = verdicts.select("key", "ctx", F.struct("m", bits.alias("bits")).alias("v"))
    taken = verdicts.groupBy("key", "ctx").agg(F.collect_list("v").alias("taken"), F.min("v.m").alias("_least"))
    met = several.join(work.stage(taken, "verdicts"), ["key", "ctx"]).filter(smaller("_least", "doc"))
    of = F.expr(f"aggregate(filter(taken, v -> {smaller('v.m', 'doc')}), 0L, (x, v) -> x | v.bits)")
    return _joined(plain.unionByName(met.select("doc", start, of.alias("bits"))))


def _joined(windows: DataFrame) -> DataFrame:
    """(doc, a, b): runs of bytes that the windows cover. ``windows`` has a fragment's start and, as bits, which of the
    windows from there on go. A document's runs are few however many windows it has; where a batch ends, one may be two."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, bits = (batch.column(i).to_numpy() for i in range(3))
            if not len(doc):
                continue
            places = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, place = np.nonzero(places)
            doc, a = doc[row], start[row] + place
            new = np.ones(len(a), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > a[:-1] + LENGTH)
            first = np.flatnonzero(new)
            b = a[np.append(first[1:], len(a)) - 1] + LENGTH
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[first], a[first], b)], ["doc", "a", "b"])

    dealt = windows.repartition(shuffle_parts(windows), "doc").sortWithinPartitions("doc", "start")
    return dealt.mapInArrow(join, "doc bigint, a bigint, b bigint")


def _runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals."""
    by = np.argsort(a, kind="stable")
    a, reach = a[by], np.maximum.accumulate(b[by])
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return a[first], reach[np.append(first[1:], len(a)) - 1]


def deduplicate(docs: DataFrame, nulls_smallest: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document; ``kept`` is binary."""
    text_batches(docs.sparkSession)
    # Where a NULL doc_id compares with none, its document keeps all and no other loses anything to it.
    apart = F.lit(False) if nulls_smallest else F.col("doc_id").isNull()
    every, shift = _numbered(docs.filter(~apart))
    copies = _copies(every, shift)
    own = having(every, "doc", copies.select("doc"), how="anti")
    with Workspace(docs.sparkSession) as work:
        cuts = removed_intervals(own, work, shift).groupBy("doc")
        cuts = stage(cuts.agg(F.collect_list(F.struct("a", "b")).alias("cuts")), "intervals")
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    touched = having(own, "doc", cuts.select("doc")).join(cuts, "doc").select("doc_id", text, "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer().to_pybytes()
                values = batch.column(2)[i].values
                a, b = _runs(values.field(0).to_numpy(), values.field(1).to_numpy())
                edges = np.concatenate([[0], np.column_stack([a, b]).ravel(), [len(raw)]])
                kept = b"".join(raw[x:y] for x, y in edges.reshape(-1, 2))
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((batch.column(0)[i].as_py(), len(raw), int((b - a).sum()), len(a), digest, kept))
            if rows:
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    changed = touched.mapInArrow(cut, schema)
    rest = having(own, "doc", cuts.select("doc"), how="anti").select("doc_id", text)
    rest = rest.unionByName(docs.filter(apart).select(F.col("doc_id").cast("long"), text))
    zero = F.lit(0).cast("long")
    same = rest.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"),
    )
    out = same.unionByName(changed)
    nothing = F.lit(b"").cast("binary")
    gone = copies.select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"), F.sha2(nothing, 256).alias("kept_sha256"), nothing.alias("kept"),
    )
    return out.unionByName(gone)
