"""Benchmark decontamination (operator 1): which test items does a document contain?

Size-partitioned MinHash containment search. Items are partitioned by their number of shingles; the
partition (2^(p-1), 2^p] keeps, of one MinHash permutation, the sketch of each item's smallest values,
as many as a document that contains the share ``threshold`` of an item of this size cannot miss all of
(2^p - ceil(threshold * 2^p) + 1, from the partition's upper bound). A document of any length is searched by looking up all
its shingles in the sketches, so a short item in a long document is not diluted; each candidate is then
verified by exact containment of shingle sets. The search therefore misses nothing.

The items are the stated query set. They are sent to the tasks in blocks of bounded size; the documents
are scanned once per block and never shuffled.

Defined results: NULL or blank texts contain nothing, and such items are contained nowhere; an item of
fewer than five words is one shingle, contained where these words stand in a row; repeated rows each get
their result; an empty table on either side gives no pair and removes no document; other columns, of any
name, are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .shingles import WORDS, grams, row_bounds, shingles, text_slices, word_hashes

THRESHOLD = 0.8
#: Bytes of item text sent to the tasks at once.
BLOCK_BYTES = 8_000_000
_FILTER_BITS = 20


class ItemIndex:
    """Sketches and shingle sets of one block of items, built on the driver and sent to the tasks."""

    def __init__(self, ids: list, texts: list[str], threshold: float = THRESHOLD) -> None:
        self.ids, self.sets, self.lengths, self.needed = [], [], set(), []
        sketch, owner = [], []
        for first, last, data, offsets in text_slices(pa.array(texts, pa.large_string())):
            hashes, rows = shingles(data, offsets)
            n_words = np.bincount(word_hashes(data, offsets)[1], minlength=last - first)
            bounds = row_bounds(rows, last - first)
            for i in range(last - first):
                own = np.unique(hashes[bounds[i] : bounds[i + 1]])
                if len(own):
                    self.lengths.add(min(int(n_words[i]), WORDS))
                    n, upper = len(own), 1 << (len(own) - 1).bit_length()
                    keep = min(n, upper - math.ceil(threshold * upper - 1e-9) + 1)
                    sketch.append(own[:keep])
                    owner.append(np.full(keep, len(self.ids)))
                    self.ids.append(ids[first + i])
                    self.sets.append(own)
                    self.needed.append(math.ceil(threshold * n - 1e-9))
        values = np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.owners = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.values)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item number, shared shingles) of all contained items."""
        hashes, rows = word_hashes(data, offsets)
        found = [grams(hashes, rows, k) for k in sorted(self.lengths)]
        if not found:
            return
        all_h, all_r = (np.concatenate(x) for x in zip(*found))
        likely = np.flatnonzero(self.filter[self._slot(all_h)])
        left = np.searchsorted(self.values, all_h[likely], "left")
        right = np.searchsorted(self.values, all_h[likely], "right")
        hit = right > left
        pairs = {
            (int(r), int(o))
            for r, a, b in zip(all_r[likely][hit], left[hit], right[hit])
            for o in self.owners[a:b]
        }
        if not pairs:
            return
        wanted = np.unique([r for r, _ in pairs])
        mine = np.isin(all_r, wanted)
        own_h, own_r = all_h[mine], all_r[mine]
        order = np.argsort(own_r, kind="stable")
        own_h, own_r = own_h[order], own_r[order]
        sets = {int(r): np.unique(own_h[np.searchsorted(own_r, r, "left") : np.searchsorted(own_r, r, "right")]) for r in wanted}
        for r, o in sorted(pairs):
            shared = int(np.isin(self.sets[o], sets[r], assume_unique=True).sum())
            if shared >= self.needed[o]:
                yield r, o, shared


def _blocks(items: DataFrame, threshold: float, block_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of blocks of items, each of about ``block_bytes``; the size is asked for first."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).select("item_id", "text").collect()
        yield ItemIndex([r[0] for r in rows], [r[1] or "" for r in rows], threshold)


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, item_id, n_shingles, shared): every pair with shared >= threshold * n_shingles."""
    text_batches(docs.sparkSession)
    schema = "doc_id bigint, item_id bigint, n_shingles bigint, shared bigint"
    own = docs.select(F.col("doc_id").cast("long"), "text")
    result = None
    for index in _blocks(items, threshold, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, out = batch.column(0), []
                for first, _, data, offsets in text_slices(batch.column(1)):
                    for r, o, shared in index.search(data, offsets):
                        out.append((ids[first + r].as_py(), index.ids[o], len(index.sets[o]), shared))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out)],
                        ["doc_id", "item_id", "n_shingles", "shared"],
                    )

        part = own.mapInArrow(search, schema)
        result = part if result is None else result.unionByName(part)
    return result


def decontaminate(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that contain no item, with all their columns; row-wise, without a shuffle."""
    text_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for index in _blocks(items, threshold, block_bytes):

        def clean(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in text_slices(batch.column(at)):
                    for r, _, _ in index.search(data, offsets):
                        keep[first + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
