"""Periodic runs of words (operator 12), by the dictionary of basic factors.

Factors of 1, 2, 4, ... words get names, equal factors equal ones: the name of a factor is the rank of the
pair of names of its halves. The occurrences of a factor of L words within a window of twice that length form
an arithmetic progression, whose step is a period of what they cover. So wherever the next occurrence of
a factor begins at most L words on, the step is proposed as a period; the progressions of neighbouring places
with one step are joined, which extends them to a whole run. A period q is taken from the factors
of L words with L/2 < q <= L: there every place of a run whose factor and the next one lie in it has the next
occurrence exactly q words on, so that each run comes out once, at full length, and with its
smallest period. Factors met once in a document are left out of the longer ones, which cannot recur either.

A run has at least MIN_LENGTH words and MIN_POWER periods. ``collapsed`` keeps of each run its first
period: a word is dropped if a run contains it behind that run's first period.

Defined results: NULL, empty and blank texts have no words and no run; very long texts are handled whole, in
a task of their own arrays; repeated rows get equal results, a row each, whatever their doc_id; of runs that
are equally long the caller may choose, they come by start and period; an empty table gives an empty result;
other columns, of any name, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, text_batches

MIN_LENGTH = 6
MIN_POWER = 4
#: Words handled side by side; a longer text is handled on its own.
SIDE_BY_SIDE = 400_000


def find_runs(
    codes: np.ndarray, offsets: np.ndarray, least: int = MIN_LENGTH, power: int = MIN_POWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs, by row, start and period. Row r has the words
    ``codes[offsets[r]:offsets[r + 1]]``, equal words having equal codes. ``power`` is 3 at least."""
    sizes = np.diff(offsets)
    end = np.repeat(offsets[1:], sizes)
    size = np.repeat(sizes, sizes)
    at = np.flatnonzero(size >= least)
    names, span = codes[at].astype(np.int64), 1
    starts, lengths, periods = [], [], []
    named = np.full(len(codes), -1, np.int64)
    while len(at):
        order = np.argsort(names, kind="stable")
        place, name = at[order], names[order]
        fresh = np.concatenate([[True], name[1:] != name[:-1]])
        # The next occurrence in the same document.
        again = ~fresh[1:] & (end[place[1:]] == end[place[:-1]])
        step = np.where(again, place[1:] - place[:-1], 0)
        near = np.flatnonzero((step > span // 2) & (step <= span))
        if len(near):
            first, step = place[near], step[near]
            by = np.argsort(first)
            first, step = first[by], step[by]
            joined = (first[1:] == first[:-1] + 1) & (step[1:] == step[:-1])
            begin = np.flatnonzero(np.concatenate([[True], ~joined]))
            places = np.diff(np.append(begin, len(first)))
            length = places - 1 + span + step[begin]
            long = (length >= least) & (length >= power * step[begin])
            starts.append(first[begin[long]])
            lengths.append(length[long])
            periods.append(step[begin[long]])
        # Names of the factors that occur again; twice as long ones are pairs of these.
        recurs = np.zeros(len(place), bool)
        recurs[1:] |= again
        recurs[:-1] |= again
        rank = np.cumsum(fresh) - 1
        live = np.sort(place[recurs])
        named[place[recurs]] = rank[recurs]
        # A period beyond the present length needs a document of ``power`` such periods.
        at = live[(live + 2 * span <= end[live]) & (size[live] >= power * (span + 1))]
        second = named[at + span]
        at, second = at[second >= 0], second[second >= 0]
        names = named[at] * np.int64(rank[-1] + 1) + second
        named[live] = -1
        span *= 2
    if not starts:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in (starts, lengths, periods))
    row = np.searchsorted(offsets, start, "right") - 1
    by = np.lexsort((period, start, row))
    row, start, length, period = row[by], start[by], length[by], period[by]
    return row, start - offsets[row], length, period


def _slices(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, n + 1 offsets) of runs of texts; bytes split at ASCII white space, and only there."""
    words: list[bytes] = []
    offsets = [0]
    for text in texts:
        words += (text or "").encode().split()
        offsets.append(len(words))
        if len(words) >= SIDE_BY_SIDE:
            yield words, np.array(offsets, np.int64)
            words, offsets = [], [0]
    if len(offsets) > 1:
        yield words, np.array(offsets, np.int64)


def _collapse(words: list[bytes], offsets: np.ndarray, row, start, length, period) -> list[str]:
    """The words of every row that no run drops, joined by single spaces."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, offsets[row] + start + period, 1)
    np.add.at(change, offsets[row] + start + length, -1)
    dropped = np.cumsum(change[:-1]) > 0
    touched = np.zeros(len(offsets) - 1, bool)
    touched[row] = True
    out = []
    for r in range(len(offsets) - 1):
        own = words[offsets[r] : offsets[r + 1]]
        if touched[r]:
            own = [w for w, gone in zip(own, dropped[offsets[r] : offsets[r + 1]].tolist()) if not gone]
        out.append(b" ".join(own).decode())
    return out


_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, least: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """doc_id, n_words, runs (by start and period) and the collapsed text of every document."""
    text_batches(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for words, offsets in _slices(batch.column(1).to_pylist()):
                known: defaultdict[bytes, int] = defaultdict(count().__next__)
                codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                row, start, length, period = find_runs(codes, offsets, least, power)
                n = len(offsets) - 1
                bounds = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                each = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start, length, period)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, n),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(bounds), each),
                        pa.array(_collapse(words, offsets, row, start, length, period), pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                done += n

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, _SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h the CRC-32 of the decimal doc_id, a text whose h is divisible by 10 ends in
    repeats of its own words: from word a on, word i becomes word a + (i - a) % p, with a = g % n,
    p = 1 + floor((n - a) / (3 + g % 8)) and g = floor(h / 10). Its words are joined by single spaces. Other
    texts, and those without a doc_id, stay as they are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(chosen & (trimmed != ""), F.split(trimmed, f"[{SPACES}]+"))
    own = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("_g"), words.alias("_w"))
    own = own.withColumn("_a", F.col("_g") % F.size("_w"))
    period = 1 + F.floor((F.size("_w") - F.col("_a")) / (3 + F.col("_g") % 8))
    own = own.withColumn("_p", period)
    places = F.sequence(F.lit(0).cast("long"), F.size("_w").cast("long") - 1)

    def word(i: Column) -> Column:
        j = F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
        return F.element_at("_w", (j + 1).cast("int"))

    planted = F.array_join(F.transform(places, word), " ")
    return own.select("doc_id", F.when(F.col("_w").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One line per document: the number of runs, the longest (then the first, then the one of the smaller
    period), and SHA-256 of all runs and of the collapsed text."""
    key = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(key)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.s").alias("start"),
        (-F.col("_best.l")).alias("length"),
        F.col("_best.p").alias("period"),
        F.floor(1000 * -F.col("_best.l") / F.col("_best.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
