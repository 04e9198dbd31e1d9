"""Suffix arrays of many small buckets of strings at once, by ranks of longer and longer prefixes.

Suffixes are ranked by their first WORD bytes. The ranks of the prefixes that begin at a suffix, behind the first
and behind the second then rank prefixes of three times the length, until these are as long as asked for or as the
longest string. A bucket's suffixes by rank are its suffix array. Ranks do not depend on the bucket, so that every
step is one sort of all buckets' suffixes in numpy, however the strings are made.

A string ends with a sentinel below all bytes; suffixes that are equal up to it, or in as many bytes as asked for,
have the same rank and no order among themselves.
"""

from __future__ import annotations

import numpy as np

#: Bytes in a first rank, below which there is room for how many of them the string has.
WORD = 7


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1; equal keys have equal ranks."""
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(len(key), np.int64)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def prefix_ranks(
    text: np.ndarray, string_start: np.ndarray, depth: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(position, rank by the first ``depth`` bytes) of the suffixes that have as many; without a depth, of all
    suffixes by all their bytes.

    ``text`` holds the strings end to end, ``string_start`` their first positions and the length of the text.
    """
    n, lengths = len(text), np.diff(string_start)
    left = np.repeat(string_start[1:], lengths) - np.arange(n)
    at = np.arange(n) if depth is None else np.flatnonzero(left >= depth)
    if not len(at):
        return at, at
    goal = int(lengths.max()) if depth is None else depth
    known = min(WORD, goal)
    key = text.astype(np.int64)
    for k in range(1, known):
        key <<= 8
        key[: n - k] |= np.where(left[: n - k] > k, text[k:], 0)
    rank = _dense(key << 3 | np.minimum(left, known))
    # Three ranks in one number, two where they are large.
    parts = 3 if n < 1 << 21 else 2
    bits = 63 // parts
    while known < goal:
        reach = min(parts * known, goal)
        of = at if reach == goal else np.arange(n)
        key = rank[of]
        for k in range(1, parts):
            ahead = min(k * known, reach - known)
            inside = left[of] > ahead
            key = key << bits | np.where(inside, rank[np.where(inside, of + ahead, 0)], 0)
        rank, known = _dense(key), reach
    return at, rank if len(rank) == len(at) else rank[at]


def suffix_arrays(
    text: np.ndarray, string_start: np.ndarray, bucket_start: np.ndarray, depth: int | None = None
) -> np.ndarray:
    """Order of the suffixes within each bucket, bucket after bucket; with a depth, of those that have as many bytes,
    by these.

    Every bucket begins at a string; ``bucket_start`` ends with the length of the text.
    """
    at, rank = prefix_ranks(text, string_start, depth)
    bucket = np.repeat(np.arange(len(bucket_start) - 1), np.diff(bucket_start))
    return at[np.argsort(bucket[at] << 32 | rank, kind="stable")]
