"""Edit-aware token counts (operator 7).

A document is held as its pre-tokens with their token counts, in blocks, below a segment tree of sums of
characters and tokens. An edit re-encodes from the pre-token that holds the third character before it
(no rule of the pattern looks further ahead) until a new boundary meets an old one behind it; from there
on the old pre-tokens stand. The sums on the paths above the changed blocks are then updated. The total
is the root's sum at any time.

The pattern has no look-behind, so splitting from a boundary does not depend on the text before it.

Defined results: NULL and empty texts have no tokens and no edits; repeated rows each get their counts;
very long texts cost a tree of as many leaves as they have blocks; an empty table gives an empty result;
other columns, of any name, are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Pre-tokens in a block of a new tree; a block that grows to four times as many has the tree made anew.
BLOCK = 64
#: Characters that the longest look-ahead of the pattern reaches beyond the end of a pre-token.
REACH = 3
#: Distinct pre-tokens whose counts a task holds.
HELD = 500_000

Edit = tuple[int, int, str]


class PieceCounts:
    """Splits text and counts the tokens of pieces with a byte-level BPE rank file."""

    def __init__(self, rank_path: str, pattern: str) -> None:
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > HELD:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in pieces]


class TokenTree:
    """Pre-tokens of one document below a segment tree of (characters, tokens)."""

    def __init__(self, pieces: PieceCounts, text: str) -> None:
        self.pieces, self.reencoded = pieces, 0
        parts = pieces.split(text)
        self._build(parts, pieces.count(parts))

    def _build(self, parts: list[str], counts: list[int]) -> None:
        steps = range(0, len(parts), BLOCK)
        self.parts = [parts[i : i + BLOCK] for i in steps] or [[]]
        self.counts = [counts[i : i + BLOCK] for i in steps] or [[]]
        self.width = 1 << (len(self.parts) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for b, (p, c) in enumerate(zip(self.parts, self.counts)):
            self.chars[self.width + b], self.tokens[self.width + b] = sum(map(len, p)), sum(c)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for parts in self.parts for p in parts)

    def _find(self, at: int) -> tuple[int, int, int]:
        """(block, piece, first character) of the piece that holds the character ``at``; at the end of
        the text, the place behind the last piece."""
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if at >= before + self.chars[i]:
                if i + 1 < 2 * self.width and (self.chars[i + 1] or at > before + self.chars[i]):
                    before += self.chars[i]
                    i += 1
                elif not self.chars[i + 1]:
                    pass  # behind the last character: stay left of the empty half
        block, k = i - self.width, 0
        for k, p in enumerate(self.parts[block]):
            if at < before + len(p):
                return block, k, before
            before += len(p)
        return block, len(self.parts[block]), before

    def apply(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters at ``start``; out of range is cut to the text."""
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(length, 0), self.n_chars)
        b0, k0, first = self._find(max(0, start - REACH))
        # Old pieces are read on, from the restart, until old and new boundaries meet behind the edit.
        b, k, at = b0, k0, first
        old: list[str] = []
        bounds = {at}
        ahead = 4 * BLOCK

        def read(until: int) -> None:
            nonlocal b, k, at
            while at < until and b < len(self.parts):
                if k == len(self.parts[b]):
                    b, k = b + 1, 0
                    continue
                old.append(self.parts[b][k])
                at += len(self.parts[b][k])
                bounds.add(at)
                k += 1

        while True:
            read(end + ahead)
            whole = at >= self.n_chars
            source = "".join(old)
            region = source[: start - first] + insert + source[end - first :]
            shift = len(insert) - (end - start)
            new, here, met = [], first, None
            for p in self.pieces.split(region):
                if not whole and here + len(p) + REACH > first + len(region):
                    break
                new.append(p)
                here += len(p)
                if here - shift >= end and here >= start + len(insert) and here - shift in bounds:
                    met = here - shift
                    break
            if met is None and whole:
                met = self.n_chars
            if met is not None:
                break
            ahead *= 4
        # Where the old pieces up to the meeting end.
        b1, k1, place = b0, k0, first
        while place < met:
            if k1 == len(self.parts[b1]):
                b1, k1 = b1 + 1, 0
                continue
            place += len(self.parts[b1][k1])
            k1 += 1
        counts = self.pieces.count(new)
        self.reencoded += len(new)
        self._splice(b0, k0, b1, k1, new, counts)

    def _splice(self, b0: int, k0: int, b1: int, k1: int, new: list[str], counts: list[int]) -> None:
        tail_p, tail_c = self.parts[b1][k1:], self.counts[b1][k1:]
        self.parts[b0] = self.parts[b0][:k0] + new + (tail_p if b1 == b0 else [])
        self.counts[b0] = self.counts[b0][:k0] + counts + (tail_c if b1 == b0 else [])
        for b in range(b0 + 1, b1):
            self.parts[b], self.counts[b] = [], []
        if b1 != b0:
            self.parts[b1], self.counts[b1] = tail_p, tail_c
        if len(self.parts[b0]) > 4 * BLOCK:
            self._build([p for x in self.parts for p in x], [c for x in self.counts for c in x])
            return
        above = set()
        for b in range(b0, b1 + 1):
            i = self.width + b
            self.chars[i], self.tokens[i] = sum(map(len, self.parts[b])), sum(self.counts[b])
            above.add(i // 2)
        while above and 0 not in above:
            for i in above:
                self._sum(i)
            above = {i // 2 for i in above}


_NUMBER = regex.compile(r"[0-9]{6,}")


def cleaning_edits(text: str) -> list[Edit]:
    """Edits that cleaning makes: long numbers become "<number>", a repeated line goes. From the end of
    the text to its start, so that each position holds when its turn comes."""
    edits: list[Edit] = []
    seen, at = set(), 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            edits.append((at - 1, len(line) + 1, ""))
        else:
            seen.add(line)
            edits += [(at + m.start(), m.end() - m.start(), "<number>") for m in _NUMBER.finditer(line)]
        at += len(line) + 1
    return edits[::-1]


def counts_after_edits(
    docs: DataFrame, rank_path: str, pattern: str, edits_of: Callable[[str], list[Edit]] = cleaning_edits
) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_edited, n_pieces, n_reencoded) of every document: tokens
    before and after its edits, pre-tokens before, and how many pre-tokens the edits encoded again."""
    text_batches(docs.sparkSession)
    names = ("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pieces", "n_reencoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceCounts(rank_path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                tree = TokenTree(pieces, text)
                before, n = tree.n_tokens, sum(map(len, tree.parts))
                edits = edits_of(text)
                for edit in edits:
                    tree.apply(*edit)
                rows.append((doc_id, before, len(edits), tree.n_tokens, n, tree.reencoded))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], list(names))

    schema = ", ".join(f"{n} bigint" for n in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
