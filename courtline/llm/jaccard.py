"""N-gram Jaccard join (operator 3): links between documents whose shingle sets have J >= 0.8, exactly.

Sets are ordered globally: shingles met rarely first, frequent ones last, by hash among equals. Two
sets that link share one of the first floor(0.2 n) + 1 shingles of either (the prefix), so only sets
that meet under a prefix shingle are compared. A comparison is a walk over a trie: the candidates of
one set are laid out in the global order, where sets with a common beginning are neighbours; the walk
counts the overlap of a shared beginning once and leaves a branch as soon as what remains, in the branch
or in the searched set, cannot bring the overlap to the bound.

Not all pairs under a shingle are compared. First every set meets the first set of each of its prefix
shingles; verified links join sets to components. Only where sets of different components still meet
under a shingle are they compared with each other, so components are exact, while a group of n near
copies costs n comparisons and not n * n. Equal sets are one set throughout.

Defined results: NULL, empty or blank text has an empty set and is a component of its own; fewer than
five words are one shingle; very long texts give whole sets; repeated rows are copies of each other; of the
documents of a component the smallest doc_id names it, and ``one_of_each`` keeps one row of it, of rows with that
doc_id the first by a hash of all columns; an empty table gives an empty result; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, having, small, stage, text_batches, unused
from .components import components
from .shingles import mix64, row_bounds, shingles, text_slices

#: Similarity bound as a fraction: 100 * intersection >= 80 * union.
NUMERATOR, DENOMINATOR = 80, 100
#: A shingle met twice within so many shingles of one task is counted as frequent ...
CHUNK = 2_000_000
#: ... if its counts add up to this; the list of frequent ones is cut to the most frequent. It only
#: steers the order, so results do not depend on it.
FREQUENT, FREQUENT_LIST = 8, 500_000
#: Candidates of one set that a task lays out in one trie.
TRIE = 128
#: Times that sets with too few meetings are left out, which may leave others with too few.
PRUNINGS = 2
#: Rounds of meetings with a first set before the sets still apart are compared with each other.
ROUNDS = 2


def extra(n: int) -> int:
    """Prefix shingles beyond the first that must be shared: a tenth of the set."""
    return max(1, n // 10)


def prefix_length(n: int) -> int:
    """Of n elements at most n - ceil(0.8 n) are missing from a linked set, so that two linked sets
    share at least the lesser of their extra(n) elements within these prefixes."""
    return min(n, n - -(-NUMERATOR * n // DENOMINATOR) + extra(n))


def needed_overlap(n: np.ndarray | int, m: int) -> np.ndarray | int:
    """Least intersection of sets of n and m elements that link: ceil(80 (n + m) / 180)."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


# ---- sets of documents -----------------------------------------------------------------------


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for first, last, data, offsets in text_slices(column):
        hashes, rows = shingles(data, offsets)
        bounds = row_bounds(rows, last - first)
        for i in range(last - first):
            yield first + i, np.unique(hashes[bounds[i] : bounds[i + 1]])


def set_id(own: np.ndarray) -> int:
    """64 bits of a set, by which sets are told apart."""
    total = mix64(own + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return int(np.int64(total.view(np.int64)))


class Order:
    """The global order: (count if frequent else 0, hash)."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray) -> None:
        at = np.argsort(frequent)
        self.frequent, self.counts = frequent[at], counts[at]

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, self.counts[at], 0)

    def sorted(self, own: np.ndarray) -> np.ndarray:
        rank = self.rank(own)
        return own if not rank.any() else own[np.lexsort((own, rank))]


def frequent_shingles(docs: DataFrame) -> Order:
    """Shingles that repeat within chunks of the corpus, counted over all documents."""

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            many = n > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[many].view(np.int64)), pa.array(n[many])], ["h", "n"]
            )

        held, size = [], 0
        for batch in batches:
            for _, own in _sets(batch.column(0)):
                held.append(own)
                size += len(own)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counts = docs.select("text").mapInArrow(repeats, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    # A list of bounded length: FREQUENT_LIST pairs of numbers, whatever the corpus.
    top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(FREQUENT_LIST).toPandas()
    return Order(top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64))


def profile(docs: DataFrame, order: Order, work: Workspace) -> DataFrame:
    """Staged (doc_id, n, s, prefix, often) of every document: set size, set id, prefix shingles and
    how many of them, at the end, are frequent."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, prefixes, often = [], [], [], []
            for _, own in _sets(batch.column(1)):
                head = order.sorted(own)[: prefix_length(len(own))] if len(own) else own
                sizes.append(len(own))
                ids.append(set_id(own))
                prefixes.append(head.view(np.int64))
                often.append(int((order.rank(head) > 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(often, pa.int32()),
                ],
                ["doc_id", "n", "s", "prefix", "often"],
            )

    schema = "doc_id bigint, n bigint, s bigint, prefix array<bigint>, often int"
    return work.stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, schema), "profile")


# ---- candidates ------------------------------------------------------------------------------


def meetings(described: DataFrame, work: Workspace) -> DataFrame:
    """Staged (t, pos, s, n): sets under every prefix shingle that at least two different sets have,
    with the shingle's place in the set's order.

    Rare shingles have few sets: one shuffle and a window. Frequent ones are counted before the
    shuffle and joined back, where adaptive execution splits the hot ones.
    """
    sets = described.filter("n > 0")
    head = F.size("prefix") - F.col("often")
    rare = sets.select(F.posexplode(F.slice("prefix", 1, head)).alias("pos", "t"), "s", "n")
    under = Window.partitionBy("t")
    rare = (
        rare.withColumns({"_a": F.min("s").over(under), "_b": F.max("s").over(under)})
        .filter("_a <> _b")
        .select("t", "pos", "s", "n")
        .distinct()
    )
    often = sets.filter("often > 0").select(
        F.posexplode(F.slice("prefix", head + 1, F.col("often"))).alias("pos", "t"), head.alias("head"), "s", "n"
    )
    often = often.select("t", (F.col("pos") + F.col("head")).alias("pos"), "s", "n").distinct()
    several = often.groupBy("t").agg(F.min("s").alias("_a"), F.max("s").alias("_b")).filter("_a <> _b")
    often = often.join(several.select("t"), "t")
    met = work.stage(rare.unionByName(often), "meetings")
    for _ in range(PRUNINGS):
        # A linked set of n meets another, of 0.8 n at least, under extra(0.8 n) shingles or more.
        least = F.expr("greatest(1, least(n div 10, (n * 8 + 9) div 10 div 10))")
        enough = met.groupBy("s", "n").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") >= least)
        met = met.join(enough.select("s"), "s", "semi")
        several = met.groupBy("t").agg(F.min("s").alias("_a"), F.max("s").alias("_b")).filter("_a <> _b")
        met = work.stage(met.join(several.select("t"), "t", "semi"), "met")
    return met


def _may_link(a: str, b: str) -> str:
    """Whether the shingle that two sets meet under may be the first that they have in common: at most
    n - v elements of a set of n come before it, v being the needed overlap. Linked sets meet under
    their first common shingle, so testing all pairs that may link under some shingle misses none."""
    v = f"(({NUMERATOR} * ({a}n + {b}n) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR})"
    return f"{v} <= least({a}n, {b}n) and {a}pos <= {a}n - {v} and {b}pos <= {b}n - {v}"


def first_pairs(met: DataFrame, by_weight: bool) -> DataFrame:
    """(a, b): every set with the first set under each of its shingles, if it is of another component.

    The first is the set that meets most others, which a common original does, or a drawn one.
    """
    if by_weight:
        weight = met.groupBy("s").agg(F.count(F.lit(1)).alias("w"))
        weighed = met.join(weight, "s")
    else:
        weighed = met.withColumn("w", F.xxhash64("s", "t"))
    first = weighed.groupBy("t").agg(F.max(F.struct("w", "s", "n", "pos", "c")).alias("f"))
    pairs = weighed.join(first, "t").filter(F.expr("c <> f.c and " + _may_link("", "f.")))
    return pairs.select(F.greatest("s", "f.s").alias("b"), F.least("s", "f.s").alias("a")).distinct()


def remaining_pairs(met: DataFrame) -> DataFrame:
    """(a, b), a < b: sets of different components under one shingle whose sizes may link."""
    early = met.filter(f"pos <= n - ({NUMERATOR} * n + {DENOMINATOR - 1}) div {DENOMINATOR}")
    x, y = early.alias("x"), early.alias("y")
    meet = F.expr("x.t = y.t and x.s < y.s and x.c <> y.c and " + _may_link("x.", "y."))
    return x.join(y, meet).select(F.col("x.s").alias("a"), F.col("y.s").alias("b")).distinct()


def possible(pairs: DataFrame, described: DataFrame, work: Workspace) -> DataFrame:
    """The pairs whose prefixes share as much as those of sets that link must.

    Sets of n and m elements with the needed overlap v have at most n - v and m - v elements of their
    own, so the first min(p - (n - v), q - (m - v)) common elements lie in both prefixes, of lengths p
    and q.
    """
    ids = small(pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct())
    sets = having(described.select("s", "n", "prefix"), "s", ids).groupBy("s").agg(
        F.any_value("n").alias("n"), F.any_value("prefix").alias("p")
    )
    sets = work.stage(sets, "prefixes")
    both = pairs.join(sets.toDF("a", "na", "pa"), "a").join(sets.toDF("b", "nb", "pb"), "b")
    whole = NUMERATOR + DENOMINATOR
    both = both.withColumn("v", F.expr(f"({NUMERATOR} * (na + nb) + {whole - 1}) div {whole}"))
    least = "greatest(least(size(pa) - (na - v), size(pb) - (nb - v)), 1)"
    return both.filter(F.expr(f"size(array_intersect(pa, pb)) >= {least}")).select("a", "b")


# ---- verification ----------------------------------------------------------------------------


def walk(query: np.ndarray, members: list[np.ndarray], order: Order) -> np.ndarray:
    """Which members link with the query: a walk over the trie of the members' ordered sets.

    ``query`` is sorted by hash, members are in the global order. Neighbours in the sorted list of
    members share a path of the trie; the overlap along it is kept and only the new branch is counted.
    """
    ranks = [np.column_stack([order.rank(m), m.view(np.int64)]) for m in members]
    keys = sorted(range(len(members)), key=lambda i: ranks[i][:, :2].tobytes()) if len(members) > 1 else [0]
    linked = np.zeros(len(members), bool)
    path, overlap = np.zeros(0, np.uint64), np.zeros(1, np.int64)
    for i in keys:
        own = members[i]
        shorter = min(len(path), len(own))
        differ = np.flatnonzero(path[:shorter] != own[:shorter])
        depth = int(differ[0]) if len(differ) else shorter
        needed = needed_overlap(len(own), len(query))
        have = int(overlap[depth])
        if have + min(len(own) - depth, len(query) - have) < needed:
            # The whole rest of this branch is out of reach; the path stays at the shared beginning.
            path, overlap = own[:depth], overlap[: depth + 1]
            continue
        rest = own[depth:]
        at = np.minimum(np.searchsorted(query, rest), len(query) - 1)
        seen = np.concatenate([overlap[: depth + 1], have + np.cumsum(query[at] == rest)])
        path, overlap = own, seen
        linked[i] = seen[-1] >= needed
    return linked


def links(
    pairs: DataFrame, described: DataFrame, docs: DataFrame, order: Order, work: Workspace
) -> DataFrame:
    """The pairs (a, b) that link. Sets are made again from one document of each, so that whole sets
    are held only for candidates; the candidates of one set are verified in tries of bounded size."""
    wanted = small(pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct())
    held = having(described.select("s", "doc_id"), "s", wanted).groupBy("s")
    holders = small(held.agg(F.min("doc_id").alias("id")).select("id").distinct())
    texts = having(docs.select(F.col("doc_id").cast("long").alias("d"), "text"), "d", holders).select("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blobs = [], []
            for _, own in _sets(batch.column(0)):
                ids.append(set_id(own))
                blobs.append(order.sorted(own).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["s", "own"])

    sets = texts.mapInArrow(whole, "s bigint, own binary").join(wanted, "s", "semi")
    sets = work.stage(sets.groupBy("s").agg(F.any_value("own").alias("own")), "sets")
    # Candidates of a set with very many are dealt out over tries by a salt.
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.join(many, "a").withColumn(
        "part", F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / TRIE)).cast("int")
    ).drop("_n")
    dealt = work.stage(dealt, "dealt")
    members = dealt.join(sets.withColumnRenamed("s", "b"), "b").select("a", "part", "b", "own")
    queries = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("s", "a"), "a")
    # The searched set comes to each of its tries as a member that is itself.
    rows = members.unionByName(queries.select("a", "part", F.col("a").alias("b"), "own"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, np.uint64) for x in group["own"]]
        is_query = (group["b"] == group["a"]).to_numpy()
        query = np.sort(own[int(np.flatnonzero(is_query)[0])])
        at = np.flatnonzero(~is_query)
        linked = walk(query, [own[i] for i in at], order)
        return group.iloc[at[linked]][["a", "b"]]

    return rows.groupBy("a", "part").applyInPandas(verify, "a bigint, b bigint")


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, copies) of every document: the size of its set, the least
    doc_id reachable by links, and how many documents have this very set."""
    text_batches(docs.sparkSession)
    with Workspace(docs.sparkSession) as work:
        order = frequent_shingles(docs)
        described = profile(docs, order, work)
        met = meetings(described, work).withColumn("c", F.col("s"))
        found = tried = labels = None
        for i in range(ROUNDS + 1):
            pairs = first_pairs(met, i == 0) if i < ROUNDS else remaining_pairs(met)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "anti")
            pairs = work.stage(pairs, "pairs")
            tried = pairs if tried is None else tried.unionByName(pairs)
            likely = work.stage(possible(pairs, described, work), "possible")
            new = work.stage(links(likely, described, docs, order, work), "links")
            if not new.isEmpty():
                found = new if found is None else found.unionByName(new)
                labels = components(found)
            if i < ROUNDS:
                met = _apart(met, labels, work)
        return stage(_assigned(described, labels, work), "documents")


def _apart(met: DataFrame, labels: DataFrame | None, work: Workspace) -> DataFrame:
    """Meetings with components, only under shingles where different components meet."""
    if labels is not None:
        met = met.drop("c").join(labels.toDF("s", "c"), "s", "left").withColumn("c", F.coalesce("c", "s"))
    mixed = met.groupBy("t").agg(F.min("c").alias("_a"), F.max("c").alias("_b")).filter("_a <> _b")
    return work.stage(met.join(mixed.select("t"), "t"), "met")


def _assigned(described: DataFrame, labels: DataFrame | None, work: Workspace) -> DataFrame:
    sets = described.filter("n > 0").groupBy("s").agg(
        F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("copies")
    )
    if labels is not None:
        sets = sets.join(labels.toDF("s", "c"), "s", "left").withColumn("c", F.coalesce("c", "s"))
    else:
        sets = sets.withColumn("c", F.col("s"))
    sets = work.stage(sets, "classes")
    least = sets.groupBy("c").agg(F.min("_first").alias("_least"))
    classes = work.stage(sets.join(least, "c").select("s", "_least", "copies"), "components")
    known = described.filter("n > 0").select("doc_id", "n", "s").join(classes, "s")
    known = known.select("doc_id", F.col("n").alias("n_shingles"), F.col("_least").alias("component_id"), "copies")
    empty = described.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("copies")
    )
    return known.unionByName(empty)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the least doc_id, with all its columns.

    Of rows that share this doc_id the first by all columns' hash stays; a NULL doc_id comes last. Only ids
    are shuffled. Where a doc_id repeats or is NULL, rows are staged and told apart by a number of their own.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    per_id = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if per_id.filter("n > 1 or doc_id is null").isEmpty():
        joined = link_components(docs)
        return having(docs, "doc_id", stage(joined.filter("doc_id = component_id").select("doc_id"), "kept"))
    row = unused(docs, "_row")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    joined = link_components(held.select(F.col(row).alias("doc_id"), "text"))
    order = held.select(
        F.col(row).alias("_of"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias("hash"),
    )
    placed = joined.select(F.col("doc_id").alias("_of"), "component_id").join(order, "_of")
    first = placed.groupBy("component_id").agg(F.min(F.struct("unknown", "id", "hash", "_of")).alias("first"))
    return having(held, row, stage(first.select("first._of"), "kept")).drop(row)
