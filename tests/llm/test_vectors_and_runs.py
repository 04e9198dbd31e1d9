"""Top-k search, centroid clustering and run detection against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from courtline.llm import bitplanes, runs, topk
from courtline.llm.vectors import integer_vectors

from .helpers import awkward, same_rows, table

SCHEMA = "vec_id bigint, embedding array<float>, label int"
WEIRD = [
    (None, [0.5] * 64, 1),
    (3, None, 1),
    (5, [0.25] * 63 + [None], 1),
    (7, [0.25] * 63 + [float("nan")], None),
    (9, [0.25] * 63 + [float("inf")], 1),
    (40, [0.125] * 10, 1),
    (60, [], 1),
    (80, [-0.5] * 64, 1),
    (80, [-0.5] * 64, 1),
    (11, [1e30] + [0.0] * 63, 1),
    (100, [0.0] * 64, 1),
]


def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def many(n, seed, spread=0.0, groups=5, noise=0.05):
    """Vectors around a few directions, with lengths that differ by ``spread``; some repeat."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 64))
    out = []
    for i in range(n):
        v = centres[rng.integers(groups)] + noise * rng.normal(size=64)
        v = v / np.linalg.norm(v) * math.exp(spread * rng.normal())
        out.append((int(i), [float(np.float32(x)) for x in v], 0))
    return out + [(n + j, out[j][1], 0) for j in range(0, n, 7)]


def integers(rows, scale, bound, width=None):
    out = []
    for vec_id, x, _ in rows:
        if x is None or any(v is None or not math.isfinite(v) for v in x) or (width and len(x) != width):
            continue
        out.append((vec_id, [max(-bound, min(bound, math.floor(float(np.float32(v)) * scale))) for v in x]))
    return out


# ---- top-k -----------------------------------------------------------------------------------


def plain_top_k(rows):
    own = integers(rows, topk.SCALE, topk.BOUND)
    out = []
    for i, (q, x) in enumerate(own):
        if q is None or q % topk.EVERY:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), c is None, c) for j, (c, y) in enumerate(own) if j != i]
        scored.sort(key=lambda t: (t[0], t[1], t[2] or 0))
        out += [(q, r, c, -s) for r, (s, _, c) in enumerate(scored[: topk.K], 1)]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("spread,noise", [(0.0, 0.02), (0.6, 0.02), (1.0, 1.0)])
def test_top_k_equals_all_products(spark, monkeypatch, spread, noise):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "GROUP", 2)
    rows = many(400, 1, spread, noise=noise) + WEIRD
    assert same_rows(topk.top_k(vectors(spark, rows))) == plain_top_k(rows)


def test_both_prunings_are_used_and_lose_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 64))
    centres *= 320 / np.linalg.norm(centres, axis=1)[:, None]
    values = centres[rng.integers(60, size=3000)] + rng.normal(size=(3000, 64)) * 3
    values *= np.where(rng.random((3000, 1)) < 0.3, 0.5, 1.0)
    values = np.floor(values).astype(np.int64)
    squares = (values**2).sum(axis=1)
    order = np.argsort(-squares, kind="stable")
    values, squares = values[order], squares[order]
    every = topk.Block(np.arange(3000), np.arange(3000), np.ones(3000, bool), squares, values)

    def part(at):
        return topk.Block(*(getattr(every, x)[at] for x in ("rows", "ids", "named", "squares", "values")))

    used = {"coordinates": 0, "length": 0, "left out": 0}
    by_coordinates, by_length = topk._by_coordinates, topk._by_length
    monkeypatch.setattr(topk, "_by_coordinates", lambda *a: (lambda few: (used.__setitem__("coordinates", used["coordinates"] + int(few.sum())), few)[1])(by_coordinates(*a)))
    monkeypatch.setattr(topk, "_by_length", lambda q, c, at, *a: (used.__setitem__("length", used["length"] + len(at)), by_length(q, c, at, *a))[1])
    q = part(np.arange(0, 3000, 20))
    best = topk.Best(len(q.rows))
    blocks = [part(np.arange(i, i + 500)) for i in range(0, 3000, 500)]
    for c in blocks:
        used["left out"] += int((topk.local_thresholds(q, c, best.theta) > 1).sum())
        topk.search(q, c, best)
    assert all(used.values()), used
    for i in range(len(q.rows)):
        scores = values @ q.values[i]
        scores[q.rows[i]] = -(1 << 60)
        want = np.lexsort((np.arange(3000), -scores))[: topk.K]
        mine = best.query == i
        assert list(best.id[mine]) == list(want) and list(best.score[mine]) == list(scores[want])


def test_top_k_of_awkward_tables(spark):
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(0, None, 1)])).count() == 0
    assert topk.top_k(vectors(spark, [(0, [1.0], 1)])).count() == 0
    assert same_rows(topk.top_k(vectors(spark, WEIRD))) == plain_top_k(WEIRD)
    from pyspark.sql import functions as F

    more = vectors(spark, WEIRD).select("*", *(F.lit(1).alias(c) for c in ("row", "square", "values", "bucket", "rank", "n")))
    assert same_rows(topk.top_k(more)) == plain_top_k(WEIRD)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(100, 0, -1)]
    got = topk.top_k(vectors(spark, rows)).filter("query_id = 20").orderBy("rank").collect()
    assert [r.vec_id for r in got] == [*range(1, 20), 21]


# ---- clustering ------------------------------------------------------------------------------


def plain_clusters(rows, k=bitplanes.CENTROIDS):
    own = integers(rows, bitplanes.SCALE, bitplanes.BOUND, 64)
    named = sorted(
        ((hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~"), x) for i, x in own
    )
    centroids = [x for _, x in named[:k]]

    def assign():
        out = []
        for _, x in own:
            apart = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((min(apart), apart.index(min(apart))))
        return out

    for _ in range(bitplanes.ROUNDS):
        members = {}
        for (_, c), (_, x) in zip(assign(), own):
            members.setdefault(c, []).append(x)
        for c, of in members.items():
            centroids[c] = [sum(column) // len(of) for column in zip(*of)]
    last = assign()
    inertia = {c: sum(d for d, e in last if e == c) for _, c in last}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    out = [(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(own, last)]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("rows", [many(220, 2), many(30, 3) + WEIRD, WEIRD], ids=["many", "mixed", "weird"])
def test_clusters_equal_a_plain_version(spark, monkeypatch, rows):
    monkeypatch.setattr(bitplanes, "BLOCK", 50)
    monkeypatch.setattr(bitplanes, "STRIP", 7)
    assert same_rows(bitplanes.cluster(vectors(spark, rows))) == plain_clusters(rows)


def test_planes_give_exact_products():
    rng = np.random.default_rng(0)
    for most in (1, 2, 130, 1 << 24):
        x, c = rng.integers(-most, most + 1, (40, 64)), rng.integers(-most, most + 1, (9, 64))
        assert (bitplanes.unpack(bitplanes.pack(x)) == x).all()
        assert (bitplanes.products(bitplanes.pack(x), bitplanes.pack(c)) == x @ c.T).all()


def test_clusters_of_awkward_tables(spark):
    from pyspark.sql import functions as F

    assert bitplanes.cluster(vectors(spark, [])).count() == 0
    assert bitplanes.cluster(vectors(spark, [(0, [1.0], 1), (1, None, 1)])).count() == 0
    same = [(i, [0.5] * 64, 0) for i in range(60)]
    assert {(r.cluster, r.distance) for r in bitplanes.cluster(vectors(spark, same)).collect()} == {(0, 0)}
    more = vectors(spark, WEIRD).select("*", *(F.lit(1).alias(c) for c in ("values", "cluster", "distance", "h", "n")))
    assert same_rows(bitplanes.cluster(more)) == plain_clusters(WEIRD)


def test_components_are_floors_of_doubles(spark):
    got = integer_vectors(vectors(spark, [(1, [-0.001, 0.1, 1e9], 0)]), 256, 1 << 24).first()["values"]
    assert got == [-1, math.floor(256 * float(np.float32(0.1))), 1 << 24]


# ---- runs ------------------------------------------------------------------------------------


def plain_runs(words, least=6, power=4):
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, power * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, q, length) for (s, length), q in found.items())


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
@pytest.mark.parametrize("power", [3, 4])
def test_runs_equal_all_periods(letters, power):
    rng = random.Random(letters)
    texts = []
    for _ in range(150):
        words = [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            words += [rng.randrange(letters) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 12)
            words += [rng.randrange(letters) for _ in range(rng.randrange(4))]
        texts.append(words)
    codes = np.array([w for t in texts for w in t], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, start, length, period = runs.find_runs(codes, offsets, power=power)
    for r, words in enumerate(texts):
        mine = row == r
        got = list(zip(start[mine].tolist(), period[mine].tolist(), length[mine].tolist()))
        assert got == plain_runs(words, power=power)


def test_runs_in_sight_of_each_other_and_collapse(spark):
    text = "x " + "a b " * 4 + "c " * 7 + "tail " + "a  b\n" * 5
    docs = table(spark, [(1, text, "en", "a"), (2, "one " * 5, "en", "a"), (3, "one " * 6, "en", "a"), (4, "é " * 8, "en", "a")])
    got = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 8, 2), (9, 7, 1), (17, 10, 2)]
    assert got[1].collapsed == "x a b c tail a b"
    assert got[2].runs == [] and got[2].collapsed == "one one one one one"
    assert got[3].collapsed == "one" and got[4].collapsed == "é"


def test_very_long_periodic_text(spark):
    phrase = [f"w{i}" for i in range(20_000)]
    words = ["start"] + phrase * 6 + ["end"]
    row = runs.periodic_runs(table(spark, [(1, " ".join(words), "en", "a")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 120_000, 20_000)]
    assert row.collapsed.split() == ["start", *phrase, "end"]


def test_digest_names_the_longest_run(spark):
    docs = table(spark, [(1, "a b " * 4 + "x " + "c " * 8 + "y", "en", "a"), (2, None, "en", "a")])
    one, none = runs.digest(runs.periodic_runs(docs)).orderBy("doc_id").collect()
    assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (2, 0, 8, 2, 4000)
    assert one.runs_sha256 == hashlib.sha256(b"0,8,2\n9,8,1\n").hexdigest()
    assert one.collapsed_sha256 == hashlib.sha256(b"a b x c y").hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(none) == (2, 0, None, None, None, None, nothing, nothing)


def test_planting_repeats_own_words(spark):
    import zlib

    docs = awkward(spark)
    got = {}
    for r in runs.with_planted_runs(docs).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for r in docs.collect():
        h = zlib.crc32(str(r.doc_id).encode())
        words = (r.text or "").encode().split()
        if r.doc_id is None or h % 10 or not words:
            assert (r.text or "") in got[r.doc_id]
            continue
        n, g = len(words), h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert b" ".join(want).decode() in got[r.doc_id]
