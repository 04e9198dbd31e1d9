"""Every stage of the pipeline against a plain version on its own input, and the chain as a whole."""

import collections
import random
import zlib

import pytest

import corpus_pipeline
from courtline.llm import quality

from .conftest import SF001
from .helpers import table
from .test_methods import SPLIT, shingle_set

WORDS = [f"{a}{b}{c}" for a in "bdfgklmnp" for b in "aeiou" for c in ("st", "rn", "ld", "x")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if i % 11 == 10 else "") for i in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The smallest given documents with planted ones behind them, and the folder with both tables."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(1, prose(500, 30)), (2, prose(501, 12)), (3, None), (4, "of three words")]
    given = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    junk = " ".join(w + "$$" for w in prose(40, 80).split())
    planted = [
        (10_001, prose(1, 90)), (10_002, prose(1, 90)), (10_003, prose(1, 89) + " changed"),
        (10_004, prose(2, 20)), (10_005, "again and again " * 40), (10_006, junk),
        (10_007, prose(3, 60) + " " + prose(500, 30) + " " + prose(4, 60)), (10_008, prose(5, 60) + " " + prose(501, 12)),
        (10_009, prose(6, 400)), (10_010, None), (10_011, prose(7, 120)), (10_012, prose(8, 120)),
    ]
    docs = given.unionByName(table(spark, [(i, t, "en", "src1") for i, t in planted]))
    docs.coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, folder)
        out.write.mode("overwrite").parquet(f"{folder}/after{i}")
        after = spark.read.parquet(f"{folder}/after{i}")
        yield name, docs.collect(), after.collect(), after.columns
        docs = after


def features(text):
    w = SPLIT.findall(text or "")
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {p for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if SPLIT.search(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in quality.SYMBOLS for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


def good(docs):
    measured = [(d, features(d.text)) for d in docs]
    rules = {r: compile(c, r, "eval") for r, c in quality.HOST_RULES.items()}
    failed = {r: {d.doc_id for d, f in measured if eval(c, {}, f)} for r, c in rules.items()}
    hosts = collections.defaultdict(set)
    for d in docs:
        hosts[d.source].add(d.doc_id)
    bad = set()
    for r, ids in failed.items():
        rates = [len(h & ids) / len(h) for h in hosts.values()]
        m = sum(rates) / len(rates)
        v = sum((x - m) ** 2 for x in rates) / len(rates)
        k = max(m * (1 - m) / v - 1, 0) if v > 0 else quality.WEAK_PRIOR
        bad |= {(host, r) for host, h in hosts.items() if (len(h & ids) + m * k) / (len(h) + k) > quality.HOST_RATES[r]}
    base = failed["short"] | failed["repetitive"]
    return {d.doc_id for d in docs if d.doc_id not in base and not any(d.doc_id in failed[r] and (d.source, r) in bad for r in failed)}


def one_of_each(docs):
    sets = {d.doc_id: shingle_set(d.text) for d in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def clean(docs, items):
    wanted = [s for s in (shingle_set(i.text) for i in items) if s]
    return {d.doc_id for d in docs if not any(10 * len(shingle_set(d.text) & s) >= 8 * len(s) for s in wanted)}


def test_every_stage_equals_a_plain_version(spark, corpus):
    items = spark.read.parquet(f"{corpus}/benchmark.parquet").collect()
    columns = spark.read.parquet(f"{corpus}/documents.parquet").columns
    seen = {}
    for name, before, after, names in stages(spark, corpus):
        seen[name] = {r.doc_id for r in after}
        if name == "quality rules":
            assert seen[name] == good(before)
            assert not seen[name] & {10_004, 10_005, 10_006, 10_010} and 10_011 in seen[name]
        elif name == "n-gram Jaccard join":
            assert seen[name] == one_of_each(before)
            assert 10_001 in seen[name] and not seen[name] & {10_002, 10_003}
        elif name == "benchmark decontamination":
            assert seen[name] == clean(before, items)
            assert not seen[name] & {10_007, 10_008} and 10_009 in seen[name]
        elif name == "mixing sources to target weights":
            text = {r.doc_id: r.text for r in before}
            copies = collections.Counter(r.doc_id for r in after)
            assert set(copies) <= set(text) and max(copies.values()) <= 3
            assert all(r.text == text[r.doc_id] for r in after)
            sizes, taken, own = collections.Counter(), collections.Counter(), collections.defaultdict(list)
            for r in before:
                n = len(SPLIT.findall(r.text or ""))
                sizes[r.source] += n
                taken[r.source] += n * copies[r.doc_id]
                own[r.source].append(n)
            order = sorted(sizes)
            weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
            target, free, left = {}, set(order), float(sum(sizes.values()))
            while free:
                level = left / sum(weight[s] for s in free)
                full = {s for s in free if weight[s] * level > 3 * sizes[s]}
                for s in full or free:
                    target[s] = 3.0 * sizes[s] if full else weight[s] * level
                left -= sum(target[s] for s in full)
                free = free - full if full else set()
            assert all(abs(taken[s] - target[s]) <= max(own[s]) for s in order)
        else:
            assert collections.Counter(r.doc_id for r in after) == collections.Counter(r.doc_id for r in before)
            per = collections.defaultdict(list)
            for r in after:
                per[r.shard].append(r.slot)
            assert all(sorted(slots) == list(range(len(slots))) for slots in per.values())
            sizes = [len(per.get(i, ())) for i in range(24)]
            assert max(sizes) - min(sizes) <= 1
            raw = {r.doc_id: (r.text or "").encode() for r in before}
            assert all((r.size, r.text_crc32) == (len(raw[r.doc_id]) + 8, zlib.crc32(raw[r.doc_id])) for r in after)
        if name != "sharding":
            assert names == columns


def test_the_chain_runs_as_its_stages_do(spark, corpus):
    whole = corpus_pipeline.run(spark, corpus)
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= set(whole.columns)
    last = [tuple(r) for r in spark.read.parquet(f"{corpus}/after{len(corpus_pipeline.STAGES) - 1}").select(whole.columns).collect()]
    assert sorted(map(tuple, whole.collect())) == sorted(last)
