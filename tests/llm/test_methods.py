"""Each method against a brute-force counterpart."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from courtline.llm import jaccard, language, mixing, pii, queries, records, sharding, substrings, suffixes, token_counts
from courtline.llm.common import lookup, release, scratch, stage
from courtline.llm.components import components
from courtline.llm.suffixes import suffix_arrays
from courtline.llm.wordcache import WordCache

from .helpers import PLAIN, same_rows, table

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = SPLIT.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_components_are_exact(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_staged_files_go_when_released(spark):
    docs = table(spark, [(1, PLAIN, "en", "a"), (2, None, None, None)])
    folder = scratch(spark)
    kept = stage(docs, "one")
    assert kept.count() == 2 and len(sharding.shard(docs).collect()) == 2
    assert os.path.isdir(folder) and os.listdir(folder)
    release(spark)
    release(spark)
    assert not os.path.exists(folder)
    assert stage(docs, "one").count() == 2 and scratch(spark) != folder


@pytest.mark.parametrize("copies", [False, True])
def test_components_of_a_star(spark, monkeypatch, copies):
    """A node with 100,000 edges, least or greatest of its component, and a tail behind one of its leaves."""
    if copies:  # lookups as for tables too large to be broadcast
        monkeypatch.setattr(lookup, "__defaults__", (None, 0))
    leaves = spark.range(1, 100_001).select(F.col("id").alias("a"), F.lit(200_000).cast("long").alias("b"))
    low = spark.range(300_001, 302_001).select(F.lit(300_000).cast("long").alias("a"), F.col("id").alias("b"))
    tail = spark.createDataFrame([(100_000, 250_000), (250_000, 250_001), (250_001, 250_002), (None, 7), (8, 8)], "a bigint, b bigint")
    got = components(leaves.unionByName(low).unionByName(tail))
    assert {tuple(r) for r in got.groupBy("component").count().collect()} == {(1, 100_004), (300_000, 2_001)}
    assert got.filter("node >= 300000 and component <> 300000").isEmpty()


def test_links_equal_all_pairs(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 90))] for _ in range(12)]
    docs = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(60)}"
        docs.append((i, " ".join(words), "en", "a"))
    sets = [shingle_set(d[1]) for d in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(table(spark, docs)).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(docs))}


@pytest.mark.parametrize("seed", range(4))
def test_suffix_arrays_sort(seed):
    rng = np.random.default_rng(seed)
    strings, buckets, text = [0], [0], []
    for _ in range(6):
        for _ in range(rng.integers(1, 6)):
            s = rng.integers(0, rng.integers(1, 4), rng.integers(1, 40)).astype(np.uint8)
            text.append(np.tile(s[:3], 12)[: len(s)] if rng.random() < 0.3 else s)
            strings.append(strings[-1] + len(text[-1]))
        buckets.append(strings[-1])
    flat, strings, buckets = np.concatenate(text), np.array(strings), np.array(buckets)
    order = suffix_arrays(flat, strings, buckets)
    end = np.repeat(strings[1:], np.diff(strings))
    for a, b in zip(buckets[:-1], buckets[1:]):
        assert sorted(order[a:b]) == list(range(a, b))
        suffixes = [bytes(flat[i : end[i]]) for i in order[a:b]]
        assert suffixes == sorted(suffixes)


def removed_by_force(docs):
    first = {}
    for d, t in sorted(docs):
        raw = t.encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d)
    out = {}
    for d, t in docs:
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < d:
                gone[i : i + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if raw else 0
        out[d] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("bucket", [2, 64])
def test_substrings_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET", bucket)
    rng = random.Random(bucket)
    passages = ["".join(rng.choices("abc d", k=rng.randrange(40, 130))) for _ in range(6)]
    docs = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdé \n", k=40)) for _ in range(4)]
        docs.append((i, "".join(parts) if i % 40 else "%" * 300))
    got = substrings.deduplicate(table(spark, [(d, t, "en", "a") for d, t in docs])).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed_by_force(docs)


def test_equal_ids_are_not_smaller_than_each_other(spark):
    docs = table(spark, [(5, PLAIN, "en", "a"), (5, PLAIN, "en", "b"), (7, PLAIN, "en", "a"), (None, "no " * 40, "en", "a")])
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.deduplicate(docs).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (7, len(PLAIN))]


def test_word_cache_equals_the_tokenizer(documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["", " ", "ΣΑΣ. <|ENDOFTEXT|>, A.<|endoftext|>", "é. É. क़x", "a.. b., don't x._ 1. ³", "\x1cq\tz İx."]
    cache = WordCache(path, held=50)
    ids, bounds = cache.encode(texts)
    expected = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [e.ids for e in expected]


def test_frames_round_trip_and_notice_damage():
    for doc_id, ids in ((None, []), (-3, [1, 2, 70_000]), (2**60, [0] * 1000)):
        data = records.frame(doc_id, np.array(ids, np.uint32))
        length, got, back = records.unframe(b"xx" + data, 2)
        assert (length, got, back.tolist()) == (len(data), doc_id, ids)
        for at in (0, 9, 14, len(data) - 1):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises(ValueError):
                records.unframe(bytes(bad))


def test_shuffled_reads_return_every_record(spark, documents, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    records.write_records(documents, str(tmp_path / "r"), path, file_bytes=100_000)
    records.write_index(spark, str(tmp_path / "r"), str(tmp_path / "i"))
    index = records.token_starts(spark.read.parquet(str(tmp_path / "i")))
    assert index.select("file").distinct().count() > 2
    got = records.read_shuffled(spark, str(tmp_path / "r"), index, 1).collect()
    sizes = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in index.collect()}
    assert {r.doc_id: (len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got} == sizes
    assert [r.doc_id for r in got] != sorted(r.doc_id for r in got)
    start = 0
    for r in index.orderBy("doc_id").collect():
        assert r.start == start
        start += r.n_tokens


def test_token_tree_equals_encoding_again(monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 4)
    pieces = token_counts.PieceCounts(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng, parts = random.Random(1), ["a", "the", " ", "  ", "\n", "'", "'s", "'re", "23", "é", "%", "$ ", "日", " \t"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randrange(60)))
        tree = token_counts.TokenTree(pieces, text)
        for _ in range(4):
            at, n, new = rng.randint(0, len(text)), rng.randrange(7), "".join(rng.choices(parts, k=rng.randrange(5)))
            tree.apply(at, n, new)
            text = text[:at] + new + text[at + n :]
            assert tree.text() == text and tree.n_chars == len(text)
            assert tree.n_tokens == len(pieces.encoding.encode_ordinary(text))


def test_edits_encode_little_again(documents):
    pieces = token_counts.PieceCounts(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = " ".join(r.text for r in documents.limit(50).collect())
    tree = token_counts.TokenTree(pieces, text)
    tree.apply(len(text) // 2, 5, "changed")
    assert 0 < tree.reencoded < 20 and tree.n_tokens == len(pieces.encoding.encode_ordinary(tree.text()))


def test_hilbert_order_moves_one_cell_at_a_time():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
        order = np.argsort(sharding.hilbert_index(cells, bits))
        assert sorted(sharding.hilbert_index(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_and_gapless(spark, documents):
    got = sharding.shard(documents).collect()
    per = collections.defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
    assert set(per) == set(range(24)) and {len(v) for v in per.values()} <= {8, 9}
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_mix_meets_targets_and_repeats(spark, documents):
    first, again = (sorted(tuple(r) for r in mixing.mix(documents.repartition(n)).collect()) for n in (3, 7))
    assert first == again
    names = mixing.mix(documents).columns
    taken, target = collections.Counter(), {}
    for r in (dict(zip(names, x)) for x in first):
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    total = sum(r[names.index("size")] for r in first)
    assert abs(sum(target.values()) - total) < 1e-6 * total
    # Ten documents to a source here: whole copies come within a twentieth.
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target)


def test_targets_stop_at_three_times_the_source(spark):
    docs = table(spark, [(i, "w " * n, "en", s) for i, (s, n) in enumerate([("a", 1), ("b", 100), ("c", 50), (None, 7), ("d", 0)])])
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    sizes, weights = {"a": 1, "b": 100, "c": 50, "d": 0, None: 7}, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    share, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), 158.0
    while True:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            share[s] = 3.0 * sizes[s]
            left -= share[s]
        open_ -= over
    share |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(share)


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = language.BiGRU(3)
    x, label = rng.integers(0, 256, (7, 5)), rng.integers(0, 3, 5)
    mask = np.sort(rng.random((7, 5)) < 0.8, axis=0)[::-1]
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, grads = net.gradients(x, mask, label)
    for k, v in net.p.items():
        for _ in range(4):
            i = tuple(int(rng.integers(0, n)) for n in v.shape)
            i = (int(x[0, 0]), i[1]) if k[0] == "W" else i
            old, e = v[i], 1e-4
            v[i] = old + e
            up = net.gradients(x, mask, label)[0]
            v[i] = old - e
            down = net.gradients(x, mask, label)[0]
            v[i] = old
            assert abs((up - down) / (2 * e) - grads[k][i]) < 1e-5


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def spans_by_force(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            fine = (
                True,
                k != 1 or all(int(x) <= 255 for x in m.group().split(".")),
                14 <= len(digits) <= 19 and luhn,
                10 <= len(digits) <= 15,
            )[k]
            if fine:
                out.append((m.start(), k, m.end()))
    return [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_base_spans_equal_the_patterns(spark, documents):
    odd = [
        "a@b.c_d@e.f a@b.cd@e.f x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 12.3.4.56",
        "4111 1111 1111 1111  4111-1111-1111-1111 4111--1111111111111111", "+1 (017) 555-7713 +12 +1()2345678901-",
        "É日 a..b@c.d..e@f.g 1@2.3.4.5", "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 " + "1" * 25, "@x.y a@b a@b.", "9" * 20_000,
    ]
    docs = documents.select("doc_id", "text").unionByName(
        spark.createDataFrame(list(enumerate(odd, 10_000)), "doc_id bigint, text string")
    )
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.report(docs).collect():
        listed = ",".join(spans_by_force(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), r.doc_id
        assert r.spans == listed


def test_terms_that_go_with_an_entity_are_found_and_replaced(spark):
    filler = [f"plain{i} words{i} here{i}" for i in range(40)]
    rows = [(i, f"{t} about nothing", "en", "a") for i, t in enumerate(filler)]
    rows += [(100 + i, f"{filler[i]} ask Zanzibar at boss@corp.example today {filler[-i]}", "en", "a") for i in range(4)]
    rows += [(200, "Zanzibar alone is no secret here", "en", "a")]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    text = dict((r[0], r[1]) for r in rows)
    found = {text[100][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[100].spans.split(",")) if k == "term"}
    assert "Zanzibar" in found and got[100].n_email == 1
    assert got[0].spans == "" and got[200].spans == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[100] and "Zanzibar" not in clean[100] and clean[200] == text[200]


def test_disclosing_terms_are_marked_far_from_the_entity_and_without_it(spark):
    far = " ".join(f"n{i}" for i in range(60))
    rows = [(i, f"plain{i} about nothing", "en", "a") for i in range(40)]
    rows += [(100 + i, f"Jean-Luc\t{far} {i} boss@corp.example {far}\n(Zanzibar), zanzibar", "en", "a") for i in range(4)]
    rows += [(200, "No  value here, only Zanzibar!", "en", "a")]
    text = {r[0]: r[1] for r in rows}

    def terms(**how):
        spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in pii.report(table(spark, rows), **how).collect()}
        return {d: [text[d][int(a) : int(b)] for k, a, b in x if k == "term"] for d, x in spans.items()}

    near, every = terms(), terms(everywhere=True)
    assert near[100] == every[100] == ["Jean-Luc", "Zanzibar", "zanzibar"]
    assert near[200] == [] and every[200] == ["Zanzibar"] and every[0] == []
    clean = {r.doc_id: r.text for r in pii.sanitise(table(spark, rows), everywhere=True).collect()}
    assert clean[200] == "No  value here, only [TERM]!"


def test_copies_of_a_text_do_not_hide_its_terms(spark):
    rows = [(i, f"plain{i} about nothing", "en", "a") for i in range(40)]
    held = [f"{i} ask Zanzibar at boss@corp.example" for i in range(3)]
    rows += [(100 + i, t, "en", "a") for i, t in enumerate(held + held[:1] * 40)]
    got = {r.doc_id: r for r in pii.report(table(spark, rows)).collect()}
    assert len({got[d].n_terms for d in range(100, 143)}) == 1 and got[100].n_terms == 3


def test_one_of_each_goes_by_rows_where_ids_repeat(spark):
    words = [f"{c}{i}" for c in "abcdefg" for i in range(40)]
    alone = [" ".join(words[40 * k : 40 * k + 40]) for k in range(7)]
    near = alone[5].rsplit(" ", 1)[0] + " changed"
    rows = [(None, t, "en", "a") for t in alone[:3]] + [(7, t, "en", "a") for t in alone[3:5]]
    rows += [(1, alone[5], "en", "a"), (8, near, "en", "a"), (8, alone[6], "en", "a"), (None, alone[6], "en", "b")]
    got = [(r.doc_id, r.text) for r in jaccard.one_of_each(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([r[:2] for r in rows[:6]] + [(8, alone[6])], key=str)


def test_any_number_of_rows_may_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(substrings, "TIE_BITS", 1, raising=False)
    rows = [(None, "".join(chr(97 + (i * k * k + k) % 23) for k in range(90)), "en", "a") for i in range(1, 10)]
    rows += [(3, rows[0][1] + " and more", "en", "a"), (4, rows[8][1], "en", "a"), (4, PLAIN, "en", "a"), (5, PLAIN, "en", "a")]
    docs, bits = substrings._numbered(table(spark, rows))
    numbers = {r.doc: r.doc_id for r in docs.collect()}
    assert len(numbers) == len(rows) and len({(n >> bits, d) for n, d in numbers.items()}) == 4
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.deduplicate(table(spark, rows)).collect())
    assert got == [(0, 0)] * 9 + [(3, 90), (4, 0), (4, 90), (5, len(PLAIN))]


def test_values_of_one_text_are_disclosed_by_their_class(spark):
    rows = [(i, f"plain{i} about nothing", "en", "a") for i in range(40)]
    rows += [(100 + i, f"{i} Zanzibar for clerk{i}@Corp.example", "en", "a") for i in range(4)]
    rows += [(110 + i, f"{i} Lisbon for 10.20.30.{i}", "en", "a") for i in range(4)]
    rows += [(120 + i, f"{i} Oslo, +44 20 7946 {1000 + i}", "en", "a") for i in range(4)]
    text = {r[0]: r[1] for r in rows}
    found = {}
    for r in pii.report(table(spark, rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        found[r.doc_id] = {text[r.doc_id][int(a) : int(b)] for k, a, b in spans if k == "term"}
    assert "Zanzibar" in found[100] and "Lisbon" in found[110] and found[120] == {"Oslo"} and not found[0]


def test_every_language_is_learned_however_many(spark):
    names = [f"l{i:03d}" for i in range(300)]
    docs = table(spark, [(10 * i + j, f"{chr(0x4E00 + i)} " * 12, x, "a") for i, x in enumerate(names) for j in range(6)])
    net, labels = language.fit(docs)
    assert labels == names and net.p["V"].shape[1] == len(net.p["c"]) == 300
    got = language.identify(docs)
    assert set(r.lang_pred for r in got.select("lang_pred").distinct().collect()) <= set(names)


def test_the_sample_is_bounded_in_rows_and_characters(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "train", lambda texts, of, n: seen.update(texts=texts, of=of, n=n))
    monkeypatch.setattr(language, "SAMPLE", 30)
    rows = [(i, "a" * 10_000 if i % 2 else f"b{i}" * 40_000, "x" if i % 2 else "y", "a") for i in range(400)]
    language.fit(table(spark, rows))
    assert seen["n"] == 2 and np.bincount(seen["of"]).tolist() == [15, 15]
    assert {len(t) for t in seen["texts"]} == {language.PIECE}


def test_predictions_equal_a_plain_forward_pass(spark, documents):
    """Per-byte states and pooled probabilities, one byte after another, in plain Python lists."""
    net, labels = language.fit(documents, 20)
    few = documents.orderBy("n_chars").filter("n_chars > 80").limit(6)

    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    def states(data, d):
        h, out, state = language.HIDDEN, [None] * len(data), np.zeros(language.HIDDEN)
        for t in range(len(data)) if d == "f" else reversed(range(len(data))):
            inner = net.p[f"W{d}"][data[t]] + net.p[f"b{d}"]
            rec = state @ net.p[f"U{d}"]
            z, r = sigmoid(inner[:h] + rec[:h]), sigmoid(inner[h : 2 * h] + rec[h : 2 * h])
            new = np.tanh(inner[2 * h :] + r * rec[2 * h :])
            state = (1 - z) * new + z * state
            out[t] = state
        return out

    from courtline.llm.shingles import text_slices
    import pyarrow as pa

    texts = [r.text for r in few.collect()]
    _, _, data, offsets = next(text_slices(pa.array(texts)))
    mean, _ = language.pooled(net, data, offsets)
    for text, got in zip(texts, mean):
        total, raw = np.zeros(len(labels)), text.encode()
        for i in range(0, len(raw), language.WINDOW):
            part = raw[i : i + language.WINDOW]
            for f, b in zip(states(part, "f"), states(part, "b")):
                score = np.concatenate([f, b]) @ net.p["V"] + net.p["c"]
                score = np.exp(score - score.max())
                total += score / score.sum()
        assert np.allclose(got, total / len(raw), atol=2e-3)


def test_equal_texts_share_a_shard_but_for_the_cuts(spark, documents):
    rows = sharding.shard(documents).collect()
    shards = collections.defaultdict(set)
    for r in rows:
        shards[(r.text_crc32, r.size)].add(r.shard)
    assert sum(len(s) - 1 for s in shards.values()) < sharding.SHARDS
    hot = table(spark, [(i, "the same text" if i % 3 else f"text {i}", "en" if i % 2 else None, f"s{i % 7}") for i in range(600)])
    got = sharding.shard(hot).filter("size = 21").select("shard").distinct().count()
    assert got <= 400 // 25 + 2


def test_copies_of_a_dealt_out_lookup_are_not_broadcast(spark, monkeypatch):
    """Equal texts in many cells, more than a lookup broadcasts: its copies are merged, whatever size Spark takes them for."""
    docs = table(spark, [(i, f"text {i % 40}", ("en", "de")[i // 40 % 2], f"s{i % 7}") for i in range(400)]).localCheckpoint()
    expected = same_rows(sharding.contract(sharding.shard(docs)))
    plans = []

    def dealt(df, moved, keys, spread=None):
        assert moved.count() > 4
        joined = lookup(df, moved, keys, spread, limit=4)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(sharding, "lookup", lambda df, moved, keys, *a: (dealt if len(keys) == 3 else lookup)(df, moved, keys, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        got = same_rows(sharding.contract(sharding.shard(docs)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_shards_equal_a_plain_sort(spark, documents):
    """Cells, the curve, the order and the cuts once more, row by row."""
    docs = [(r.doc_id, r.text or "", r.lang, r.source) for r in documents.collect()]
    n, top = len(docs), (1 << sharding.BITS) - 1

    def ordinal(values):
        known = sorted({v for v in values if v is not None}) + ([None] if None in values else [])
        before, at = {}, 0
        for v in known:
            before[v] = at * (top + 1) // n
            at += values.count(v)
        return before

    sources, langs = ordinal([d[3] for d in docs]), ordinal([d[2] for d in docs])
    low, high = min(d[0] for d in docs), max(d[0] for d in docs)
    step = (high - low) // (top + 1) + 1
    cells = [
        (sources[d[3]], langs[d[2]], (d[0] - low) // step, min(int(np.floor(np.log2((len(d[1].encode()) + 8) / 8) * 4)), top))
        for d in docs
    ]
    curve = sharding.hilbert_index(np.array(cells), sharding.BITS).tolist()
    first = {}
    for d, c in sorted(zip(docs, curve)):
        first.setdefault(d[1], c)
    got = {r.doc_id: (r.hilbert, r.shard, r.slot) for r in sharding.shard(documents).collect()}
    assert {d[0]: first[d[1]] for d in docs} == {i: h for i, (h, _, _) in got.items()}
    order = sorted(got, key=lambda i: got[i][1:])
    text = {d[0]: d[1] for d in docs}
    assert [got[i][0] for i in order] == sorted(h for h, _, _ in got.values())
    assert [got[i][1] for i in order] == [k * sharding.SHARDS // n for k in range(n)]
    assert [got[i][2] for i in order] == [k - next(j for j in range(n) if j * sharding.SHARDS // n == k * sharding.SHARDS // n) for k in range(n)]
    met = [text[i] for i in order]
    assert all(len(set(met[i : met.index(t) + met.count(t)])) == 1 for i, t in enumerate(met) if met.index(t) == i)


def test_ids_of_random_strings_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(8)
    alphabet = list("aAzZ  09.,;:!?'\"-_#<|>()") + list("İıΣσςéÉßŐfiⅧ²½日本한‐’…🙂") + [
        "́", "̇", "̧", "ͅ", "‍", " ", "\x1c", "\n", "é", "İ", "'s", "'RE", "<|endoftext|>", "<|STARTOFTEXT|>",
    ]
    cache, plain = WordCache(path, held=20_000), Tokenizer.from_file(path)
    for _ in range(20):
        texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 14))) for _ in range(5_000)]
        ids, bounds = cache.encode(texts)
        expected = plain.encode_batch(texts, add_special_tokens=False)
        wrong = [t for t, a, b, e in zip(texts, bounds[:-1], bounds[1:], expected) if ids[a:b].tolist() != e.ids]
        assert not wrong, wrong[:5]


def test_one_id_on_many_rows_is_spread_over_files(spark, tmp_path):
    rows = [(None if i % 2 else 7, f"text number {i} " * 40, "en", "a") for i in range(400)]
    records.write_records(table(spark, rows), str(tmp_path / "r"), public_tokenizers.path("word_bpe_49k.json"), file_bytes=20_000)
    records.write_index(spark, str(tmp_path / "r"), str(tmp_path / "i"))
    index = records.token_starts(spark.read.parquet(str(tmp_path / "i")))
    files = {r.doc_id: r.n for r in index.groupBy("doc_id").agg(F.countDistinct("file").alias("n")).collect()}
    assert min(files.values()) > 2
    ordered = index.orderBy("start").collect()
    assert [r.doc_id for r in ordered] == [None] * 200 + [7] * 200
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def _plain_terms(rows):
    """Every (entity, term) scored by the definition; the terms that disclose any entity."""
    texts = sorted({r[1] for r in rows})
    n = len(texts)
    word = re.compile(r"^(?=..)[^\W\d_]+(?:[-'’][^\W\d_]+)*$")
    of = {t: {w for w in (x.strip(pii._MARKS).lower() for x in t.split()) if word.match(w)} for t in texts}
    entities = collections.defaultdict(set)
    for t in texts:
        for address in re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t):
            entities[("value", address.lower())].add(t)
            entities[("class", address.split("@")[1].lower())].add(t)
    holding = collections.defaultdict(set)
    for t in texts:
        for w in of[t]:
            holding[w].add(t)
    chosen = set()
    for of_entity in entities.values():
        for w, of_term in holding.items():
            both = len(of_entity & of_term)
            if both and len(of_entity) < n:
                score = np.log(both * n / (len(of_entity) * len(of_term))) * (both / (both + 1)) ** 2
                if score >= pii.DISCLOSED * -np.log(len(of_entity) / n):
                    chosen.add(w)
    return chosen


def test_terms_equal_a_score_of_every_pair(spark):
    rng = random.Random(12)
    common = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(60)]
    rows = []
    for i in range(300):
        words = rng.choices(common, k=25)
        if i % 9 == 0:
            domain = rng.randrange(4)
            words.insert(rng.randrange(25), f"user{rng.randrange(8)}@corp{domain}.example")
            words += [f"hint{chr(97 + domain)}"] * (rng.random() < 0.8) + ["shared-clue"] * (rng.random() < 0.5)
        if i % 31 == 0:
            words.append(f"hint{chr(97 + rng.randrange(4))}")
        rows.append((i, " ".join(words), "en", "a"))
    rows += [(1000 + i, rows[9 * (i % 5)][1], "en", "a") for i in range(50)]
    text = {r[0]: r[1] for r in rows}
    want = _plain_terms(rows)
    assert any(w.startswith("hint") for w in want)
    for r in pii.report(table(spark, rows), everywhere=True).collect():
        found = {text[r.doc_id][int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"}
        assert found == {w for w in text[r.doc_id].split() if w in want}


def test_sanitising_goes_by_rows(spark):
    rows = [(None, "write to a@b.example now", "en", "a"), (5, "one c@d.example", "en", "a"), (5, "two", "en", "a"), (5, "one c@d.example", "en", "a")]
    got = sorted((r.doc_id or 0, r.text) for r in pii.sanitise(table(spark, rows)).collect())
    assert got == [(0, "write to [EMAIL] now"), (5, "one [EMAIL]"), (5, "one [EMAIL]"), (5, "two")]


def test_verdicts_on_hosts_take_junk_and_leave_the_rest(spark):
    from courtline.llm import quality

    words = " ".join(f"w{i}" for i in range(70))
    junk = " ".join(f"w{i}&&" for i in range(70))
    bars = " ".join(f"w{i} |" if i % 2 else f"w{i}" for i in range(70))
    rows = [(i, words, "en", f"h{i % 4}") for i in range(200)]
    rows += [(300 + i, junk, "en", "h1") for i in range(10)] + [(400 + i, bars, "en", "h1") for i in range(10)]
    rows += [(500 + i, words, "en", "h9") for i in range(3000)] + [(4000, junk, "en", "h9")]
    got = {r.doc_id: r for r in quality.quality_rules(table(spark, rows)).collect()}
    assert all(not got[300 + i].kept and got[300 + i].host_failed for i in range(10))
    assert all(got[400 + i].kept for i in range(10)) and all(got[i].kept for i in range(200))
    assert got[4000].kept  # one among three thousand is not the host's habit


@pytest.mark.parametrize("bucket", [1, 3, 10_000])
def test_a_passage_in_a_third_of_all_documents(spark, monkeypatch, bucket):
    """Near copies of one template, a passage quoted at many places, copies, and ids that repeat or are NULL."""
    monkeypatch.setattr(substrings, "BUCKET", bucket)
    rng = random.Random(21)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    template, passage = noise(400), noise(160)
    rows = []
    for i in range(60):
        t = list(template)
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = "#"
        rows += [(3 * i, "".join(t)), (3 * i + 1, noise(rng.randrange(90)) + passage + noise(40)), (3 * i + 2, noise(200))]
    rows += [(None, template), (None, template), (7, template), (7, rows[6][1]), (500, rows[1][1]), (501, rows[1][1])]
    rng.shuffle(rows)
    starts = {}
    for d, t in rows:
        for k in range(len(t) - 49):
            starts[t[k : k + 50]] = min(starts.get(t[k : k + 50], 10**9), -1 if d is None else d)
    want = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if starts[t[k : k + 50]] < (-1 if d is None else d):
                gone[k : k + 50] = True
        kept = "".join(c for c, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept.encode()).hexdigest()))
    got = substrings.deduplicate(table(spark, [(d, t, "en", "a") for d, t in rows])).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_large_buckets_keep_only_what_may_repeat(spark, monkeypatch):
    """Fragments of one anchor: those that share no window drop out, equal parts need no order, others become buckets."""
    monkeypatch.setattr(substrings, "BUCKET", 3)
    rng = random.Random(4)
    anchor = b"0123456789abcdef"
    letters = b"ghijklmnopqrstuvwxyz"

    def noise(n):
        return bytes(rng.choice(letters) for _ in range(n))

    schema = "key bigint, ctx bigint, shape int, m bigint, most bigint, bytes binary, bucket bigint, skip int"

    def parts(texts):
        rows = [(1, i, 34 << 6 | 35, i, i, bytearray(t), 1, 0) for i, t in enumerate(texts)]
        with substrings.Workspace(spark) as work:
            verdicts, usual = substrings._parts_of_large(spark.createDataFrame(rows, schema), work)
            return [tuple(r) for r in verdicts.collect()], [tuple(r) for u in usual for r in u.select("ctx", "skip", "shape").collect()]

    assert parts([noise(34) + anchor + noise(34) for _ in range(30)]) == ([], [])
    tail = noise(34)
    verdicts, usual = parts([noise(32) + bytes([128 + i]) + b"g" + anchor + tail for i in range(30)])
    # Windows 33 and 34 alone begin at or behind the shared byte.
    assert not usual
    assert {(ctx, w) for _, ctx, a, b, m in verdicts for w in range(a, b + 1) if m == 0} == {
        (i, w) for i in range(1, 30) for w in (33, 34)
    }


@pytest.mark.parametrize("depth", [5, 50, 64])
def test_suffix_arrays_to_a_depth(monkeypatch, depth):
    """Suffixes of enough bytes by these bytes alone, in as many sorts for many unlike buckets as for one."""
    rng = random.Random(depth)
    sorts = []
    dense = suffixes._dense
    monkeypatch.setattr(suffixes, "_dense", lambda key: sorts.append(1) or dense(key))
    taken = set()
    for n_buckets in (1, 40):
        strings, buckets, text = [0], [0], b""
        for _ in range(n_buckets):
            base = bytes(rng.choice(b"ab\x00\xff") for _ in range(84))
            for _ in range(rng.randrange(1, 30)):
                k = rng.randrange(80)
                text += base[k // 2 : k] + bytes([rng.randrange(256)]) + base[k:]
                strings.append(len(text))
            buckets.append(len(text))
        sorts.clear()
        order = suffix_arrays(np.frombuffer(text, np.uint8), np.array(strings), np.array(buckets), depth)
        taken.add(len(sorts))
        ends = np.repeat(strings[1:], np.diff(strings))
        of = np.searchsorted(buckets, order, "right")
        assert sorted(order) == [i for i in range(len(text)) if i + depth <= ends[i]]
        got = [(b, text[i : i + depth]) for b, i in zip(of, order)]
        assert got == sorted(got)
    assert len(taken) == 1


def test_windows_of_a_document_become_runs_before_they_are_gathered(spark):
    """Windows of a text of one letter are fragments of their own; what a document gathers are runs."""
    full, rows = (1 << 35) - 1, [(7, i, 1) for i in range(1500)]
    rows += [(7, 1549, full), (7, 1700, full), (8, 0, 0b1001), (8, 35, 1 << 34), (9, 70, full), (9, 20, full)]
    got = substrings._joined(spark.createDataFrame(rows, "doc bigint, start bigint, bits bigint"))
    want = [(7, 0, 1633), (7, 1700, 1784), (8, 0, 53), (8, 69, 119), (9, 20, 154)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_registered_substrings_take_no_null_id_for_smaller(spark, tmp_path):
    """Nothing is smaller than an unknown doc_id, nor is it smaller than anything; also beside ids that repeat."""
    rows = [(None, PLAIN), (None, PLAIN), (None, None), (4, PLAIN + " and more"), (4, PLAIN), (9, PLAIN), (10, None)]
    for name, used in (("unlike", [r for r in rows if r != (4, PLAIN)]), ("alike", rows), ("unknown", rows[:3])):
        table(spark, [(*r, "en", "a") for r in used]).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = queries.QUERIES["op10_suffix_array_dedup"](spark, f"{tmp_path}/{name}").collect()
        want = []
        for d, t in used:
            raw, gone = (t or "").encode(), d == 9
            kept = hashlib.sha256(b"" if gone else raw).hexdigest()
            want.append((d, len(raw), len(raw) if gone else 0, int(gone), kept))
        assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
