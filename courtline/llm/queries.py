"""Registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bitplanes, decontamination, jaccard, language, mixing, pii, quality, records, runs, sharding, substrings, token_counts, topk,
)
from .common import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


_SPACE = r"\x20\x09-\x0D"

# Word list, rule counts and host verdicts, independent of the operator's expressions.
_QUALITY_CTES = rf"""
    docs as (select doc_id, source, coalesce(text, '') as t from {{docs}}),
    split as (select *, regexp_extract_all(t, '[^{_SPACE}]+') as w from docs),
    placed as (
      select doc_id, unnest(range(1, len(w) - 1)) as i, w from split where len(w) >= 3
    ),
    windows as (
      select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from placed
    ),
    covered as (
      select doc_id, count(distinct p) as n from (
        select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1
      ) group by doc_id
    ),
    lined as (
      select doc_id, count(*) - count(distinct line) as n from (
        select doc_id, unnest(string_split(t, chr(10))) as line from docs
      ) where regexp_matches(line, '[^{_SPACE}]') group by doc_id
    ),
    measured as (
      select s.doc_id, s.source, len(w)::bigint as n_words,
        length(regexp_replace(t, '[{_SPACE}]+', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
      from split s left join covered c using (doc_id) left join lined l using (doc_id)
    ),
    failing as (
      select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        [n_words < 50, 100 * n_repeat_words > 50 * n_words, n_symbols > n_words,
         n_dup_lines >= 3, word_chars < 2 * n_words or word_chars > 15 * n_words] as fails
      from measured
    ),
    per_rule as (select source, unnest(range(1, 6)) as r, fails from failing),
    hosts as (
      select source, r, count(*) as n, count(*) filter (fails[r]) as f from per_rule group by all
    ),
    prior as (select r, avg(f / n) as m, var_pop(f / n) as v from hosts group by r),
    bad as (
      select source, r from (
        select h.*, m, coalesce(greatest(case when v > 0 then m * (1 - m) / v - 1 end, 0), 2.0) as k
        from hosts h join prior using (r)
      ) where (f + m * k) / (n + k) > [0.5, 0.5, 0.02, 0.1, 0.1][r]
    ),
    judged as (
      select *, exists (
        select 1 from bad b where b.source is not distinct from failing.source and fails[b.r]
      ) as host_failed from failing
    )"""


@query(
    "op2_host_quality_rules",
    "with "
    + _QUALITY_CTES.replace("{docs}", "documents")
    + """ select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    host_failed, not base_failed and not host_failed as kept from judged""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(documents(spark, sf_dir))
    return judged.select("doc_id", *quality.FEATURES, "base_failed", "host_failed", "kept")


@query("op6_hilbert_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.contract(sharding.shard(documents(spark, sf_dir)))


@query("op9_entropy_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken"
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingle_sql(name: str, key: str, table: str, text: str = "text") -> str:
    """Two expressions: <name>_words (key, w) and <name> (key, s): distinct shingles of five words."""
    return rf"""
    {name}_words as (
      select {key}, regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^{_SPACE}]+') as w
      from {table}
    ),
    {name} as (
      select distinct {key}, array_to_string(w[i : i + 4], ' ') as s from (
        select *, unnest(range(1, greatest(len(w) - 3, 2))) as i from {name}_words where len(w) > 0
      )
    )"""


@query(
    "op1_benchmark_decontamination",
    "with "
    + _shingle_sql("item", "item_id", "benchmark")
    + ","
    + _shingle_sql("doc", "doc_id", "documents")
    + """, sizes as (select item_id, count(*) as n from item group by 1)
    select doc_id, item_id, n as n_shingles, count(*) as shared
    from item join doc using (s) join sizes using (item_id)
    group by doc_id, item_id, n having 10 * count(*) >= 8 * n""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contained_items(documents(spark, sf_dir), items)


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(documents(spark, sf_dir))


@query("op8_token_records")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch(spark)}/{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    records.write_records(documents(spark, sf_dir), f"{folder}/records", tokenizer)
    records.write_index(spark, f"{folder}/records", f"{folder}/index")
    index = records.token_starts(spark.read.parquet(f"{folder}/index"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op7_edit_aware_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.counts_after_edits(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@query("op4_byte_bigru_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op5_disclosure_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir), everywhere=True)


@query("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(documents(spark, sf_dir), nulls_smallest=False).drop("kept")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _integers_sql(scale: int, more: str = "true") -> str:
    """(r, vec_id, v): numbered rows with whole vectors, as integers."""
    return f"""
    whole as (
      select row_number() over () as r, vec_id,
        list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
      from embeddings
      where embedding is not null and {more}
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    )"""


@query(
    "op11_norm_bucketed_topk",
    f"with {_integers_sql(64)},"
    + """ scored as (
      select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
      from whole q join whole c on q.r <> c.r where q.vec_id % 20 = 0
    ),
    ranked as (
      select *, row_number() over (partition by r order by score desc, vec_id nulls last) as n from scored
    )
    select query_id, n::int as rank, vec_id, score from ranked where n <= 20""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(embeddings(spark, sf_dir))


# The CRC-32 of the decimal doc_id, bit by bit; stretches in which word i equals word i + q, for every q that
# a pair of equal words proposes; the smallest q of a stretch; the words that no run drops.
_RUNS_SQL = rf"""
    docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
    split as (
      select r, doc_id, regexp_extract_all(t, '[^{_SPACE}]+') as w,
        xor(list_reduce(
          list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1))::bigint),
          lambda c, b: list_reduce(
            range(0, 8)::bigint[], lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end,
            xor(c, b)
          ),
          4294967295::bigint
        ), 4294967295::bigint) as h
      from docs
    ),
    known as (
      select *, len(w) as n, h // 10 as g, case when len(w) > 0 then (h // 10) % len(w) end as a from split
    ),
    words as (
      select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(
          range(0, n),
          lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]
        ) else w end as w
      from known
    ),
    placed as (select r, n, unnest(range(0, n)) as i, unnest(w) as word from words where n >= 6),
    equal as (
      select x.r, x.i, y.i - x.i as q from placed x join placed y
        on x.r = y.r and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n
    ),
    stretches as (
      select r, q, min(i) as s, count(*) + q as l from (
        select *, i - row_number() over (partition by r, q order by i) as island from equal
      ) group by r, q, island having count(*) + q >= greatest(6, 4 * q)
    ),
    found as (select r, s, l, min(q) as q from stretches group by r, s, l),
    gone as (select distinct r, unnest(range(s + q, s + l)) as i from found),
    kept as (
      select r, string_agg(word, ' ' order by i) as t from (
        select r, unnest(range(0, n)) as i, unnest(w) as word from words where n > 0
      ) anti join gone using (r, i) group by r
    ),
    listed as (
      select r, count(*) as n_runs, arg_min((s, l, q), (-l, s, q)) as best,
        string_agg(concat(s, ',', l, ',', q, chr(10)), '' order by s, q) as lines
      from found group by r
    )"""


@query(
    "op12_basic_factor_runs",
    f"with {_RUNS_SQL}"
    + """ select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best[1]::bigint as start,
      best[2]::bigint as length, best[3]::bigint as period, (1000 * best[2] // best[3])::bigint as exponent_milli,
      sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept.t, '')) as collapsed_sha256
    from words left join listed using (r) left join kept using (r)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(runs.with_planted_runs(documents(spark, sf_dir))))


def _clusters_sql(rounds: int = 5) -> str:
    """The rounds one after another; every step sees all vectors."""
    steps = [
        _integers_sql(256, "len(embedding) = 64"),
        """c0 as (
          select row_number() over (order by sha256('2:' || vec_id) nulls last, v) - 1 as c, v from whole
          qualify c < 40
        )""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as (
          select k.r, k.vec_id, k.v, min(struct_pack(
            d := list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint, c := c.c
          )) as m from whole k, c{i} c group by k.r, k.vec_id, k.v
        )""")
        if i < rounds:
            steps.append(f"""c{i + 1} as (
              select c.c, coalesce(m.v, c.v) as v from c{i} c left join (
                select c, list(((s - ((s % n) + n) % n) / n)::bigint order by j) as v from (
                  select m.c as c, j, sum(x)::bigint as s, count(*) as n from (
                    select m, unnest(v) as x, unnest(range(0, 64)) as j from a{i}
                  ) group by m.c, j
                ) group by c
              ) m on m.c = c.c
            )""")
    return ",".join(steps)


@query(
    "op13_bit_plane_clusters",
    f"with {_clusters_sql()}"
    + """ select vec_id, m.c::int as cluster, m.d as distance, (sum(m.d) over (partition by m.c))::bigint as cluster_inertia,
      (sum(m.d) over ())::bigint as inertia, sha256(array_to_string(c5.v, ',')) as centroid_sha256
    from a5 join c5 on c5.c = m.c""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(embeddings(spark, sf_dir))
