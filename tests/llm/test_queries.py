"""Registered queries against their SQL, and every operator on awkward tables."""

import pytest

import corpus_pipeline
from courtline.llm import (
    decontamination, jaccard, language, mixing, pii, quality, queries, records, runs, sharding, substrings, token_counts,
)
from tests.compare import duck, same

from .conftest import SF01
from .helpers import awkward, clashing, empty, same_rows

import public_tokenizers  # isort: skip

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("key", list(queries.ORACLES))
def test_query_equals_sql(spark, key):
    equal, message = same(queries.QUERIES[key](spark, SF01), duck(SF01), queries.ORACLES[key])
    assert equal, message


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def _records(spark, docs):
    import uuid

    from courtline.llm.common import shared_dir

    folder = f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"
    records.write_records(docs, f"{folder}/r", WORDS)
    records.write_index(spark, f"{folder}/r", f"{folder}/i")
    return records.token_starts(spark.read.parquet(f"{folder}/i")).select("doc_id", "start", "n_tokens", "ids_crc32")


def _items(spark, n):
    return spark.createDataFrame([(1, awkward(spark).first().text), (2, None), (3, "one two three"), (4, " ")][:n], "item_id bigint, text string")


OPERATORS = {
    "contained_items": lambda s, d: decontamination.contained_items(d, _items(s, 4)),
    "decontaminate": lambda s, d: decontamination.decontaminate(d, _items(s, 4)).select("doc_id", "text"),
    "no_items": lambda s, d: decontamination.decontaminate(d, _items(s, 0)).select("doc_id", "text"),
    "quality_rules": lambda s, d: quality.quality_rules(d),
    "keep_good": lambda s, d: quality.keep_good(d).select("doc_id", "text"),
    "link_components": lambda s, d: jaccard.link_components(d),
    "one_of_each": lambda s, d: jaccard.one_of_each(d).select("doc_id", "text"),
    "identify": lambda s, d: language.identify(d, 5),
    "pii": lambda s, d: pii.report(d),
    "shard": lambda s, d: sharding.contract(sharding.shard(d)).drop("slot"),
    "counts": lambda s, d: token_counts.counts_after_edits(d, RANKS, public_tokenizers.PATTERN),
    "records": _records,
    "mix": lambda s, d: mixing.mix(d).select("doc_id", "size", "source_size", "target"),
    "repeat_to_mix": lambda s, d: mixing.repeat_to_mix(d).select("source"),
    "substrings": lambda s, d: substrings.deduplicate(d),
    "periodic_runs": lambda s, d: runs.periodic_runs(d),
    "planted_runs": lambda s, d: runs.digest(runs.periodic_runs(runs.with_planted_runs(d))),
}
FILTERS = {"contained_items", "decontaminate", "keep_good", "one_of_each", "repeat_to_mix", "no_items"}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_awkward_rows_and_clashing_columns(spark, name):
    run = OPERATORS[name]
    plain = same_rows(run(spark, awkward(spark)))
    if name not in FILTERS:
        assert len(plain) == 13
    assert same_rows(run(spark, clashing(awkward(spark)))) == plain


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, empty(spark)).count() == 0


def test_pipeline_takes_awkward_rows(spark, tmp_path):
    docs = clashing(awkward(spark))
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF01)
        out.write.parquet(str(tmp_path / name.replace(" ", "_")))
        if name != "sharding":
            assert out.columns == docs.columns
            docs = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
