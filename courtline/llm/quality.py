"""Quality rules with host verdicts (operator 2), DataFrame functions only.

Each document is measured by fixed rules; failures are added up per host (the ``source`` column), the
failure rates are shrunk with a beta prior fitted to all hosts, and a host whose shrunk rate for a
rule is above what the rule tolerates gets a verdict. A document goes when it fails a base rule, or when
it fails a rule for which its host has a verdict. Clean documents of a bad host stay, and so does the odd
document that fails a rule at a host where hardly any does.

Defined results: NULL or blank text has no words and fails the base rule; very long texts are measured whole; a
NULL host is a host of its own; equal rows get equal results and there are no ties to break; an empty table
gives an empty result; extra columns, of any name that the features do not use, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, lookup, small, stage, unused

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEATED_PERCENT = 50
#: Prior strength when the hosts do not differ, or are fewer than two.
WEAK_PRIOR = 2.0

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Host-level rules, each a condition on the features of one document.
HOST_RULES: dict[str, str] = {
    "short": f"n_words < {MIN_WORDS}",
    "repetitive": f"100 * n_repeat_words > {REPEATED_PERCENT} * n_words",
    "symbols": "n_symbols > n_words",
    "dup_lines": "n_dup_lines >= 3",
    "odd_words": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}

#: A host gets a verdict for a rule when the shrunk rate of failures is above this. More symbols than words,
#: which tables and code do not reach, and lines repeated over and over are tolerated now and then; short and
#: repetitive documents go by the base rules anyway and tell of a host only when they are the rule there.
HOST_RATES = {"short": 0.5, "repetitive": 0.5, "symbols": 0.02, "dup_lines": 0.1, "odd_words": 0.1}


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _blank(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts. Row-wise; the helper columns are separate projections on purpose."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: _blank(x) != "")
    trimmed = docs.withColumns(
        {
            "_trimmed": _blank(t),
            "_spaces": F.octet_length(t) - F.octet_length(_without(t, SPACES)),
            "n_symbols": (F.octet_length(t) - F.octet_length(_without(t, SYMBOLS))).cast("long"),
            "_lines": lines,
        }
    )
    words = F.when(F.col("_trimmed") != "", F.split("_trimmed", f"[{SPACES}]+"))
    counted = trimmed.select(
        *docs.columns,
        "n_symbols",
        (F.char_length(t) - F.col("_spaces")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(words, F.array().cast("array<string>")).alias("_w"),
    )
    counted = counted.withColumn("n_words", F.size("_w").cast("long"))
    enough = F.col("n_words") >= 3
    last = F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))
    windows = F.arrays_zip(
        F.slice("_w", 1, last).alias("a"), F.slice("_w", 2, last).alias("b"), F.slice("_w", 3, last).alias("c")
    )
    coded = counted.withColumn(
        "_h", F.when(enough, F.transform(windows, lambda x: F.xxhash64(x["a"], x["b"], x["c"])))
    ).drop("_w")
    repeated = coded.withColumn("_twice", F.size("_h") > F.size(F.array_distinct("_h")))
    placed = repeated.withColumn(
        "_s",
        F.when(
            F.col("_twice"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ),
    ).drop("_h")
    beside = placed.withColumn(
        "_n",
        F.arrays_zip(
            F.col("_s").alias("s"),
            F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice("_s", 1, F.size("_s") - 1)).alias("p"),
            F.slice("_s", 2, F.size("_s")).alias("n"),
        ),
    ).drop("_s")
    found = beside.withColumn(
        "_at",
        F.sort_array(
            F.transform(
                F.filter(
                    "_n",
                    lambda x: F.coalesce(x["s"]["h"] == x["p"]["h"], F.lit(False))
                    | F.coalesce(x["s"]["h"] == x["n"]["h"], F.lit(False)),
                ),
                lambda x: x["s"]["i"],
            )
        ),
    ).drop("_n")
    steps = F.arrays_zip(F.col("_at").alias("a"), F.slice("_at", 2, F.size("_at")).alias("b"))
    covered = F.aggregate(
        steps, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(F.least(x["b"] - x["a"], F.lit(3)), F.lit(3))
    )
    return found.select(
        *docs.columns,
        *FEATURES[:-1],
        F.coalesce(F.when(F.size("_at") > 0, covered), F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )


def host_verdicts(features: DataFrame, host: str = "source", rates: dict[str, float] = HOST_RATES) -> DataFrame:
    """(host, n_docs, rate_<rule>, bad_<rule>): shrunk failure rates of every host.

    The beta prior of a rule has the mean m and, by the method of moments, the strength
    m(1-m)/v - 1 of the unweighted rates of all hosts; with v = 0 or one host it has WEAK_PRIOR. Rows
    are added up before the shuffle, so a host with a third of all rows costs no more than another.
    """
    fails = {r: F.sum(F.expr(c).cast("long")).alias(f"f_{r}") for r, c in HOST_RULES.items()}
    hosts = small(features.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), *fails.values()))
    moments = []
    for r in HOST_RULES:
        x = F.col(f"f_{r}") / F.col("n_docs")
        moments += [F.avg(x).alias(f"m_{r}"), F.var_pop(x).alias(f"v_{r}")]
    prior = hosts.agg(F.struct(*moments).alias("p")).scalar()
    out = hosts.withColumn("_p", prior)
    for r in HOST_RULES:
        m, v = F.col(f"_p.m_{r}"), F.col(f"_p.v_{r}")
        strength = F.greatest(F.when(v > 0, m * (1 - m) / v - 1), F.lit(0.0))
        strength = F.coalesce(strength, F.lit(WEAK_PRIOR))
        shrunk = (F.col(f"f_{r}") + m * strength) / (F.col("n_docs") + strength)
        out = out.withColumn(f"rate_{r}", shrunk).withColumn(f"bad_{r}", shrunk > rates[r])
    return out.select(host, "n_docs", *(f"{k}_{r}" for r in HOST_RULES for k in ("rate", "bad")))


def judge(features: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Add base_failed, host_failed and kept, the verdicts being a staged table of the hosts."""
    bad = {r: unused(features, f"_bad_{r}") for r in HOST_RULES}
    named = verdicts.select(host, *(F.col(f"bad_{r}").alias(b) for r, b in bad.items()))
    joined = lookup(features, named, [host])
    failed = F.lit(False)
    for r, c in HOST_RULES.items():
        failed |= F.expr(c) & F.coalesce(F.col(bad[r]), F.lit(False))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("host_failed", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    return judged.drop(*bad.values())


def quality_rules(docs: DataFrame, host: str = "source", rates: dict[str, float] = HOST_RATES) -> DataFrame:
    """doc_id, host, the features and the verdicts of every document."""
    measured = text_features(docs.select("doc_id", host, "text")).drop("text")
    features = stage(measured, "features")
    return judge(features, small(host_verdicts(features, host, rates)), host)


def keep_good(docs: DataFrame, host: str = "source", rates: dict[str, float] = HOST_RATES) -> DataFrame:
    """The documents that pass, with their own columns, of whatever names.

    Texts are measured twice, once for the hosts and once for themselves, so that none is written or
    shuffled (hosts beyond the bound of a broadcast apart).
    """
    verdicts = small(host_verdicts(text_features(docs.select(host, "text")), host, rates))
    held = docs.select(
        "text", host, F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("_doc")
    )
    # A predicate is not moved below a column of this kind: it would take the counts with it, once for
    # every time that it names them.
    measured = text_features(held).drop("text").withColumn("_fixed", F.monotonically_increasing_id())
    kept = judge(measured, verdicts, host).filter("kept and _fixed >= 0")
    return kept.select(*(F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(docs.columns)))
