"""Small document tables with the awkward rows that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PLAIN = (
    "the quick brown fox jumps over the lazy dog while seven green frogs watch from the old wooden bridge"
    " and a small boat drifts slowly down the river past the mill where nobody has lived for many long years"
)


def table(spark, rows):
    """(doc_id, text, lang, source) rows; n_chars follows from the text."""
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, equal ids, other scripts."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    rows = [
        (1, PLAIN, "en", "a"),
        (2, PLAIN, "en", "a"),
        (2, PLAIN, "en", "a"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (5, " \n\t ", "en", None),
        (6, long, "de", "b"),
        (7, "Ünïcödé 日本語 text, with\x0bodd\x0cspaces\r\nand ⁠marks 🙂 " * 12, "fr", "c"),
        (8, "one two three", None, "c"),
        (None, PLAIN + " but this row has no id", "en", "b"),
        (9, PLAIN.replace("seven", "eight"), "en", "b"),
        (10, "x" * 5000, "es", "z"),
        (10, "another text under the same id " * 3, "es", "z"),
    ]
    return table(spark, rows)


def empty(spark):
    return table(spark, [])


def clashing(docs):
    """The same rows with extra columns whose names operators use inside."""
    names = ("_row", "_hash", "_copies", "_doc", "n", "s", "t", "key", "kind", "size", "rate", "kept", "words", "shard_", "_salt")
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))


def same_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
