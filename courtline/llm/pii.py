"""Personal data and terms that disclose it (operator 5), DataFrame functions only.

Addresses, card and phone numbers are found by fixed patterns (the base). The corpus then tells which other
terms reveal them: for an entity e, a value that the base finds in the texts, and a term t of these texts,
wherever it stands, the pointwise mutual information log p(t, e) / (p(t) p(e)) over documents measures how
much t discloses of e, at most the information content -log p(e), which it reaches when t never occurs
without e. The estimate is smoothed by (k / (k + 1))^2 for a pair met in k texts, so few texts prove little. A
term that discloses DISCLOSED of the content is a span of its own, to be generalised, at each of its places in
the texts that hold the entity; with ``everywhere``, as operator 5 runs it, in all texts, as it reveals the
entity above all where the value itself is not given.

An entity is also the class of a value, so that values met in one text only have what the corpus knows of
their class: the domain of an e-mail address, the first three numbers of an IP address, the first six digits
of a card, a phone number but for its last four digits. The kind alone is no entity; it identifies nobody.

Probabilities are document frequencies over different texts; copies of a text count once in all of them
and in the total, so they neither give support nor take it away.

Defined results: NULL and empty texts have no spans; repeated rows each get theirs, and ``sanitise`` goes by
rows, whatever their doc_ids; very long texts are read whole; of base spans that start together the kind listed
first comes first; positions are code points, ends exclusive; an empty table gives an empty result; other
columns, of any name, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, having, small, stage, unused

KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)

# Fixed patterns. A match can only begin at the start of a run of its first characters, or where the
# last match ended; saying so keeps long runs linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9][0-9\x20-]*[0-9]"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Two separators in a row end a card number: they are masked, one character for one.
DOUBLE = r"(?<=[\x20-])[\x20-]|[\x20-](?=[\x20-])"

#: Share of an entity's information content from which a term counts as disclosing it.
DISCLOSED = 0.5
#: Rows of one text from which its terms are broadcast instead of joined by the text.
HOT_TEXT = 10_000
#: Terms are words of letters, with hyphens and apostrophes inside; numbers and addresses are the base's business.
WORD = r"^(?=..)[\p{L}\p{M}]+(?:[-'\u2019][\p{L}\p{M}]+)*$"
_MARKS = ".,;:!?()[]{}\"'|#*$%&<>-"
# Values of the span kinds in sanitised text.
GENERAL = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]")


def _pieces(text: Column, kind: int, pattern: str) -> Column:
    """Matches of a pattern and the length of what stands before each, in order."""
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    lengths = F.transform(F.slice(parts, 1, F.size(found)), lambda x: F.char_length(x))
    return F.transform(
        F.arrays_zip(found.alias("value"), lengths.alias("gap")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["value"].alias("value"), x["gap"].alias("gap")),
    )


def _luhn(digits: Column) -> Column:
    backwards = F.split(F.reverse(digits), "")

    def add(total: Column, x: Column) -> Column:
        d = x["d"].cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(x["i"] % 2 == 1, doubled).otherwise(d)

    indexed = F.transform(backwards, lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(F.filter(indexed, lambda x: x["d"] != ""), F.lit(0), add) % 10 == 0


def _valid() -> Column:
    value, kind = F.col("value"), F.col("kind")
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    byte = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (
        F.when(kind == 1, value.rlike(rf"^{byte}(\.{byte}){{3}}$"))
        .when(kind == 2, n.between(14, 19) & F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(10, 15))
        .otherwise(True)
    )


def smoothing(k: Column) -> Column:
    """What of an estimate from k texts counts."""
    return F.pow(k / (k + 1), F.lit(2))


def support(share: float) -> int:
    """The least k that is not ruled out whatever the estimate: below, smoothing alone takes too much."""
    k = 1
    while (k / (k + 1)) ** 2 < share:
        k += 1
    return k


def base_spans(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Staged (_row, doc_id, text_hash, kind, start, end, value): a row per base span, and one
    with kind NULL for every document without any. Rows are numbered here, or by the column ``row``."""
    t = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<kind:int,i:int,value:string,gap:int>>")
    masked = F.regexp_replace(t, DOUBLE, "x")
    found = F.concat(
        F.when(t.contains("@"), _pieces(t, 0, EMAIL)).otherwise(none),
        F.when(t.rlike(r"[0-9]\.[0-9]"), _pieces(t, 1, IP)).otherwise(none),
        F.when(t.rlike(r"[0-9][\x20-]?[0-9]"), _pieces(masked, 2, CARD)).otherwise(none),
        F.when(t.contains("+"), _pieces(t, 3, PHONE)).otherwise(none),
    )
    rows = docs.select(
        (F.monotonically_increasing_id() if row is None else F.col(row)).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(t).alias("text_hash"),
        found.alias("found"),
    )
    # Numbered first: a row number drawn beside the explode would number its output.
    rows = rows.select("_row", "doc_id", "text_hash", F.explode_outer("found").alias("m"))
    rows = rows.select("_row", "doc_id", "text_hash", "m.*")
    held = stage(rows, "matches")
    # Where a match starts: the gaps and matches of its kind before it. One window per document and kind.
    upto = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("value")
    end = F.sum(F.col("gap") + length).over(upto)
    placed = held.filter("kind is not null").withColumn("end", end).withColumn("start", F.col("end") - length)
    valid = placed.filter(_valid()).select("_row", "doc_id", "text_hash", "kind", "start", "end", "value")
    rest = held.filter("kind is null or i = 0").select("_row", "doc_id", "text_hash").distinct()
    bare = rest.join(valid.select(F.col("_row").alias("_of")).distinct(), F.col("_row") == F.col("_of"), "anti")
    empty = bare.select(
        "*", *(F.lit(None).cast(valid.schema[c].dataType).alias(c) for c in valid.columns[3:])
    )
    return stage(valid.unionByName(empty), "spans")


def _term(word: Column) -> Column:
    return F.btrim(F.lower(word), F.lit(_MARKS))


def _words(docs: DataFrame) -> DataFrame:
    """(text_hash, flat, words): the words of every row between single spaces, empty ones included."""
    # One kind of space, so that the start of a word is where the words before it end.
    flat = F.translate(F.coalesce(F.col("text"), F.lit("")), SPACES, " " * len(SPACES))
    rows = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), flat.alias("flat"))
    return rows.withColumn("words", F.split("flat", " ", -1))


def _terms(docs: DataFrame) -> DataFrame:
    """(text_hash, t): codes of the different terms of every row."""
    terms = F.filter(F.array_distinct(F.transform("words", _term)), lambda w: w.rlike(WORD))
    return _words(docs).select("text_hash", F.explode(F.transform(terms, lambda w: F.xxhash64(w))).alias("t"))


def _places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(text_hash, t, start, end): every occurrence of the staged terms, copies of a text once."""
    words = _words(docs).select("text_hash", "flat", F.posexplode("words").alias("i", "w")).filter("w <> ''")
    met = having(words.withColumn("t", F.xxhash64(_term(F.col("w")))), "t", terms)
    # Only now, for the few that are met: the words before and the spaces behind them.
    before = F.when(F.col("i") > 0, F.char_length(F.expr("substring_index(flat, ' ', i)")) + 1).otherwise(0)
    lead = F.char_length("w") - F.char_length(F.ltrim(F.col("w"), F.lit(_MARKS)))
    start = (before + lead).cast("long")
    length = F.char_length(F.btrim(F.col("w"), F.lit(_MARKS)))
    return met.select("text_hash", "t", start.alias("start"), (start + length).alias("end")).distinct()


def _entities() -> Column:
    """Codes of a base value and of the class it belongs to."""
    value, kind = F.col("value"), F.col("kind")
    digits = F.regexp_replace(value, "[^0-9]", "")
    of = (
        F.when(kind == 0, F.lower(F.substring_index(value, "@", -1)))
        .when(kind == 1, F.substring_index(value, ".", 3))
        .when(kind == 2, F.substring(digits, 1, 6))
        .otherwise(F.regexp_replace(digits, "[0-9]{4}$", ""))
    )
    return F.array(F.xxhash64("kind", F.lower(F.regexp_replace(value, r"[\x20().-]", ""))), F.xxhash64(F.lit("class"), kind, of))


def _document_frequencies(docs: DataFrame, terms: DataFrame, repeated: DataFrame) -> DataFrame:
    """(t, df_t): different texts with each of the staged terms. Texts that occur once, most of them, are
    counted in each task before the shuffle; only those of the staged ``repeated`` are told apart by text."""
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    once = having(_terms(having(hashed, "_text_hash", repeated, how="anti")), "t", terms)
    several = having(_terms(having(hashed, "_text_hash", repeated)), "t", terms).distinct()
    parts = [x.groupBy("t").agg(F.count(F.lit(1)).alias("n")) for x in (once, several)]
    return parts[0].unionByName(parts[1]).groupBy("t").agg(F.sum("n").alias("df_t"))


def disclosing_terms(docs: DataFrame, spans: DataFrame, everywhere: bool = False) -> DataFrame:
    """Staged (text_hash, start, end) of the terms that disclose an entity of the same text, or with
    ``everywhere`` of any text."""
    least = support(DISCLOSED)
    known = spans.filter("kind is not null").select("text_hash", F.explode(_entities()).alias("entity"))
    holding = known.groupBy("entity").agg(F.countDistinct("text_hash").alias("df_e"))
    frequent = small(holding.filter(F.col("df_e") >= least))
    holders = stage(having(known, "entity", frequent.select("entity")).distinct(), "holders")
    # Terms of the texts that hold an entity, wherever they stand in them.
    held = docs.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    held = having(held, "_text_hash", holders.select("text_hash").distinct())
    beside = stage(_terms(held).distinct(), "beside")
    met = small(beside.groupBy("t").agg(F.count(F.lit(1)).alias("most")).filter(F.col("most") >= least))
    nothing = spans.select("text_hash", "start", "end").limit(0)
    if met.isEmpty():
        return nothing
    texts = stage(spans.groupBy("text_hash").agg(F.min("_row").alias("_a"), F.max("_row").alias("_b")), "texts")
    n = F.lit(float(max(texts.count(), 1)))
    repeated = stage(texts.filter("_a < _b").select("text_hash"), "repeated")
    counts = _document_frequencies(docs, met.select("t"), repeated)
    # Whatever a pair's texts, at most "most", a term in more texts than this is below the bound for all.
    reach = F.col("most") * F.pow(n / least, F.lit(1 - DISCLOSED)) * 1.000001
    counts = small(counts.join(met, "t").filter(F.col("df_t") <= reach).select("t", "df_t"))
    pairs = having(beside, "t", counts.select("t")).join(holders, "text_hash")
    pairs = pairs.groupBy("entity", "t").agg(F.count(F.lit(1)).alias("df_te")).filter(F.col("df_te") >= least)
    scored = pairs.join(frequent, "entity").join(counts, "t")
    information = F.log(F.col("df_te") * n / (F.col("df_t") * F.col("df_e"))) * smoothing(F.col("df_te"))
    content = -F.log(F.col("df_e") / n)
    chosen = small(scored.filter((information >= DISCLOSED * content) & (content > 0)).select("entity", "t"))
    if chosen.isEmpty():
        return nothing
    terms = small(chosen.select("t").distinct())
    if everywhere:
        return stage(_places(docs, terms).select("text_hash", "start", "end"), "terms")
    places = _places(held, terms)
    own = holders.join(chosen, "entity").select("text_hash", "t").distinct()
    return stage(places.join(own, ["text_hash", "t"]).select("text_hash", "start", "end").distinct(), "terms")


def all_spans(docs: DataFrame, everywhere: bool = False, row: str | None = None) -> DataFrame:
    """(_row, doc_id, spans) with spans = sorted array of (start, kind, end); kind TERM for the method's."""
    base = base_spans(docs, row)
    one = F.struct(F.col("start").cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end"))
    # Rows without spans have kind NULL and an empty list.
    rows = base.groupBy("_row").agg(
        F.any_value("doc_id").alias("doc_id"), F.any_value("text_hash").alias("text_hash"),
        F.collect_list(F.when(F.col("kind").isNotNull(), one)).alias("spans"),
    )
    term = F.struct("start", F.lit(TERM).alias("kind"), "end")
    terms = disclosing_terms(docs, base, everywhere).groupBy("text_hash").agg(F.collect_list(term).alias("terms"))
    terms = stage(terms.withColumnRenamed("text_hash", "_of"), "by_text")
    joined = _with_terms(rows, terms, base)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    spans = F.sort_array(F.concat("spans", F.coalesce("terms", empty)))
    return joined.select("_row", "doc_id", spans.alias("spans"))


def _with_terms(rows: DataFrame, terms: DataFrame, base: DataFrame) -> DataFrame:
    """Left join of rows and the terms of their texts. Texts of very many rows, of which there are few, come
    by a broadcast, so that no text gathers its rows in one task."""
    sizes = base.select("text_hash", "_row").groupBy("text_hash").agg(F.count(F.lit(1)).alias("_n"))
    hot = small(sizes.filter(F.col("_n") > HOT_TEXT).select("text_hash"))
    if hot.isEmpty():
        return rows.join(terms, rows["text_hash"] == terms["_of"], "left")
    large, usual = having(rows, "text_hash", hot), having(rows, "text_hash", hot, how="anti")
    few = F.broadcast(having(terms, "_of", hot))
    by_text = usual.join(terms, usual["text_hash"] == terms["_of"], "left")
    return by_text.unionByName(large.join(few, large["text_hash"] == few["_of"], "left"))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans of every document."""
    found = all_spans(docs, everywhere)
    base = F.filter("spans", lambda s: s["kind"] < TERM)

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        number(TERM).alias("n_terms"),
    )


def sanitise(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """The documents with spans replaced by general names. Of overlapping spans the first one counts.

    Rows are numbered and staged, so every row gets its own spans, whatever its doc_id. Text is cut at the
    spans, so the cost is text times spans of a document.
    """
    row = unused(docs, "_row_of")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    spans = all_spans(held, everywhere, row).filter(F.size("spans") > 0)
    spans = spans.select(F.col("_row").alias("_id"), F.col("spans").alias("_spans"))
    joined = held.join(spans, held[row] == spans["_id"], "left")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    names = F.array(*map(F.lit, GENERAL))

    def cut(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.element_at(names, s["kind"] + 1)).alias("out")),
        ).otherwise(acc)

    done = F.aggregate(
        "_spans", start, cut, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), 2**31 - 1))
    )
    return joined.withColumn("text", F.when(F.col("_id").isNull(), F.col("text")).otherwise(done)).select(*docs.columns)
