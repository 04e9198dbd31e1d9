"""Mixing sources to target weights by entropy balancing (operator 9), DataFrame functions only.

Document rates r minimise the sum of r log r - r + 1 over 0 <= r <= 3 subject to one token constraint
per source: the sum of r * size equals the source's target. The dual is one convex problem in one
multiplier per source, r = min(3, exp(multiplier * size / mean size)), solved for all sources at once
by Newton steps; each step is one aggregation over (source, size, number of documents). Rates are then
rounded to whole copies, 0 to 3, so that the words taken from a source meet its target.

Defined results: NULL or blank text has size 0 and changes no total; NULL is a source of its own, last
in order; repeated rows are told apart by a row number of the staged table, which also settles every other
tie, so that reruns on the same files agree; very long texts count by all their words; an empty table gives an
empty result; all weights fall to the sources that have words; other columns, of any name, are not read, and
``repeat_to_mix`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, global_positions, lookup, small, stage, unused

#: Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
#: No source and no document is taken more often than this.
MOST = 3
#: Newton stops when every source is this near its target, and at the latest after so many steps.
TOLERANCE = 1e-9
STEPS = 40
#: Rounds of single-copy changes after rounding, one change per source and round.
REPAIRS = 4
#: Documents whose copies are sent to all tasks (three numbers each); more are joined by a shuffle.
COPIES_SENT = 500_000
#: Rates are added up in units of 2^-20.
UNIT_BITS = 20


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed != "", F.size(F.split(trimmed, f"[{SPACES}]+"))).otherwise(0).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs, target), one row per source.

    With the sources in the order of most * size / weight, the level of the water is the largest of
    (words - caps before) / (weights - weights before): assuming other sources full gives less.
    """
    sources = small(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    )
    ranked = global_positions(sources, [F.col("source").asc_nulls_last()], {"pos": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    filled = small(
        global_positions(
            weighed,
            [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()],
            {"caps": F.col("cap"), "weights": F.col("weight")},
        )
    )
    totals = filled.agg(
        F.struct(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).alias("t")
    ).scalar()
    levels = filled.withColumn("_t", totals).agg(
        F.max((F.col("_t.words") - F.col("caps")) / (F.col("_t.weights") - F.col("weights")))
    )
    target = F.least(F.col("cap").cast("double"), F.col("weight") * levels.scalar())
    return small(filled.withColumn("target", target).select("source", "source_size", "n_docs", "target"))


def rate(most: int = MOST) -> Column:
    """Rate of a document from its size and its source's multiplier; NULL multiplier: ``most``."""
    power = F.col("multiplier") * F.col("size") / F.col("mean_size")
    return F.least(F.lit(float(most)), F.exp(F.least(F.coalesce(power, F.lit(99.0)), F.lit(99.0))))


def _exact_sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def multipliers(sized: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target, mean_size, multiplier) by Newton on log(words taken).

    A step that leaves the bracket known so far is replaced by its middle, or by a doubling while
    one side is open. Sources that are full, or have no words, need no step.
    """
    sizes = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    full = (F.col("target") >= most * F.col("source_size")) | (F.col("source_size") == 0)
    state = targets.withColumns(
        {
            "mean_size": F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1.0)),
            "multiplier": F.when(~full, F.lit(0.0)),
            "low": F.lit(None).cast("double"),
            "high": F.lit(None).cast("double"),
            "off": F.when(~full, F.lit(1.0)).otherwise(0.0),
        }
    )
    state = small(state)
    for _ in range(STEPS):
        if state.filter(F.col("off") > TOLERANCE).isEmpty():
            break
        at = lookup(sizes, state.filter("multiplier is not null").select("source", "mean_size", "multiplier"), ["source"])
        words = F.col("n") * F.col("size") * rate(most)
        moving = F.when(rate(most) < most, words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        # Decimal sums do not depend on the order of rows, so reruns take the same steps.
        taken = small(at.groupBy("source").agg(_exact_sum(words).alias("_taken"), _exact_sum(moving).alias("_slope")))
        now = lookup(state, taken, ["source"])
        m, too_few = F.col("multiplier"), F.col("_taken") < F.col("target")
        now = now.withColumns(
            {
                "low": F.when(too_few, m).otherwise(F.col("low")),
                "high": F.when(too_few, F.col("high")).otherwise(m),
                "off": F.when(m.isNull(), F.lit(0.0)).otherwise(
                    F.abs(F.col("_taken") - F.col("target")) / F.col("target")
                ),
            }
        )
        step = m + F.log(F.col("target") / F.col("_taken")) * F.col("_taken") / F.col("_slope")
        inside = (step > F.coalesce("low", F.lit(-1e300))) & (step < F.coalesce("high", F.lit(1e300)))
        other = (
            F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
            .when(F.col("low").isNotNull(), F.greatest(m * 2, F.lit(1.0)))
            .otherwise(F.least(m * 2, F.lit(-1.0)))
        )
        moved = F.when(F.col("off") <= TOLERANCE, m).when(inside, step).otherwise(other)
        state = small(now.withColumn("multiplier", moved).drop("_taken", "_slope"))
    return state.select("source", "source_size", "target", "mean_size", "multiplier")


def mixed(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add source_size, target, rate and copies to a staged (source, size, order columns ...) table.

    Rounding is systematic: documents of a source in falling size, copies as the whole units that the
    running total of rates passes, so rounding errors of neighbours, which are alike in size, cancel.
    A few rounds then change one copy per source, that which brings the source nearest to its target.
    """
    solved = multipliers(sized, source_targets(sized, weights, most), most)
    rated = lookup(sized, solved, ["source"]).withColumn("rate", rate(most))
    unit = 1 << UNIT_BITS
    rated = rated.withColumn("_units", F.round(F.col("rate") * unit).cast("long"))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id"), F.col("_row")]
    summed = global_positions(rated, order, {"_before": F.col("_units")}, within=["source"])

    def whole(c: Column) -> Column:
        return F.shiftright(c + unit // 2, UNIT_BITS)

    copies = whole(F.col("_before") + F.col("_units")) - whole(F.col("_before"))
    rounded = stage(
        summed.withColumn("copies", copies.cast("int")).drop("_units", "_before", "mean_size", "multiplier"), "copies"
    )
    return _repaired(rounded, most)


def _repaired(rounded: DataFrame, most: int) -> DataFrame:
    """Apply the changes found on (source, size, copies) classes to the first document of the class.

    A class changes in one round only, so the chosen documents differ.
    """
    classes = stage(
        rounded.filter("size > 0").groupBy("source", "size", "copies", "target")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "_row")).alias("first")),
        "classes",
    )
    off = classes.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size") * F.col("copies")).alias("taken")
    )
    changes, state = None, small(off)
    for _ in range(REPAIRS):
        at = lookup(classes, state, ["source"])
        if changes is not None:
            used = changes.select("source", "size", "copies", F.lit(True).alias("_used"))
            at = lookup(at, used, ["source", "size", "copies"]).filter("_used is null").drop("_used")
        way = F.when(F.col("taken") < F.col("target"), F.lit(1)).otherwise(F.lit(-1))
        after = F.abs(F.col("taken") + way * F.col("size") - F.col("target"))
        possible = at.withColumns({"way": way, "_after": after}).filter(
            (F.col("_after") < F.abs(F.col("taken") - F.col("target")))
            & (F.col("copies") + F.col("way")).between(0, most)
        )
        best = possible.groupBy("source").agg(
            F.min_by(
                F.struct("size", "copies", "way", "first"), F.struct("_after", "size", "copies")
            ).alias("b")
        )
        found = small(best.select("source", "b.size", "b.copies", "b.way", "b.first._row"))
        moved = found.select("source", (F.col("size") * F.col("way")).alias("_more"))
        changes = found if changes is None else small(changes.unionByName(found))
        state = small(
            lookup(state, moved, ["source"])
            .withColumn("taken", F.col("taken") + F.coalesce("_more", F.lit(0)))
            .drop("_more")
        )
    joined = lookup(rounded, changes.select("_row", "way"), ["_row"])
    return joined.withColumn("copies", F.col("copies") + F.coalesce("way", F.lit(0))).drop("way")


def sizes_of(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, source, size, _row); the row number is fixed by the staging."""
    return stage(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
        .withColumn("_row", F.monotonically_increasing_id()),
        "sized",
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken of every document."""
    out = mixed(sizes_of(docs), weights, most)
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("_row")


def repeat_to_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.

    Rows are known by doc_id and a hash of all columns, so texts are neither written nor, up to
    COPIES_SENT such pairs, shuffled. Rows that are equal in both are one document in several rows: the
    copies of all of them are made from the first.
    """
    hash_ = unused(docs, "_hash")
    hashed = docs.withColumn(hash_, F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    sized = hashed.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.col(hash_).alias("_hash"))
    sized = stage(sized.withColumn("_row", F.monotonically_increasing_id()), "sized")
    taken = stage(
        mixed(sized, weights, most).groupBy("doc_id", "_hash")
        .agg(F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .filter("_copies > 0"),
        "taken",
    )
    copies, rows, place = (unused(docs, x) for x in ("_copies", "_rows", "_place"))
    other, other_hash = unused(docs, "_of"), unused(docs, "_hash_of")
    right = taken.toDF(other, other_hash, copies, rows)
    if taken.limit(COPIES_SENT + 1).count() <= COPIES_SENT:
        right = F.broadcast(right)
    same = (hashed[hash_] == right[other_hash]) & hashed["doc_id"].eqNullSafe(right[other])
    joined = hashed.join(right, same)
    again = joined.filter(F.col(rows) == 1)
    if not taken.filter("_rows > 1").isEmpty():
        first = Window.partitionBy("doc_id", hash_).orderBy(F.lit(0))
        several = joined.filter(F.col(rows) > 1).withColumn(place, F.row_number().over(first))
        again = again.unionByName(several.filter(F.col(place) == 1).drop(place))
    again = again.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return again.drop(hash_, other, other_hash, copies, rows)
