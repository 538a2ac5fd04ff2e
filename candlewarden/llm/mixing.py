"""Mixing sources to target weights by Pareto order sampling.

A source's words are taken ``target / size`` times. The whole part is certain: that many copies of each
of its documents. For what is left, documents have unequal inclusion odds: the probability grows with the binary
logarithm of a document's length (the length's bits), up to certainty, times a factor solved for each source so
that the expected words are those that are left. Each document has a uniform number u from a hash of its id, and the
ranking value (u / (1 - u)) / (p / (1 - p)), random odds over inclusion odds. The documents with the smallest
values are added until the words come closest to the target, so the sample has a fixed size.

The order is never made for a whole source. Words are summed by source and by cells of the ranking value (before
the shuffle), cells are added up in order, and the one cell that holds the end is cut into finer cells until it has
few documents; only these are ordered. That gives one value per source, the last that is in; rows compare themselves with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.llm.common import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
CELL_BITS = 10
PLACE_BITS = 4 * CELL_BITS
ORDERED = 50_000  # documents of a cell that may be ordered in one task; larger cells are cut further
SALT = "mix-1"


def n_words(text: Column) -> Column:
    """Number of words. Each word and the white space after it becomes one sign, so no list of a text's words is made."""
    signs = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "w")
    return F.length(F.ltrim(signs, F.lit(" \t\n\v\f\r"))).cast("bigint")


def uniform(doc_id: Column, size: Column) -> Column:
    """A number in (0, 1) from 52 bits of an MD5; equal for equal id and size, so reruns agree."""
    digest = F.md5(F.concat_ws("|", F.lit(SALT), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> (source, source_size, target): weights by rank, no target above MOST times the size.

    Sharing again what is cut off ends where every target is min(MOST * size, weight * level) for one
    level. Sources are ordered by MOST * size / weight; the level is right where the next one is not cut.
    The windows run over one row per source.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(names) - 1) % len(WEIGHTS) + 1)
    ranked = sizes.withColumn("weight", weight.cast("bigint")).withColumn("most", MOST * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stepped = ranked.withColumns(
        {
            "total": F.sum("source_size").over(all_rows),
            "cut": F.coalesce(F.sum("most").over(before), F.lit(0)),
            "weights": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "place": F.row_number().over(order),
        }
    ).withColumn("level", (F.col("total") - F.col("cut")).cast("double") / F.col("weights").cast("double"))
    # the first source in order that its own level does not cut fixes the level
    free = F.col("weight") * F.col("level") <= F.col("most")
    leveled = stepped.withColumn("level", F.min(F.when(free, F.struct("place", "level"))).over(all_rows)["level"])
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("weight") * F.coalesce(F.col("level"), F.lit(0.0))).alias("target"),
    )


def factors(classes: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, factor): inclusion probabilities min(1, factor * bits) that make ``extra`` the expected words.

    ``classes`` has source, bits and words, at most 64 rows per source. Classes of the longest documents are certain
    as long as their probability would be over 1; the rest share what these leave.
    """
    named = sources.select(F.col("source").alias("_name"), "extra")
    joined = classes.join(named, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    longest = Window.partitionBy("source").orderBy(F.col("bits").desc())
    above = F.coalesce(F.sum("words").over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("bits") * F.col("words")).over(longest.rowsBetween(0, Window.unboundedFollowing))
    factor = (F.col("extra") - above.cast("double")) / rest.cast("double")
    tried = joined.select("source", "bits", factor.alias("factor")).where(F.col("factor") * F.col("bits") <= 1)
    return tried.groupBy("source").agg(F.max_by("factor", "bits").alias("factor"))


def ranked(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents that may be added, with their ranking value and its place, a whole number of ``PLACE_BITS`` bits in the same order."""
    named = sources.select(F.col("source").alias("_name"), "extra", "factor")
    joined = sized.where("size > 0").join(named, F.col("source").eqNullSafe(F.col("_name")))
    p = F.least(F.lit(1.0), F.col("factor") * F.length(F.bin("size")))
    odds = joined.where("extra > 0 AND factor > 0").withColumn("_p", p)
    rank = F.when(F.col("_p") >= 1, F.lit(0.0)).otherwise((F.col("u") / (1 - F.col("u"))) / (F.col("_p") / (1 - F.col("_p"))))
    return odds.withColumn("rank", rank).withColumn("place", place_of(F.col("rank"))).drop("_p")


def place_of(rank: Column) -> Column:
    return F.floor(rank / (1 + rank) * float(1 << PLACE_BITS)).cast("bigint")


def _ends(rows: DataFrame) -> DataFrame:
    """(_name, place, bits, before): for each source the cell of places that holds the end, and the words before it.

    A cell is a place without its last ``bits`` bits. All sources go one level deeper while any end cell is too large.
    """
    bits, inner = PLACE_BITS - CELL_BITS, rows.withColumn("_from", F.lit(0).cast("bigint"))
    while True:
        cells = inner.groupBy("_name", F.shiftright("place", bits).alias("cell")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.max("_from").alias("_from"), F.max("extra").alias("extra")
        )
        up_to = Window.partitionBy("_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("_from") + F.coalesce(F.sum("words").over(up_to), F.lit(0))
        found = cells.withColumn("before", before).where("before <= extra AND extra < before + words")
        found = materialise(found.select(F.col("_name").alias("_source"), "cell", "before", "n", F.lit(bits).alias("bits")), "ends")
        if not bits or (found.agg(F.max("n")).first()[0] or 0) <= ORDERED:
            return found
        same = F.col("_name").eqNullSafe(F.col("_source")) & (F.shiftright("place", bits) == F.col("cell"))
        inner = rows.join(found, same).withColumn("_from", F.col("before")).drop("_source", "cell", "before", "n", "bits")
        bits -= CELL_BITS


def plan(sized: DataFrame) -> DataFrame:
    """One row per source: its size, target, copies and factor, and where its sample ends.

    ``sized`` has source, size and u, and is read several times: write it first. Rows before ``_below`` (a place) are
    in, and those whose (rank, u) is at most (``_last_rank``, ``_last_u``).
    """
    classes = sized.groupBy("source", F.length(F.bin("size")).alias("bits")).agg(F.sum("size").alias("words"))
    classes = materialise(classes, "classes")
    sources = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")))
    ratio = F.try_divide(F.col("target"), F.col("source_size").cast("double"))
    sources = sources.withColumn("copies", F.coalesce(F.floor(ratio), F.lit(0)).cast("bigint"))
    sources = sources.withColumn("extra", F.col("target") - (F.col("copies") * F.col("source_size")).cast("double"))
    solved = factors(classes.where("words > 0"), sources).withColumnRenamed("source", "_name")
    sources = sources.join(solved, F.col("source").eqNullSafe(F.col("_name")), "left").drop("_name")
    sources = materialise(sources, "sources")
    rows = ranked(sized, sources)
    ends = _ends(rows)
    same = F.col("_name").eqNullSafe(F.col("_source")) & (F.expr("shiftright(place, bits)") == F.col("cell"))
    inside = rows.join(ends, same)
    ties = inside.groupBy("_name", "before", "extra", "rank", "u").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("_name").orderBy("rank", "u").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        ties.withColumn("so_far", F.col("before") + F.coalesce(F.sum("words").over(running), F.lit(0)))
        .where("2 * so_far + words <= 2 * extra")
        .groupBy("_name")
        .agg(F.max(F.struct("rank", "u")).alias("_last"))
    )
    below = ends.select(F.col("_source").alias("_l"), F.expr("shiftleft(cell, bits)").alias("_below"))
    return (
        sources.join(below, F.col("source").eqNullSafe(F.col("_l")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("_name")), "left")
        .select(
            F.col("source").alias("_source"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.col("copies").alias("_copies"),
            F.coalesce("factor", F.lit(0.0)).alias("_factor"),
            # without an end cell there is nothing to add
            F.coalesce("_below", F.lit(0).cast("bigint")).alias("_below"),
            F.coalesce(F.col("_last.rank"), F.lit(-1.0)).alias("_last_rank"),
            F.coalesce(F.col("_last.u"), F.lit(-1.0)).alias("_last_u"),
        )
    )


def _taken(rows: DataFrame, planned: DataFrame, size: str, u: str) -> DataFrame:
    """``rows`` with the columns of their source's plan and how often each is taken."""
    joined = rows.join(planned, F.col("source").eqNullSafe(F.col("_source")))
    p = F.least(F.lit(1.0), F.col("_factor") * F.length(F.bin(size)))
    rank = F.when(p >= 1, F.lit(0.0)).when(p > 0, (F.col(u) / (1 - F.col(u))) / (p / (1 - p)))
    first = (place_of(rank) < F.col("_below")) | (rank < F.col("_last_rank")) | ((rank == F.col("_last_rank")) & (F.col(u) <= F.col("_last_u")))
    added = F.coalesce((F.col(size) > 0) & first, F.lit(False))
    return joined.withColumn("_taken", F.col("_copies") + added.cast("bigint"))


def mix_counts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted).

    Null text has size 0; null is a source, ordered last. A source without words has target 0. Repeated
    rows (same id and size) share their number, so they are in or out together. Other columns are not read.
    """
    size = n_words(F.col("text"))
    sized = materialise(
        docs.select("doc_id", "source", size.alias("size")).withColumn("u", uniform(F.col("doc_id"), F.col("size"))), "sized"
    )
    planned = materialise(plan(sized), "plan")
    return _taken(sized, planned, "size", "u").select(
        "doc_id",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("size") * F.col("_taken")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as it is taken, with its columns unchanged, whatever their names.

    Documents without words are not taken beyond the certain copies.
    """
    size = n_words(F.col("text"))
    measured = docs.select(F.struct("*").alias("row"), "source", size.alias("size"), uniform(F.col("doc_id"), size).alias("u"))
    sized = materialise(measured.select("source", "size", "u"), "sized")
    planned = materialise(plan(sized), "plan")
    taken = _taken(measured, planned, "size", "u").where("_taken > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("_taken").cast("int")))).select("row.*")
