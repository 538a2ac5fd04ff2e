"""Document fingerprints from closed syncmers of words.

A k-mer of ``K`` words is chosen when the smallest hash among its inner ``S``-word substrings lies at its
first or last place. Whether it is chosen depends on its own words alone, so a shared passage gives the
same anchors in both texts wherever it stands. The fingerprint lists the anchors' hashes in text order.

Everything is DataFrame functions over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.llm.common import WHITE, materialise

K = 7
S = 2
_INNER = K - S + 1
RANGES = 1 << 13  # ranges of ids at most
SAMPLE = 32  # ids a range that the borders of ranges are chosen from; only the sizes of tasks depend on them


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the anchors of the text as 31-bit numbers, in text order.

    A text of one to K - 1 words has one anchor, the hash of all of them. A longer text without a closed
    syncmer (only some of up to 10 words) has its k-mer of the smallest hash. Only one without words has none.
    """
    words, inner, places = "_cw_words", "_cw_inner", "_cw_places"
    hashes = ", ".join(f"{inner}[i + {j}]" for j in range(_INNER))
    low31 = "cast({} & 2147483647L as int)"
    kmer = low31.format(f"xxhash64({inner}[i], {inner}[i + 2], {inner}[i + 4], {inner}[i + {_INNER - 1}])")  # all K words
    step = rows.withColumn(words, F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WHITE), ""))
    step = step.withColumn(
        inner,
        F.expr(
            f"if(size({words}) < {K}, cast(array() as array<bigint>), "
            f"transform(sequence(0, size({words}) - {S}), i -> xxhash64({words}[i], {words}[i + 1])))"
        ),
    )
    step = step.withColumn(
        places,
        F.expr(
            f"if(size({inner}) = 0, cast(array() as array<int>), filter(sequence(0, size({inner}) - {_INNER}), "
            f"i -> least({inner}[i], {inner}[i + {_INNER - 1}]) <= least({hashes})))"
        ),
    )
    step = step.withColumn(
        out,
        F.expr(
            f"case when size({words}) = 0 then cast(array() as array<int>) "
            f"when size({words}) < {K} then array({low31.format(f'xxhash64(array_join({words}, chr(32)))')}) "
            f"when size({places}) = 0 then array(array_min(transform(sequence(0, size({inner}) - {_INNER}), i -> {kmer}))) "
            f"else transform({places}, i -> {kmer}) end"
        ),
    )
    return step.drop(words, inner, places)


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared anchors over all anchors (Dice); texts without anchors are alike."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def as_text(anchors: Column) -> Column:
    return F.array_join(anchors.cast("array<string>"), " ")


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at most the id, by halving; null ids are in range -1."""
    steps, step = [], 1
    while step <= len(cuts):
        steps.append(step)
        step *= 2
    if not cuts:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    table = F.array(*[F.lit(x).cast("bigint") for x in cuts])
    at = F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda low, by: F.when((low + by <= len(cuts)) & (F.try_element_at(table, low + by) <= doc_id), low + by).otherwise(low),
    )
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(at)


def _ranged(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` with ``_cw_range``: ranges of ids with about equal row counts, in id order."""
    wanted = max(1, min(ranges, RANGES))
    share = min(1.0, SAMPLE * wanted / max(1, docs.count()))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    # one hash for rows of one id, so a repeated id comes once or not at all
    some = docs.where("doc_id IS NOT NULL").where(picked).select("doc_id").distinct()
    ids = sorted(r[0] for r in some.collect()) if wanted > 1 else []
    cuts = sorted({ids[len(ids) * k // wanted] for k in range(1, wanted)}) if ids else []
    return docs.withColumn("_cw_range", _range_of(F.col("doc_id"), cuts))


def _heads_after(ranged: DataFrame) -> DataFrame:
    """For each range, text and anchors of the row that follows its last one: the first row of the range below.

    The first ids of the ranges are found without the texts; at most RANGES + 1 rows are broadcast, and
    as many heads meet in one task.
    """
    first = ranged.groupBy("_cw_range").agg(F.max("doc_id").alias("_cw_first")).withColumnRenamed("_cw_range", "_cw_of")
    is_first = (F.col("_cw_range") == F.col("_cw_of")) & F.col("doc_id").eqNullSafe(F.col("_cw_first"))
    heads = ranged.join(F.broadcast(first), is_first).groupBy("_cw_range").agg(F.min("text").alias("text"))
    heads = materialise(with_anchors(heads, "text", "anchors"), "heads")
    around = Window.orderBy(F.col("_cw_range").desc())
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.struct("text", "anchors")
    return heads.select("_cw_range", F.coalesce(F.lead(head).over(around), F.first(head).over(whole)).alias("_cw_head"))


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text and anchors with next_text and next_anchors of the next row by descending doc_id; after the last: the first.

    Rows are shuffled once, to ranges of ids, where the next row is the one below; the last row of a
    range takes the head of the next range that has rows. Equal ids are ordered by their text, null ids
    come last.
    """
    ranged = _ranged(docs.select("doc_id", "text"), ranges)
    inside = Window.partitionBy("_cw_range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text"))
    rows = with_anchors(ranged, "text", "anchors").withColumn("_cw_next", F.lead(F.struct("text", "anchors")).over(inside))
    found = F.coalesce("_cw_next", "_cw_head")
    return rows.join(_heads_after(ranged), "_cw_range").select(
        "doc_id", "text", "anchors", found["text"].alias("next_text"), found["anchors"].alias("next_anchors")
    )


def fingerprints(docs: DataFrame, ranges: int) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next document (all, if it has fewer). Null text counts as empty; a single document is its own next.
    Repeated rows are neighbours of each other; other columns are not read.
    """
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(plain, ranges)
    rows = rows.withColumn("n_chars", F.length("text")).withColumn(
        "edited",
        F.expr("concat(substring(text, 1, n_chars - n_chars div 2), substring(next_text, 1, cast(n_chars div 2 as int)))"),
    )
    rows = with_anchors(rows, "edited", "edited_anchors")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
