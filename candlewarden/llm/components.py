"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import materialise


def _size(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (columns ``a``, ``b``); the label is the least node reached.

    Each round makes every node point at the least node around it. Minima are combined before the
    shuffle, so a node with a large share of the links costs one row per task there; each round is a
    written table, so a lost executor repeats one round. Nulls and self links are ignored.
    """
    links = materialise(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = _size(links)
    while before[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        links = materialise(
            joined.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        after = _size(links)
        if after == before:
            break
        before = after
    ends = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(ends)
