"""Exact linear-interpolated quantiles per key, with no per-key state in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here equal values are counted
first (map-side, so a value that fills a third of the table collapses early), counts are added up over
order-preserving value buckets, and only the buckets that hold a wanted rank are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fine enough that a bucket of even a very long series holds few distinct values
BUCKETS_PER_OCTAVE = 4096
# log2 of the smallest positive double is -1074; the offset keeps bucket numbers of positives above 0
OFFSET = 1100 * BUCKETS_PER_OCTAVE
# never decreases as the value grows; zero, negatives and infinities included
BUCKET = f"""CASE WHEN value = 0 THEN 0L
    ELSE CAST(signum(value) AS BIGINT)
         * (floor(log2(least(abs(value), 1e308)) * {BUCKETS_PER_OCTAVE}) + {OFFSET}) END"""


def value_counts(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """(keys, metric, value, n): how often each value of each metric occurs; NULL and NaN are skipped.

    ``values`` maps a metric name to a SQL expression.
    """
    cells = ", ".join(f"struct('{m}' AS metric, double({sql}) AS value)" for m, sql in values.items())
    return (
        df.selectExpr(*keys, f"inline(array({cells}))")
        .where("value IS NOT NULL AND NOT isnan(value)")
        .groupBy(*keys, "metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], probs: Mapping[str, Sequence[float]]
) -> DataFrame:
    """(keys, metric, prob, value) from a table of value counts."""
    group = [*keys, "metric"]
    bucketed = counts.withColumn("bucket", F.expr(BUCKET))
    totals = bucketed.groupBy(*group, "bucket").agg(F.sum("n").alias("size"))
    ordered = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    listed = " ".join(
        f"WHEN '{m}' THEN array({', '.join(f'{float(p)}D' for p in ps)})" for m, ps in probs.items()
    )
    ranks = f"""transform(CASE metric {listed} END, p -> struct(
        p AS prob, floor(p * (total - 1)) AS lo, ceil(p * (total - 1)) AS hi,
        p * (total - 1) - floor(p * (total - 1)) AS frac))"""
    placed = totals.select(
        *group,
        "bucket",
        F.sum("size").over(ordered).alias("stop"),
        F.sum("size").over(Window.partitionBy(*group)).alias("total"),
        "size",
    ).selectExpr(*group, "bucket", "stop - size AS start", "stop", f"{ranks} AS ranks")
    inside = "filter(ranks, r -> (r.lo >= start AND r.lo < stop) OR (r.hi >= start AND r.hi < stop))"
    needed = placed.selectExpr(*group, "bucket", "start", f"{inside} AS ranks").where("size(ranks) > 0")
    by_value = (
        Window.partitionBy(*group, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        bucketed.join(needed, [*group, "bucket"])
        .withColumn("upto", F.col("start") + F.sum("n").over(by_value))
        .selectExpr(*group, "value", "upto - n AS from", "upto", "inline(ranks)")
    )
    ends = ranked.groupBy(*group, "prob").agg(
        F.expr("max(CASE WHEN lo >= from AND lo < upto THEN value END) AS low"),
        F.expr("max(CASE WHEN hi >= from AND hi < upto THEN value END) AS high"),
        F.expr("max(frac) AS frac"),
    )
    between = "CASE WHEN frac = 0 OR low = high THEN low ELSE low + (high - low) * frac END AS value"
    return ends.selectExpr(*group, "prob", between)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    probs: Mapping[str, Sequence[float]],
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, values), keys, probs)


def prob_name(prob: float) -> str:
    return f"p{prob * 100:g}".replace(".", "_")


def wide(quantiles: DataFrame, keys: Sequence[str], probs: Mapping[str, Sequence[float]]) -> DataFrame:
    """One row per key with a column ``<metric>_p<percent>`` for every metric and probability."""
    cells = [
        F.expr(
            f"max(CASE WHEN metric = '{m}' AND prob = {float(p)}D THEN value END) AS {m}_{prob_name(p)}"
        )
        for m, ps in probs.items()
        for p in ps
    ]
    return quantiles.groupBy(*keys).agg(*cells)
