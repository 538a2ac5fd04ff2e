"""Quantiles of very large columns from mergeable rank sketches, with a stated error.

A sketch counts the values of a series by their leading ``bits`` binary digits. It is a small table, the sketch
of two tables is the sum of their sketches, and bucketing keeps the order, so the bucket that holds a rank is
known exactly: an estimate is the bound of its bucket that is nearer to zero, and the value of that rank is at
most ``error(bits)`` of it farther out (plus the unit). Exact quantiles (``functions.quantiles``) stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.schema import SERIES

BITS = 8
UNIT = 1e-6  # the grid on which values with decimals are counted
KEYS = [*SERIES, "metric"]


def error(bits: int = BITS) -> float:
    """How far a value may be from its estimate, as a share of the estimate."""
    return 2.0 ** (1 - bits)


def bucket_sql(value: str, bits: int = BITS) -> str:
    """A whole number without all but its leading ``bits`` digits."""
    drop = f"greatest(length(bin(abs({value}))) - {bits}, 0)"
    return f"sign({value}) * shiftleft(shiftright(abs({value}), {drop}), {drop})"


def sketch(rows: DataFrame, metrics: Mapping[str, str], bits: int = BITS) -> DataFrame:
    """(symbol, timeframe, metric, bucket, n) of SQL expressions over ``rows``; nulls and values that are no number are left out.

    Values are counted in units of ``UNIT``. One aggregate with map-side partial counts: a task hands on at most
    some thousand buckets of each series.
    """
    cells = ", ".join(f"struct('{name}' AS metric, double({sql}) AS x)" for name, sql in metrics.items())
    long = rows.selectExpr(*SERIES, f"inline(array({cells}))").where("x IS NOT NULL AND NOT isnan(x) AND abs(x) < 9e12")
    whole = long.selectExpr(*KEYS, f"cast(round(x / {UNIT}D) AS bigint) AS v")
    return whole.selectExpr(*KEYS, f"cast({bucket_sql('v', bits)} AS bigint) AS bucket").groupBy(*KEYS, "bucket").agg(F.count("*").alias("n"))


def merge(sketches: Sequence[DataFrame]) -> DataFrame:
    """The sketch of all rows together, for instance of several ingests."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy(*KEYS, "bucket").agg(F.sum("n").alias("n"))


def quantiles(merged: DataFrame, probs: Sequence[float], bits: int = BITS) -> DataFrame:
    """(symbol, timeframe, metric, prob, n, estimate, farthest): the value of rank ceil(prob * n) lies between the last two.

    The window runs over the buckets of one metric of one series, which are few whatever the number of rows.
    """
    over = Window.partitionBy(*KEYS).orderBy("bucket")
    whole = Window.partitionBy(*KEYS)
    ranked = merged.select(*KEYS, "bucket", F.sum("n").over(over).alias("_upto"), F.sum("n").over(whole).alias("total"), "n")
    asked = ranked.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    rank = F.greatest(F.ceil(F.col("prob") * F.col("total")), F.lit(1))
    hit = asked.where((F.col("_upto") >= rank) & (F.col("_upto") - F.col("n") < rank))
    return hit.select(*KEYS, "prob", F.col("total").alias("n"), _scaled(F.col("bucket")).alias("estimate"), _farthest(F.col("bucket"), bits).alias("farthest"))


def _scaled(units: Column) -> Column:
    return units * F.lit(UNIT)


def _farthest(bucket: Column, bits: int) -> Column:
    return _scaled(bucket + F.signum(bucket.cast("double")) * F.floor(F.abs(bucket) * F.lit(error(bits))))
