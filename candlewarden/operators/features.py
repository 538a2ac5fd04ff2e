"""Rolling features of a price series, and the look-ahead features that must be caught.

A feature is a function ``(bars, keys) -> (keys..., ts, value)``. ``keys`` is the series key, to which
the causality test adds the cut, so that all prefixes are evaluated in one job. A feature may say more of
itself: ``Framed`` how many rows its frame reaches, ``Stepped`` how a value follows from the state before it.
The causality test then need not evaluate every prefix in whole; any other function is tested as it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.functions.chunks import (
    HALO,
    halo_window,
    join_series_values,
    with_halo,
    with_previous,
    with_running,
)
from candlewarden.schema import MINUTES_SQL, SERIES

Feature = Callable[[DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Framed:
    """A feature whose value at a row depends on ``before`` rows ahead of it, itself and ``after`` rows behind it."""

    evaluate: Feature
    before: int = 0
    after: int = 0

    def __call__(self, bars: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
        return self.evaluate(bars, keys)


@dataclass(frozen=True)
class Stepped:
    """A feature that carries a state along the series.

    ``trace`` gives (keys, ts, x, value, states); ``step`` the value of a row from its ``x`` and the states of the
    row before, which it names by ``previous`` and which are NULL at the first row.
    """

    trace: Feature
    states: tuple[str, ...]
    step: Callable[[Column, dict[str, Column]], Column]

    def __call__(self, bars: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
        return self.trace(bars, keys).select(*keys, "ts", "value")


def _price(bars: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return bars.select(*keys, "ts", F.col(column).cast("double").alias("x"))


def _framed(bars, keys, column, before, after, value: Callable) -> DataFrame:
    """Evaluate a window expression over a frame that reaches a fixed number of rows."""
    rows = with_halo(_price(bars, keys, column), keys, "ts", before, after)
    out = rows.withColumn("value", value(halo_window(keys, "ts")))
    return out.where(~F.col(HALO)).select(*keys, "ts", "value")


def column_value(column: str) -> Feature:
    def feature(bars, keys=SERIES):
        return _price(bars, keys, column).withColumnRenamed("x", "value")

    return Framed(feature)


def rolling_mean(n: int = 5, column: str = "close") -> Feature:
    """Mean of the last ``n`` values, NULL until there are ``n``."""

    def feature(bars, keys=SERIES):
        def value(w) -> Column:
            frame = w.rowsBetween(1 - n, 0)
            return F.when(F.count("x").over(frame) == n, F.avg("x").over(frame))

        return _framed(bars, keys, column, n - 1, 0, value)

    return Framed(feature, before=n - 1)


def centred_mean(n: int = 5, column: str = "close") -> Feature:
    """Mean of ``n`` values around the row: looks ahead by half the window."""
    half = n // 2

    def feature(bars, keys=SERIES):
        def value(w) -> Column:
            frame = w.rowsBetween(-half, half)
            return F.when(F.count("x").over(frame) == n, F.avg("x").over(frame))

        return _framed(bars, keys, column, half, half, value)

    return Framed(feature, before=half, after=half)


def pct_change(column: str = "close") -> Feature:
    """Relative change to the previous value; NULL where the previous value is 0."""

    def feature(bars, keys=SERIES):
        linked = with_previous(_price(bars, keys, column), keys, "ts", {"prev": "x"})
        return linked.select(*keys, "ts", (F.try_divide("x", "prev") - 1).alias("value"))

    return Framed(feature, before=1)


def expanding_mean(column: str = "close") -> Feature:
    def trace(bars, keys=SERIES):
        run = with_running(_price(bars, keys, column), keys, "ts", "x", "_total", "_seen")
        return run.select(*keys, "ts", "x", F.try_divide("_total", "_seen").alias("value"), "_total", "_seen")

    def step(x: Column, previous: dict[str, Column]) -> Column:
        total = F.coalesce(previous["_total"], F.lit(0.0)) + F.coalesce(x, F.lit(0.0))
        return F.try_divide(total, F.coalesce(previous["_seen"], F.lit(0)) + x.isNotNull().cast("bigint"))

    return Stepped(trace, ("_total", "_seen"), step)


def ahead(n: int = 1, column: str = "close") -> Feature:
    """The value ``n`` rows later: plain look-ahead."""

    def feature(bars, keys=SERIES):
        return _framed(bars, keys, column, 0, n, lambda w: F.lead("x", n).over(w))

    return Framed(feature, after=n)


def known_ahead(n: int = 1, column: str = "close") -> Feature:
    """As ``ahead`` without the rows that have no such value: it also changes the length of its input."""

    def feature(bars, keys=SERIES):
        return ahead(n, column)(bars, keys).where(F.col("value").isNotNull())

    return Framed(feature, after=n)


def future_label(n: int = 3, column: str = "close") -> Feature:
    """1 when the value ``n`` rows later is higher, else 0, also where there is no such row."""

    def feature(bars, keys=SERIES):
        def value(w) -> Column:
            rises = F.lead("x", n).over(w) > F.col("x")
            return F.coalesce(rises, F.lit(False)).cast("double")

        return _framed(bars, keys, column, 0, n, value)

    return Framed(feature, after=n)


def zscore(column: str = "close") -> Feature:
    """Distance from the mean of the whole series in sample deviations: leaks the future."""

    def feature(bars, keys=SERIES):
        rows = _price(bars, keys, column)
        whole = rows.groupBy(*keys).agg(F.avg("x").alias("_mean"), F.stddev_samp("x").alias("_std"))
        placed = join_series_values(rows, whole, keys, "ts")
        return placed.select(*keys, "ts", F.try_divide(F.col("x") - F.col("_mean"), "_std").alias("value"))

    return feature


# a value this many e-folds old no longer reaches the last bit of an exponential mean
FORGOTTEN = 100.0
BLOCK = "_block"


def ewm_mean(span: int = 10, column: str = "close") -> Feature:
    """Exponentially weighted mean, y = a*x + (1-a)*y_prev with a = 2 / (span + 1), started at the first value.

    With d = 1 - a, the k-th value of a block is d^k * (d * y_before + sum of a * x_j * d^-j), a running sum.
    Blocks are so many values that d^-j stays finite and that d^block is below exp(-FORGOTTEN). What a block
    starts from is therefore settled by the two blocks before it, and no series is scanned in one task.
    NULL and NaN are skipped: such a row shows the mean before it, NULL if there is none.
    """
    alpha = 2.0 / (span + 1)
    decay = 1.0 - alpha
    size = math.ceil(FORGOTTEN / -math.log(decay)) if decay > 0 else 1

    def trace(bars, keys=SERIES):
        plain = _price(bars, keys, column).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
        counted = with_running(plain, keys, "ts", "x", "_total", "_seen")
        place = F.greatest(F.col("_seen") - 1, F.lit(0))
        rows = counted.select(
            *keys, "ts", "x", "_seen", F.floor(place / size).alias(BLOCK), (place % size).cast("double").alias("_k")
        )
        share = F.when(F.col("_seen") == 1, F.col("x")).otherwise(alpha * F.col("x"))
        inside = Window.partitionBy(*keys, BLOCK).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
        summed = rows.withColumn("_own", F.sum(share * F.pow(F.lit(decay), -F.col("_k"))).over(inside)).withColumn(
            "_own", F.col("_own") * F.pow(F.lit(decay), F.col("_k"))
        )
        over_blocks = Window.partitionBy(*keys).orderBy(BLOCK)
        ends = summed.groupBy(*keys, BLOCK).agg(F.max_by("_own", "ts").alias("_end"))
        earlier = F.coalesce(F.lag("_end").over(over_blocks), F.lit(0.0))
        ends = ends.withColumn("_end", F.col("_end") + decay**size * earlier)
        starts = ends.select(*keys, BLOCK, F.coalesce(F.lag("_end").over(over_blocks), F.lit(0.0)).alias("_start"))
        value = F.col("_own") + F.col("_start") * F.pow(F.lit(decay), F.col("_k") + 1)
        return summed.join(starts, [*keys, BLOCK], "left").select(*keys, "ts", "x", value.alias("value"), value.alias("_mean"))

    def step(x: Column, previous: dict[str, Column]) -> Column:
        mean = previous["_mean"]
        return F.when(x.isNull(), mean).when(mean.isNull(), x).otherwise(alpha * x + decay * mean)

    return Stepped(trace, ("_mean",), step)


def available_at(bars: DataFrame) -> DataFrame:
    """Add the instant at which a bar is fully known: its start plus its timeframe."""
    return bars.withColumn("available_at", F.expr(f"ts + make_dt_interval(0, 0, {MINUTES_SQL})"))
