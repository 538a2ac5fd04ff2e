"""Does a feature use rows after the row it is evaluated for?

For every cut, the feature of the rows up to the cut must equal the feature of all rows there.

* A ``Framed`` feature can differ only at rows whose frame reaches beyond the cut. These, at least the row at
  the cut itself, are evaluated from the last rows of the prefix that their frames reach, and compared; the rows
  before them count as compared. A cut costs a few rows, however long its prefix.
* A ``Stepped`` feature is causal at every cut if each value follows from the state of the row before it. That is
  checked once for every row; a cut only looks up how many rows up to it fail.
* For any other function all prefixes are evaluated, with the cut as one more key.

The two sides meet in one full outer join on (series, cut, ts), which no single series can dominate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values, with_position, with_previous, with_running
from candlewarden.functions.session import materialise
from candlewarden.operators.features import Feature, Framed, Stepped
from candlewarden.schema import SERIES

CUT = "cut"
KEYS = [*SERIES, CUT]


def default_positions(n):
    """Cut positions of a series of ``n`` rows, each at least 1, without repeats."""
    whole = [F.floor(n / 7), F.floor(n / 3), F.floor(n / 2), F.floor(n * 3 / 4), n - 1]
    return F.array_distinct(F.array(*[F.greatest(p.cast("bigint"), F.lit(1).cast("bigint")) for p in whole]))


def cuts_of(bars: DataFrame, positions: Sequence[int] | None = None) -> DataFrame:
    """(symbol, timeframe, cut, cut_ts): the last row of every prefix. Cuts beyond the series are skipped."""
    lengths = bars.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("_n"))
    if positions is None:
        wanted = default_positions(F.col("_n"))
    else:
        listed = [F.lit(int(p)).cast("bigint") for p in sorted(set(positions))]
        wanted = F.filter(F.array(*listed), lambda p: (p >= 1) & (p <= F.col("_n")))
    numbered = with_position(bars.select(*SERIES, "ts"), SERIES, "ts", "_position")
    placed = join_series_values(numbered, lengths.withColumn("_cuts", wanted), SERIES, "ts")
    return placed.where(F.array_contains("_cuts", F.col("_position"))).select(
        *SERIES, F.col("_position").alias(CUT), F.col("ts").alias("cut_ts")
    )


def prefixes(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Every row once for each cut of its series that it precedes."""
    ends = cuts.groupBy(*SERIES).agg(F.collect_list(F.struct(CUT, "cut_ts")).alias("_ends"))
    placed = join_series_values(rows, ends, SERIES, "ts")
    reached = F.filter("_ends", lambda e: F.col("ts") <= e["cut_ts"])
    return placed.withColumn("_end", F.explode(reached)).select(*rows.columns, F.col(f"_end.{CUT}").alias(CUT))


def compare_prefixes(
    bars: DataFrame, feature: Feature, positions: Sequence[int] | None = None, atol: float = 0.0
) -> DataFrame:
    """One row per series and cut: rows compared, differing and one-sided, and the first bad row.

    NULL and NaN equal each other. One-sided rows mean the feature changed the length of its input.
    """
    cuts = materialise(cuts_of(bars, positions), "cuts")  # read several times
    if isinstance(feature, Stepped):
        return _compare_steps(bars, feature, cuts, atol)
    if isinstance(feature, Framed):
        return _compare_frames(bars, feature, cuts, atol)
    return _compare(cuts, feature(prefixes(bars, cuts), KEYS), prefixes(feature(bars, SERIES), cuts), atol)


def _values(df: DataFrame, name: str) -> DataFrame:
    return df.select(*KEYS, "ts", F.col("value").cast("double").alias(name), F.lit(True).alias(f"_in_{name}"))


def _near(a: Column, b: Column, atol: float) -> Column:
    """Equal, both without a value (NULL or NaN), or not farther apart than ``atol``."""
    a, b = (F.nanvl(c, F.lit(None).cast("double")) for c in (a, b))
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= atol, F.lit(False))


def _compare(cuts: DataFrame, in_prefix: DataFrame, in_full: DataFrame, atol: float) -> DataFrame:
    """Compare values of prefixes and of the whole, both by (series, cut, ts)."""
    keys = KEYS
    both = _values(in_full, "full_value").join(_values(in_prefix, "prefix_value"), [*keys, "ts"], "full_outer")
    prefix, full = (F.nanvl(c, F.lit(None).cast("double")) for c in ("prefix_value", "full_value"))
    near = _near(F.col("prefix_value"), F.col("full_value"), atol)
    present = F.col("_in_prefix_value").isNotNull() & F.col("_in_full_value").isNotNull()
    differs = present & ~near
    compared = both.groupBy(*keys).agg(
        F.count_if(present).alias("compared"),
        F.count_if(differs).alias("differing"),
        F.count_if(~present).alias("one_sided"),
        F.min(F.when(differs, F.col("ts"))).alias("first_bad_ts"),
        F.min_by(F.when(differs, prefix), F.when(differs, F.col("ts"))).alias("prefix_value"),
        F.min_by(F.when(differs, full), F.when(differs, F.col("ts"))).alias("full_value"),
    )
    return cuts.join(compared, keys, "left").select(
        *keys,
        "cut_ts",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("compared", "differing", "one_sided")],
        "first_bad_ts",
        "prefix_value",
        "full_value",
    )


def _compare_frames(bars: DataFrame, feature: Framed, cuts: DataFrame, atol: float) -> DataFrame:
    """Compare only rows whose frame reaches beyond a cut, evaluated from the rows that their frames reach."""
    shown = max(feature.after, 1)
    numbered = materialise(with_position(bars, SERIES, "ts", "_position"), "numbered")
    wanted = F.sequence(F.greatest(F.col(CUT) - (shown + feature.before) + 1, F.lit(1).cast("bigint")), F.col(CUT))
    slices = cuts.select(*KEYS, F.explode(wanted).alias("_position")).join(numbered, [*SERIES, "_position"])
    slices = materialise(slices, "slices")
    window = slices.where(F.col("_position") > F.col(CUT) - shown).select(*KEYS, "ts")
    in_prefix = feature(slices.drop("_position"), KEYS).join(window, [*KEYS, "ts"], "left_semi")
    full = materialise(feature(bars, SERIES), "full")
    judged = _compare(cuts, in_prefix, window.join(full, [*SERIES, "ts"]), atol)
    # values of rows before the window: as many as the whole has, which may leave rows out
    has_value = full.select(*SERIES, "ts", F.lit(1.0).alias("_one"))
    counted = with_running(numbered.select(*SERIES, "ts", "_position").join(has_value, [*SERIES, "ts"], "left"), SERIES, "ts", "_one", "_sum", "_values")
    edge = counted.select(*SERIES, (F.col("_position") + shown).alias(CUT), F.col("_values").cast("bigint").alias("_values"))
    return judged.join(edge, KEYS, "left").withColumn("compared", F.col("compared") + F.coalesce("_values", F.lit(0))).drop("_values")


def _compare_steps(bars: DataFrame, feature: Stepped, cuts: DataFrame, atol: float) -> DataFrame:
    """Check once that every value follows from the state before it; a cut counts the rows up to it that fail."""
    traced = with_previous(feature.trace(bars, SERIES), SERIES, "ts", {f"_before{c}": c for c in feature.states})
    alone = feature.step(F.col("x"), {c: F.col(f"_before{c}") for c in feature.states})
    steps = traced.select(*SERIES, "ts", alone.alias("prefix_value"), F.col("value").cast("double").alias("full_value"))
    steps = steps.withColumn("_fails", F.when(~_near(F.col("prefix_value"), F.col("full_value"), atol), 1.0))
    steps = materialise(steps, "steps")
    counted = with_running(steps.select(*SERIES, "ts", "_fails"), SERIES, "ts", "_fails", "_sum", "differing")
    first = steps.where("_fails IS NOT NULL").groupBy(*SERIES).agg(
        F.min("ts").alias("first_bad_ts"), F.min_by("prefix_value", "ts").alias("prefix_value"), F.min_by("full_value", "ts").alias("full_value")
    )
    found = cuts.join(counted.withColumnRenamed("ts", "cut_ts").drop("_fails", "_sum"), [*SERIES, "cut_ts"]).join(first, SERIES, "left")
    reached = F.col("first_bad_ts") <= F.col("cut_ts")
    return found.select(
        *KEYS,
        "cut_ts",
        F.col(CUT).alias("compared"),
        F.col("differing").cast("bigint").alias("differing"),
        F.lit(0).cast("bigint").alias("one_sided"),
        *[F.when(reached, F.col(c)).alias(c) for c in ("first_bad_ts", "prefix_value", "full_value")],
    )


def looking_ahead(compared: DataFrame) -> DataFrame:
    """The cuts at which a feature is not what its prefix alone gives."""
    return compared.where("differing > 0 OR one_sided > 0")


def assert_causal(
    bars: DataFrame, feature: Feature, positions: Sequence[int] | None = None, atol: float = 0.0
) -> None:
    """AssertionError for the earliest cut at which the feature needs later rows."""
    earliest = looking_ahead(compare_prefixes(bars, feature, positions, atol)).orderBy(CUT, *SERIES).head(1)
    for r in earliest:
        series = f"{r['symbol']}_{r['timeframe']}"
        if r["one_sided"]:
            raise AssertionError(f"{series}, first {r[CUT]} rows: {r['one_sided']} rows differ in length from the whole")
        raise AssertionError(
            f"{series}, first {r[CUT]} rows: lookahead, {r['prefix_value']!r} alone and {r['full_value']!r} with what "
            f"follows, from {r['first_bad_ts']}"
        )


def is_causal(
    bars: DataFrame, feature: Feature, positions: Sequence[int] | None = None, atol: float = 0.0
) -> bool:
    return looking_ahead(compare_prefixes(bars, feature, positions, atol)).isEmpty()
