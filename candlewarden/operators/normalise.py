"""Typed rows to canonical bars, with a count of every row left out.

Rows without a valid timestamp go first, then rows without all four prices; then equal rows collapse
to their first line, and of different rows with one timestamp the first line is kept. Nothing is
filled or repaired except that missing counts become 0, and those are counted too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values, with_previous
from candlewarden.schema import COUNTS, PRICES, SERIES, VALUES

CONFLICT_GROUPS_SHOWN = 20


def with_reason(typed: DataFrame) -> DataFrame:
    """``reject`` is 'ts', 'ohlc' or NULL; a row bad in both counts only as 'ts'."""
    no_price = F.lit(False)
    for c in PRICES:
        no_price = no_price | F.col(c).isNull() | F.isnan(c)
    return typed.withColumn(
        "reject", F.when(F.col("ts").isNull(), "ts").when(no_price, "ohlc")
    )


def fill_counts(rows: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return rows.select(
        *SERIES, "line_no", "ts", *PRICES, *[F.coalesce(F.col(c), zero).alias(c) for c in COUNTS]
    )


def usable(typed: DataFrame) -> DataFrame:
    return fill_counts(with_reason(typed).where(F.col("reject").isNull()))


def exact_groups(rows: DataFrame) -> DataFrame:
    """Equal rows as one: first line and number of copies. Copies collapse before the shuffle."""
    return rows.groupBy(*SERIES, "ts", *VALUES).agg(
        F.min("line_no").alias("line_no"), F.count(F.lit(1)).alias("copies")
    )


def resolve(rows: DataFrame) -> DataFrame:
    """One row per timestamp, the first line winning, with how many rows and variants it stands for.

    ``min_by`` over the line number has map-side partial results, so a timestamp with very many
    variants is reduced in every task before its group meets.
    """
    return (
        exact_groups(rows)
        .groupBy(*SERIES, "ts")
        .agg(
            *[F.min_by(c, "line_no").alias(c) for c in VALUES],
            F.min("line_no").alias("_line"),
            F.sum("copies").alias("copies"),
            F.count(F.lit(1)).alias("variants"),
        )
        .withColumnRenamed("_line", "line_no")
    )


def canonical(resolved: DataFrame) -> DataFrame:
    return resolved.select(*SERIES, "ts", *VALUES, "line_no")


def exact_duplicates(rows: DataFrame) -> DataFrame:
    """Rows that occur more than once with equal values."""
    return exact_groups(rows).where(F.col("copies") > 1)


def conflicting_rows(rows: DataFrame) -> DataFrame:
    """Every variant of a timestamp that has several, as flat rows; the kept one is marked."""
    groups = exact_groups(rows)
    several = (
        groups.groupBy(*SERIES, "ts")
        .agg(F.count(F.lit(1)).alias("variants"), F.min("line_no").alias("_kept"))
        .where(F.col("variants") > 1)
    )
    # salted, as one timestamp may have any number of variants
    placed = join_series_values(groups, several, [*SERIES, "ts"], "line_no").where("variants IS NOT NULL")
    return placed.selectExpr(*SERIES, "ts", "line_no", *VALUES, "line_no = _kept AS kept")


def conflict_examples(rows: DataFrame, groups: int = CONFLICT_GROUPS_SHOWN) -> DataFrame:
    """All rows of the first conflicting timestamps of each series."""
    conflicts = conflicting_rows(rows)
    order = Window.partitionBy(*SERIES).orderBy("ts")
    shown = (
        conflicts.where(F.col("kept"))
        .select(*SERIES, "ts", F.row_number().over(order).alias("group_no"))
        .where(F.col("group_no") <= groups)
    )
    return join_series_values(conflicts, shown, [*SERIES, "ts"], "line_no").where("group_no IS NOT NULL")


def reordered(bars: DataFrame) -> DataFrame:
    """Series whose surviving rows do not ascend in file order."""
    linked = with_previous(bars.select(*SERIES, "line_no", "ts"), SERIES, "line_no", {"prev_ts": "ts"})
    return linked.groupBy(*SERIES).agg((F.count_if(F.col("ts") < F.col("prev_ts")) > 0).alias("reordered"))


def normalisation_log(typed: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """One row per series with every counter; pass the stored ``resolved`` rows to avoid redoing them."""
    judged = with_reason(typed)
    taken = judged.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("reject") == "ts").alias("dropped_unparseable_timestamp"),
        F.count_if(F.col("reject") == "ohlc").alias("dropped_nan_ohlc"),
        *[
            F.count_if(F.col("reject").isNull() & F.col(c).isNull()).alias(f"filled_{c}")
            for c in COUNTS
        ],
    )
    resolved = resolve(usable(typed)) if resolved is None else resolved
    kept = resolved.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.sum(F.col("copies") - F.col("variants")).alias("exact_duplicates_removed"),
        F.count_if(F.col("variants") > 1).alias("conflicting_duplicate_groups"),
        F.sum(F.col("variants") - 1).alias("conflicting_duplicate_rows_removed"),
    )
    counted = taken.join(kept, SERIES, "left").join(reordered(resolved), SERIES, "left")
    zero = F.lit(0).cast("bigint")
    numbers = [
        "rows_in",
        "rows_out",
        "dropped_unparseable_timestamp",
        "dropped_nan_ohlc",
        "exact_duplicates_removed",
        "conflicting_duplicate_groups",
        "conflicting_duplicate_rows_removed",
        *[f"filled_{c}" for c in COUNTS],
    ]
    return counted.select(
        *SERIES,
        *[F.coalesce(c, zero).alias(c) for c in numbers],
        F.coalesce("reordered", F.lit(False)).alias("reordered"),
    )
