"""Gaps between consecutive bars of a series: size, missing bars and a descriptive kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.functions.chunks import with_previous
from candlewarden.functions.times import MICROS_PER_DAY, MICROS_PER_MINUTE, micros_between
from candlewarden.schema import MINUTES_SQL, SERIES

# The kinds and their limits. Weekdays count from Monday = 0.
GAP_KINDS = ["weekend", "daily_break", "intraweek", "extended"]
WEEKEND_FIRST_START = 4
WEEKEND_LAST_END = 1
WEEKEND_LIMIT_DAYS = 4
DAILY_LIMIT_DAYS = 1
INTRAWEEK_LIMIT_DAYS = 3


STEP = f"(CAST({MINUTES_SQL} AS BIGINT) * {MICROS_PER_MINUTE})"
# half-even, as the ratio can end in .5 for bars off the grid
MISSING = f"CAST(bround(delta_us / {STEP} - 1) AS BIGINT)"


def kind_sql(start: str, end: str) -> str:
    return f"""CASE
        WHEN weekday({start}) >= {WEEKEND_FIRST_START} AND weekday({end}) <= {WEEKEND_LAST_END}
             AND delta_us < {WEEKEND_LIMIT_DAYS * MICROS_PER_DAY} THEN 'weekend'
        WHEN delta_us < {DAILY_LIMIT_DAYS * MICROS_PER_DAY} THEN 'daily_break'
        WHEN delta_us < {INTRAWEEK_LIMIT_DAYS * MICROS_PER_DAY} THEN 'intraweek'
        ELSE 'extended' END"""


def steps(
    bars: DataFrame,
    order: str = "ts",
    carried: dict[str, str] | None = None,
    series_values: DataFrame | None = None,
) -> DataFrame:
    """Every bar with its predecessor: ``prev_ts``, ``delta_us`` and any other carried column."""
    columns = {"prev_ts": "ts", **(carried or {})}
    linked = with_previous(bars, SERIES, order, columns, series_values)
    return linked.withColumn("delta_us", micros_between("prev_ts", "ts"))


def gaps_of_steps(linked: DataFrame) -> DataFrame:
    """One row per step longer than the timeframe."""
    return linked.where(f"delta_us > {STEP}").selectExpr(
        *SERIES,
        "prev_ts AS gap_start",
        "ts AS gap_end",
        "delta_us",
        f"{MISSING} AS missing_bars",
        f"{kind_sql('prev_ts', 'ts')} AS kind",
    )


def classify_gaps(bars: DataFrame, order: str = "ts") -> DataFrame:
    return gaps_of_steps(steps(bars.select(*dict.fromkeys([*SERIES, "ts", order])), order))


def with_delta(gaps: DataFrame) -> DataFrame:
    """Add the gap length as an interval."""
    return gaps.withColumn("delta", F.col("gap_end") - F.col("gap_start"))


def gap_kind_counts(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy(*SERIES, "kind").agg(F.count(F.lit(1)).alias("gaps"))


def largest_gaps(gaps: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` longest gaps of each series; the earlier gap first among equals."""
    order = Window.partitionBy(*SERIES).orderBy(F.col("delta_us").desc(), F.col("gap_start").asc())
    return gaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def frequency_counts() -> list[Column]:
    """Aggregates over steps: rows, regular steps, steps too short, gaps and missing bars."""
    longer = f"delta_us > {STEP}"
    kind = f"CASE WHEN {longer} THEN {kind_sql('prev_ts', 'ts')} END"
    return [
        F.expr(sql).alias(name)
        for name, sql in {
            "rows": "count(1)",
            "exact_step": f"count_if(delta_us = {STEP})",
            "sub_step": f"count_if(delta_us < {STEP})",
            "gap_count": f"count_if({longer})",
            **{f"gaps_{k}": f"count_if(({kind}) = '{k}')" for k in GAP_KINDS},
            "missing_bars_total": f"sum(CASE WHEN {longer} THEN {MISSING} ELSE 0 END)",
            "missing_bars_non_weekend": f"coalesce(sum(CASE WHEN ({kind}) <> 'weekend' THEN {MISSING} END), 0L)",
        }.items()
    ]


def frequency(linked: DataFrame) -> DataFrame:
    """The frequency counts of every series."""
    return linked.groupBy(*SERIES).agg(*frequency_counts())
