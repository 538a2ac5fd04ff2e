"""Which periods each series covers, and which tiers of timeframes exist together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.functions.times import MICROS_PER_DAY, micros_between
from candlewarden.schema import SERIES, TIER_MEMBERS


def coverage(bars: DataFrame) -> DataFrame:
    return bars.groupBy(*SERIES).agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("rows")
    )


def require_coverage(bars: DataFrame) -> DataFrame:
    """``coverage`` that refuses an empty table."""
    if bars.isEmpty():
        raise ValueError("an empty table has no coverage")
    return coverage(bars)


def coverage_tiers(covered: DataFrame, tiers: dict[str, list[str]] | None = None) -> DataFrame:
    """Common period of each tier, for symbols that have every member timeframe."""
    tiers = TIER_MEMBERS if tiers is None else tiers
    tier_rows = F.array(
        *[
            F.struct(
                F.lit(tier).alias("tier"),
                F.lit("+".join(members)).alias("timeframes"),
                F.array(*[F.lit(m) for m in members]).alias("members"),
            )
            for tier, members in tiers.items()
        ]
    )
    member = covered.select("*", F.inline(tier_rows)).where(F.array_contains("members", F.col("timeframe")))
    common = (
        member.groupBy("symbol", "tier", "timeframes")
        .agg(
            F.max("start_ts").alias("start_ts"),
            F.min("end_ts").alias("end_ts"),
            F.count(F.lit(1)).alias("_have"),
            F.first(F.size("members")).alias("_need"),
        )
        .where(F.col("_have") == F.col("_need"))
    )
    valid = F.col("start_ts") <= F.col("end_ts")
    days = micros_between("start_ts", "end_ts") / F.lit(float(MICROS_PER_DAY))
    return common.select(
        "symbol",
        "tier",
        "timeframes",
        "start_ts",
        "end_ts",
        valid.alias("valid"),
        F.when(valid, days).otherwise(F.lit(0.0)).alias("span_days"),
    )
