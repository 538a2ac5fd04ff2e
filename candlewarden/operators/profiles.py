"""Analyses of stored series: spreads and volumes by year, gap profiles, declared against actual ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.functions.quantiles import exact_quantiles, wide
from candlewarden.schema import SERIES

MEDIAN = {"spread": [0.5]}


def spread_by_year(bars: DataFrame) -> DataFrame:
    """Share of zero spreads and median spread per series and year."""
    keys = [*SERIES, "year"]
    dated = bars.withColumn("year", F.year("ts"))
    shares = dated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("spread") == 0).alias("zero_spreads")
    )
    medians = wide(exact_quantiles(dated, keys, {"spread": "spread"}, MEDIAN), keys, MEDIAN)
    return shares.join(medians, keys, "left").select(
        *keys,
        "rows",
        "zero_spreads",
        (F.col("zero_spreads") / F.col("rows")).alias("zero_share"),
        F.col("spread_p50").alias("median_spread"),
    )


def gap_resume_profile(gaps: DataFrame) -> DataFrame:
    """How often gaps of each kind start and end at which weekday and hour."""
    return gaps.groupBy(
        *SERIES,
        "kind",
        F.weekday("gap_start").alias("start_weekday"),
        F.hour("gap_start").alias("start_hour"),
        F.weekday("gap_end").alias("end_weekday"),
        F.hour("gap_end").alias("end_hour"),
    ).agg(F.count(F.lit(1)).alias("gaps"))


def volume_by_year(bars: DataFrame) -> DataFrame:
    """Rows with a volume per series and year."""
    return bars.groupBy(*SERIES, F.year("ts").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("volume") != 0).alias("nonzero_rows")
    )




def flag_provisional(bars: DataFrame) -> DataFrame:
    """Mark the last bar of each series, which was still forming at export time.

    The last timestamps join on (series, ts), so no series has to pass through one window.
    """
    last = bars.groupBy(*SERIES).agg(F.max("ts").alias("ts")).withColumn("_last", F.lit(True))
    return bars.join(last, [*SERIES, "ts"], "left").select(
        *bars.columns, F.coalesce("_last", F.lit(False)).alias("provisional")
    )


def trim_provisional(bars: DataFrame) -> DataFrame:
    """Bars without the last one of each series; an explicit choice, never done by default."""
    return flag_provisional(bars).where(~F.col("provisional")).drop("provisional")


def declared_vs_actual(identity: DataFrame, covered: DataFrame) -> DataFrame:
    """The range a file name declares next to the range its bars cover."""
    def declared(c: str):
        # 202401022300 -> 2024-01-02 23:00:00
        dashed = F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:00")
        return dashed.try_cast("timestamp_ntz")

    joined = identity.join(covered, SERIES, "left")
    start, end = declared("declared_start"), declared("declared_end")
    return joined.select(
        *SERIES,
        start.alias("declared_start"),
        end.alias("declared_end"),
        F.col("start_ts").alias("actual_start"),
        F.col("end_ts").alias("actual_end"),
        F.coalesce(start == F.col("start_ts"), F.lit(False)).alias("start_matches"),
        F.coalesce(end == F.col("end_ts"), F.lit(False)).alias("end_matches"),
    )


def export_cap_evidence(covered: DataFrame) -> DataFrame:
    """Per symbol: do its series end within one bar of each other with nearly equal row counts?"""
    return covered.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("series"),
        F.min("end_ts").alias("earliest_end"),
        F.max("end_ts").alias("latest_end"),
        F.count_distinct("start_ts").alias("distinct_starts"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        (F.min("rows") / F.max("rows")).alias("row_ratio"),
    )


