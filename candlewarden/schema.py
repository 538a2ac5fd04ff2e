"""Column contracts of raw exports, canonical bars and the tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The export format and the canonical contract.
SCHEMA_VERSION = "1.0.0"
TIMEZONE_LABEL = "broker_server_time_naive"
RAW_COLUMNS = ["DATE", "TIME", "OPEN", "HIGH", "LOW", "CLOSE", "TICKVOL", "VOL", "SPREAD"]
FILE_NAME_PATTERN = r"^([A-Z0-9]+)_(M15|M30|H1)_(\d{12})_(\d{12})\.csv$"
TIMEFRAME_MINUTES = {"M15": 15, "M30": 30, "H1": 60}
TIER_MEMBERS = {
    "H1_only": ["H1"],
    "H1_M30": ["H1", "M30"],
    "H1_M30_M15": ["H1", "M30", "M15"],
}
TIMEFRAME_PAIRS = [("M15", "M30"), ("M30", "H1"), ("M15", "H1")]

# A series is one symbol on one timeframe; every operator is keyed by it.
SERIES = ["symbol", "timeframe"]
PRICES = ["open", "high", "low", "close"]
COUNTS = ["tick_volume", "volume", "spread"]
VALUES = PRICES + COUNTS
CANONICAL = ["ts"] + VALUES

BAR_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICES],
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("line_no", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
    ]
)


class ExportLayoutError(ValueError):
    """A raw file does not follow the export layout."""


# minutes per bar as a SQL expression over ``timeframe``; NULL outside the closed set
MINUTES_SQL = "CASE timeframe " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TIMEFRAME_MINUTES.items()) + " END"


def missing_columns(bars: DataFrame) -> list[str]:
    """Canonical columns that ``bars`` lacks (schema metadata only, no job)."""
    present = set(bars.columns)
    return [c for c in CANONICAL if c not in present]
