"""Bars and raw lines derived from the ``events`` table, the inputs of the registered queries.

One pass over the events builds 15-minute partial bars per event type. All other bars (30 and 60
minutes, and the ``ALL`` symbol) are built from those partials, so the events are shuffled only after
they have been reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values, with_position
from candlewarden.functions.session import materialise
from candlewarden.functions.times import floor_to, order_key
from candlewarden.operators import parse
from candlewarden.operators.parse import BOM
from candlewarden.schema import CANONICAL, SERIES, TIMEFRAME_MINUTES

BAR_COLUMNS = SERIES + CANONICAL


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a time; those without cannot be put into any bar."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("ts").isNotNull())


def _reduce(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Merge ticks or partial bars into one bar per key; first and last are decided by tick order."""
    measures = {
        "first_key": "min(first_key)",
        "last_key": "max(last_key)",
        "open": "min_by(open, first_key)",
        "high": "max(high)",
        "low": "min(low)",
        "close": "max_by(close, last_key)",
        "tick_volume": "sum(tick_volume)",
        "volume": "sum(volume)",
        "spread": "min(spread)",
    }
    return rows.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in measures.items()])


def _ticks(events: DataFrame, symbol: str, minutes: int) -> DataFrame:
    keyed = events.withColumn("_key", order_key("ts", "event_id"))
    return keyed.selectExpr(
        f"{symbol} AS symbol",
        f"window(ts, '{minutes} minutes').start AS ts",
        "_key AS first_key",
        "_key AS last_key",
        *[f"value AS {c}" for c in ("open", "high", "low", "close")],
        "1L AS tick_volume",
        "user_id % 7 AS volume",
        "event_id % 40 AS spread",
    )


def bars(events: DataFrame) -> DataFrame:
    """Bars of every event type and of ``ALL``, on M15, M30 and H1."""
    quarter = _reduce(_ticks(events, "upper(event_type)", 15), ["symbol", "ts"])
    frames = ", ".join(f"struct('{tf}' AS timeframe, {m} AS minutes)" for tf, m in TIMEFRAME_MINUTES.items())
    fanned = (
        quarter.withColumn("symbol", F.expr("explode(array(symbol, 'ALL'))"))
        .selectExpr("*", f"inline(array({frames}))")
        .withColumn("ts", floor_to("ts", "minutes"))
    )
    return _reduce(fanned, ["symbol", "timeframe", "ts"]).select(*BAR_COLUMNS)


def bars_of(events: DataFrame, symbol: str, timeframe: str, minutes: int) -> DataFrame:
    """Bars of one timeframe for an arbitrary symbol expression."""
    made = _reduce(_ticks(events, symbol, minutes), ["symbol", "ts"])
    return made.withColumn("timeframe", F.lit(timeframe)).select(*BAR_COLUMNS)


def bars_user(events: DataFrame) -> DataFrame:
    """H1 bars per user: sparse series with every kind of gap."""
    return bars_of(events, "string(user_id)", "H1", 60)


def bars_session(all_bars: DataFrame) -> DataFrame:
    """Market-like week: ``ALL`` H1 bars from Monday 01:00 to Friday, with a nightly break."""
    hourly = all_bars.where((F.col("symbol") == "ALL") & (F.col("timeframe") == "H1"))
    return hourly.where((F.weekday("ts") < 5) & (F.hour("ts") >= 1))


def bars_h1_changed(all_bars: DataFrame) -> DataFrame:
    """``bars`` with known differences planted in the H1 highs."""
    planted = (F.col("timeframe") == "H1") & (F.hour("ts") % 11 == 3)
    return all_bars.withColumn("high", F.when(planted, F.col("high") + 5).otherwise(F.col("high")))


def bars_bad(all_bars: DataFrame) -> DataFrame:
    """Bars of all timeframes with one kind of damage on every fiftieth row each, under symbols ending in ``_BAD``."""
    placed = with_position(all_bars, SERIES, "ts", "_rn")
    return placed.selectExpr("*", "_rn % 50 AS turn").selectExpr(
        "concat(symbol, '_BAD') AS symbol",
        "timeframe",
        "CASE WHEN turn = 3 THEN ts + INTERVAL '7' MINUTE ELSE ts END AS ts",
        "CASE WHEN turn = 2 THEN 0D ELSE open END AS open",
        "CASE WHEN turn = 1 THEN low - 1 ELSE high END AS high",
        "low",
        "CASE WHEN turn = 5 THEN close * 3 ELSE close END AS close",
        "tick_volume",
        "volume",
        "CASE WHEN turn = 4 THEN -1L ELSE spread END AS spread",
    )


def judged_bars(events: DataFrame) -> DataFrame:
    """Everything the checks should see: regular, damaged and market-like series.

    The bars are written once, as three branches read them.
    """
    regular = materialise(bars(events), "bars")
    session = bars_session(regular).withColumn("symbol", F.lit("SESSION"))
    return regular.unionByName(bars_bad(regular)).unionByName(session)


HEADER = ["<DATE>", "<TIME>", "<OPEN>", "<HIGH>", "<LOW>", "<CLOSE>", "<TICKVOL>", "<VOL>", "<SPREAD>"]
DELIMITER = "CASE symbol WHEN 'CLICK' THEN ',' WHEN 'ERROR' THEN ';' ELSE '\\t' END"
# room between two positions for the copies of a row, and a shift that puts a row behind all others
COPIES = 4
BEHIND = 1 << 40
# the damage: which rows are repeated, repeated with another close, given a bad month or no open
COPY_LIST = "array_compact(array(0, CASE WHEN rn % 97 = 5 THEN 1 END, CASE WHEN rn % 101 = 7 THEN 2 END))"
BAD_MONTH = "(rn % 113 = 3 OR rn % 151 = 17)"
NO_OPEN = "(rn % 127 = 11 OR rn % 151 = 17)"
CELLS = [
    f"CASE WHEN {BAD_MONTH} THEN date_format(ts, 'yyyy.13.dd') ELSE date_format(ts, 'yyyy.MM.dd') END",
    "date_format(ts, 'HH:mm:ss')",
    f"CASE WHEN {NO_OPEN} THEN '' ELSE string(open) END",
    "high",
    "low",
    "CASE WHEN copy = 2 THEN close + 1 ELSE close END",
    "CASE WHEN rn % 89 = 8 THEN '' ELSE string(tick_volume) END",
    "volume",
    "CASE WHEN rn % 83 = 6 THEN 'x' ELSE string(spread) END",
]


def _header(broken: str | None, blank: str | None) -> str:
    def line(cells: list[str]) -> str:
        return f"concat_ws({DELIMITER}, {', '.join(repr(c) for c in cells)})"

    swapped = [HEADER[1], HEADER[0], *HEADER[2:]]
    head = f"CASE WHEN symbol = '{broken}' THEN {line(swapped)} ELSE {line(HEADER)} END" if broken else line(HEADER)
    head = f"CASE WHEN symbol = '{blank}' THEN '  ' ELSE {head} END" if blank else head
    return f"concat(CASE WHEN symbol = 'PURCHASE' THEN '{BOM}' ELSE '' END, {head})"


def raw_lines(events: DataFrame, broken_header: str | None = None, blank_header: str | None = None) -> DataFrame:
    """All bars as the text lines of one export file per series, with duplicates, conflicts and faults.

    Columns file, line_no, value. ``broken_header`` names a symbol whose header has two columns swapped, ``blank_header``
    one whose files begin with a white line.
    """
    made = materialise(bars(events), "made")
    rows = with_position(made, SERIES, "ts", "rn").selectExpr("*", f"explode({COPY_LIST}) AS copy")
    spread_out = f"rn * {COPIES} + copy + CASE WHEN rn % 131 = 13 THEN {BEHIND}L ELSE 0L END AS place"
    placed = with_position(rows.selectExpr("*", spread_out), SERIES, "place", "_position")
    body = placed.selectExpr(
        *SERIES, "_position + 1 AS line_no", f"concat_ws({DELIMITER}, {', '.join(CELLS)}) AS value"
    )
    names = files(made)
    named = join_series_values(body, names, SERIES, "line_no").select("file", "line_no", "value")
    return named.unionByName(names.selectExpr("file", "1L AS line_no", f"{_header(broken_header, blank_header)} AS value"))


def files(made: DataFrame) -> DataFrame:
    """(symbol, timeframe, file): export names declaring the day of the first bar and the last bar."""
    name = "concat(symbol, '_', timeframe, '_', date_format(min(ts), 'yyyyMMdd'), '0000_', date_format(max(ts), 'yyyyMMddHHmm'), '.csv')"
    return made.groupBy(*SERIES).agg(F.expr(f"{name} AS file"))


def typed(events: DataFrame) -> DataFrame:
    """Typed rows of ``raw_lines`` with symbol, timeframe and timestamp, written once like an ingest does."""
    return typed_lines(materialise(raw_lines(events), "lines"))


def typed_lines(lines: DataFrame) -> DataFrame:
    delimited = parse.with_delimiters(lines, parse.header_audit(lines))
    rows = parse.with_ts(parse.typed_rows(delimited, "delimiter"))
    return materialise(parse.with_identity(rows), "typed")
