"""Integrity checks over canonical bars, for all series at once.

Four passes cover every check:

* ``profile``: one fused aggregate for all checks that look at single rows;
* ``ordered_facts``: one chunked window for gaps, steps, order, duplicates and price jumps;
* ``value_counts``: one table of value counts for the exact quantiles;
* ``examples``: the first violating rows of each check.

``order`` says what the frame order is. Canonical bars are ordered by ``ts``, which is unique in a
series. A frame that is not canonical yet is ordered by ``line_no``, its order in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values
from candlewarden.functions.quantiles import prob_name, quantiles_of_counts, value_counts, wide
from candlewarden.functions.session import materialise
from candlewarden.functions.times import minute_of_day_sql
from candlewarden.operators import gaps as g
from candlewarden.schema import CANONICAL, MINUTES_SQL, PRICES, SERIES, missing_columns

# Thresholds, example counts and the order in which checks are reported.
JUMP_FACTOR = 12.0
EXTREME_FACTOR = 5
EXTREME_FLOOR = 1
EXAMPLES = 10
FEW_EXAMPLES = 5
SPREAD_PROBS = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
TICK_VOLUME_PROBS = [0.01, 0.5, 0.99]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
OHLC_RULES = {
    "high_lt_low": ("high", "low"),
    "high_lt_open": ("high", "open"),
    "high_lt_close": ("high", "close"),
    "low_gt_open": ("open", "low"),
    "low_gt_close": ("close", "low"),
}
CHECKS = [
    "schema",
    "row_count",
    "timestamp_order",
    "duplicate_timestamps",
    "grid_alignment",
    "frequency_and_gaps",
    "ohlc_integrity",
    "price_positivity",
    "zero_range_candles",
    "spread",
    "volume",
    "weekday_distribution",
    "hour_distribution",
    "price_jumps",
]


def less(a: str, b: str) -> str:
    """``a < b``, false for NaN, which Spark orders above every number."""
    return f"({a} < {b} AND NOT isnan({a}) AND NOT isnan({b}))"


# row-local violations; a fraction of a second is not looked at by the grid check
# and every bar of a timeframe that is not known is off the grid
OFF_GRID = f"(coalesce({minute_of_day_sql('ts')} % {MINUTES_SQL}, 1) <> 0 OR second(ts) <> 0)"
BAD_OHLC = "(" + " OR ".join(less(a, b) for a, b in OHLC_RULES.values()) + ")"
BAD_PRICE = "(" + " OR ".join(f"{c} IS NULL OR isnan({c}) OR {c} <= 0 OR {c} = double('inf')" for c in PRICES) + ")"
ZERO_RANGE = "(high = low AND NOT isnan(high))"


def _without_values(columns: list[str]) -> Column:
    """Names of the columns in which no row of a series has a value, as an aggregate.

    Where files of several series are read together, a column that the files of one series lack is null there.
    """
    return F.concat_ws(",", F.array_compact(F.array(*[F.when(F.count(c) == 0, F.lit(c)) for c in columns])))


def profile(bars: DataFrame, order: str = "ts") -> DataFrame:
    """All row-local counts of every series in one pass with map-side aggregation; first and last in frame order."""
    counted = {
        "off_grid": OFF_GRID,
        **{name: less(a, b) for name, (a, b) in OHLC_RULES.items()},
        "ohlc_violations": BAD_OHLC,
        "bad_prices": BAD_PRICE,
        "zero_range": ZERO_RANGE,
        "spread_negative": "spread < 0",
        "spread_zero": "spread = 0",
        "tick_volume_zero": "tick_volume = 0",
        "tick_volume_negative": "tick_volume < 0",
        "volume_nonzero_rows": "volume <> 0",
        **{day: f"weekday(ts) = {i}" for i, day in enumerate(WEEKDAYS)},
    }
    return bars.groupBy(*SERIES).agg(
        F.expr("count(1) AS rows"),
        F.expr(f"min_by(ts, {order}) AS first_ts"),
        F.expr(f"max_by(ts, {order}) AS last_ts"),
        F.expr("bit_count(bit_or(shiftleft(1, hour(ts)))) AS hours_with_data"),
        F.expr("min(hour(ts)) AS first_hour"),
        F.expr("sum(spread) AS _spread_sum"),
        F.expr("count(spread) AS _spread_rows"),
        _without_values([c for c in CANONICAL if c in bars.columns]).alias("missing"),
        *[F.expr(f"count_if({condition}) AS {name}") for name, condition in counted.items()],
    )


def hour_counts(bars: DataFrame) -> DataFrame:
    """(symbol, timeframe, hour, bars) with all 24 hours of every series."""
    seen = bars.groupBy(*SERIES, F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("bars"))
    per_series = seen.groupBy(*SERIES).agg(
        F.map_from_entries(F.collect_list(F.struct("hour", "bars"))).alias("_by_hour")
    )
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    return per_series.select(*SERIES, "_by_hour", hours).select(
        *SERIES,
        "hour",
        F.coalesce(F.try_element_at("_by_hour", F.col("hour")), F.lit(0).cast("bigint")).alias("bars"),
    )


def duplicates(bars: DataFrame) -> DataFrame:
    """Rows that share a timestamp, and rows beyond the first of each; equal timestamps collapse map-side."""
    per_ts = bars.groupBy(*SERIES, "ts").agg(F.count(F.lit(1)).alias("_n"))
    return per_ts.groupBy(*SERIES).agg(
        F.expr("sum(_n - 1) AS duplicates"),
        F.expr("coalesce(sum(CASE WHEN _n > 1 THEN _n END), 0L) AS sharing_rows"),
    )


def timestamp_order(bars: DataFrame, order: str = "ts") -> DataFrame:
    """``monotonic`` in frame order plus duplicate counts; a frame ordered by ``ts`` cannot decrease."""
    counts = duplicates(bars)
    if order == "ts":
        return counts.withColumn("monotonic", F.lit(True))
    linked = g.steps(bars.select(*SERIES, "ts", order), order)
    falls = linked.groupBy(*SERIES).agg((F.count_if(F.col("delta_us") < 0) == 0).alias("monotonic"))
    return counts.join(falls, SERIES)


MEASURED = {"spread": "spread", "tick_volume": "tick_volume", "range": "nullif(high - low, 0)"}


def counts_of_values(bars: DataFrame, *metrics: str) -> DataFrame:
    """Counts of equal values of the wanted metrics, or of all."""
    return value_counts(bars, SERIES, {m: MEASURED[m] for m in metrics or MEASURED})


QUANTILES = {"spread": SPREAD_PROBS, "tick_volume": TICK_VOLUME_PROBS, "range": [0.5]}


def quantile_facts(counts: DataFrame, probs=None) -> DataFrame:
    probs = QUANTILES if probs is None else probs
    wanted = counts.where(F.col("metric").isin(list(probs)))
    return wide(quantiles_of_counts(wanted, SERIES, probs), SERIES, probs)


EXTREME_LIMIT = f"greatest(spread_p99 * {EXTREME_FACTOR}, double({EXTREME_FLOOR}))"


def extreme_spreads(counts: DataFrame, facts: DataFrame) -> DataFrame:
    """Bars above the extreme limit, counted from the value counts instead of a second scan."""
    limits = facts.selectExpr(*SERIES, f"{EXTREME_LIMIT} AS _limit")
    spreads = counts.where(F.col("metric") == "spread")
    judged = join_series_values(spreads, limits, SERIES, "value")
    return judged.groupBy(*SERIES).agg(
        F.expr("coalesce(sum(CASE WHEN value > _limit THEN n END), 0L) AS spread_extreme")
    )


def with_jumps(bars: DataFrame, typical: DataFrame, order: str = "ts", z: float = JUMP_FACTOR) -> DataFrame:
    """Steps with ``jump`` (open against the previous close), ``typical`` range and the ``is_jump`` flag."""
    linked = g.steps(bars, order, {"prev_close": "close"}, typical)
    jumped = linked.withColumn("jump", F.expr("abs(open - prev_close)"))
    return jumped.withColumn(
        "is_jump", F.expr(f"coalesce(jump > {float(z)}D * typical AND NOT isnan(jump), false)")
    )


def typical_range(facts: DataFrame) -> DataFrame:
    return facts.select(*SERIES, F.col("range_p50").alias("typical"))


def jump_counts() -> list[Column]:
    """Aggregates over steps with jumps; series shorter than three bars are not judged."""
    return [
        F.expr("CASE WHEN count(1) >= 3 THEN count_if(is_jump) END AS jumps"),
        F.expr("CASE WHEN count(1) >= 3 THEN max(typical) END AS median_range"),
    ]


def jump_facts(jumps: DataFrame) -> DataFrame:
    return jumps.groupBy(*SERIES).agg(*jump_counts())


def schema_check(bars: DataFrame, datasets: DataFrame) -> DataFrame:
    """Verdict on the columns for every dataset that should be there: FAIL and the canonical columns it misses.

    A column is missing if the table lacks it, or if it has no value in any row of the series. A series
    without rows is judged by the table alone; its row count fails elsewhere.
    """
    absent = missing_columns(bars)
    present = [c for c in CANONICAL if c not in absent]
    empty = bars.groupBy(*SERIES).agg(_without_values(present).alias("_empty"))
    named = F.concat_ws(",", F.lit(",".join(absent) or None), F.when(F.col("_empty") != "", F.col("_empty")))
    judged = datasets.select(*SERIES).join(empty, SERIES, "left").select(*SERIES, named.alias("missing"))
    return judged.select(*SERIES, F.when(F.col("missing") != "", "FAIL").otherwise("PASS").alias("status"), "missing")


def facts(bars: DataFrame, order: str = "ts", z: float = JUMP_FACTOR) -> DataFrame:
    """Every number the checks need, one row per series.

    The value counts and the quantiles have several readers each, so they are written once.
    """
    counts = materialise(counts_of_values(bars), "value_counts")
    quantiles = materialise(quantile_facts(counts), "quantiles")
    jumps = with_jumps(bars, typical_range(quantiles), order, z)
    parts = [
        quantiles,
        extreme_spreads(counts, quantiles),
        jumps.groupBy(*SERIES).agg(*g.frequency_counts(), *jump_counts()).drop("rows"),
        timestamp_order(bars, order),
    ]
    out = profile(bars, order)
    for part in parts:
        out = out.join(part, SERIES, "left")
    derived = {
        "spread_mean": "_spread_sum / _spread_rows",
        "zero_range_fraction": "zero_range / rows",
        "volume_all_zero": "int(volume_nonzero_rows = 0)",
        "expected_step_minutes": MINUTES_SQL,
    }
    return out.withColumns({name: F.expr(sql) for name, sql in derived.items()})


def _fail_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'FAIL' ELSE 'PASS' END"


# status and summary of every check as SQL over a row of ``facts``
STATUS = {
    "schema": _fail_if("missing <> ''"),
    "row_count": "'INFO'",
    "timestamp_order": _fail_if("duplicates > 0 OR NOT monotonic"),
    "duplicate_timestamps": _fail_if("sharing_rows > 0"),
    "grid_alignment": _fail_if("off_grid > 0"),
    "frequency_and_gaps": f"""CASE WHEN rows < 2 OR sub_step > 0 OR {MINUTES_SQL} IS NULL THEN 'FAIL'
                                  WHEN gap_count > 0 THEN 'WARN' ELSE 'PASS' END""",
    "ohlc_integrity": _fail_if("ohlc_violations > 0"),
    "price_positivity": _fail_if("bad_prices > 0"),
    "zero_range_candles": "CASE WHEN zero_range > 0 THEN 'WARN' ELSE 'INFO' END",
    "spread": """CASE WHEN spread_negative > 0 THEN 'FAIL'
                      WHEN spread_zero > 0 OR spread_extreme > 0 THEN 'WARN' ELSE 'PASS' END""",
    "volume": "'INFO'",
    "weekday_distribution": "CASE WHEN sat + sun > 0 THEN 'WARN' ELSE 'PASS' END",
    "hour_distribution": "'INFO'",
    "price_jumps": "CASE WHEN jumps > 0 THEN 'WARN' ELSE 'INFO' END",
}


def _text(**numbers: str) -> str:
    """``label=number`` for each pair; a missing number reads ``none``."""
    cells = [f"'{label.replace('_', ' ')}=', coalesce(string({c}), 'none')" for label, c in numbers.items()]
    return "concat(" + ", ' ', ".join(cells) + ")"


INSTANT = "'yyyy-MM-dd HH:mm:ss'"
SUMMARY = {
    "schema": "CASE WHEN missing <> '' THEN concat('missing canonical columns: ', missing) ELSE 'no column missing' END",
    "row_count": f"""concat(rows, ' rows from ', date_format(first_ts, {INSTANT}),
                            ' to ', date_format(last_ts, {INSTANT}))""",
    "timestamp_order": _text(duplicates="duplicates"),
    "duplicate_timestamps": _text(rows_sharing_a_timestamp="sharing_rows"),
    "grid_alignment": _text(off_grid="off_grid"),
    "frequency_and_gaps": f"""CASE WHEN {MINUTES_SQL} IS NULL THEN concat('unknown timeframe ', timeframe)
        WHEN rows < 2 THEN 'not enough bars for a step'
        ELSE concat('exact_step=', exact_step, ' sub_step=', sub_step, ' gaps=', gap_count) END""",
    "ohlc_integrity": _text(violations="ohlc_violations"),
    "price_positivity": _text(bad_prices="bad_prices"),
    "zero_range_candles": _text(zero_range="zero_range"),
    "spread": _text(negative="spread_negative", zero="spread_zero", extreme="spread_extreme"),
    "volume": """concat('tick_volume zero=', tick_volume_zero, ' negative=', tick_volume_negative,
                        ' volume nonzero=', volume_nonzero_rows)""",
    "weekday_distribution": _text(sat="sat", sun="sun"),
    "hour_distribution": _text(hours="hours_with_data", first="first_hour"),
    "price_jumps": "CASE WHEN jumps IS NULL THEN 'not enough bars to judge' ELSE concat('jumps=', jumps) END",
}


def status_of(check: str) -> Column:
    """Status of one check from a row of ``facts``."""
    return F.expr(STATUS[check])


METRICS = {
    "row_count": ["rows"],
    "timestamp_order": ["duplicates"],
    "duplicate_timestamps": ["sharing_rows"],
    "grid_alignment": ["off_grid"],
    "frequency_and_gaps": [
        "expected_step_minutes",
        "exact_step",
        "sub_step",
        "gap_count",
        *[f"gaps_{k}" for k in g.GAP_KINDS],
        "missing_bars_total",
        "missing_bars_non_weekend",
    ],
    "ohlc_integrity": [*OHLC_RULES, "ohlc_violations"],
    "price_positivity": ["bad_prices"],
    "zero_range_candles": ["zero_range", "zero_range_fraction"],
    "spread": [
        "spread_negative",
        "spread_zero",
        "spread_extreme",
        "spread_mean",
        *[f"spread_{prob_name(p)}" for p in SPREAD_PROBS],
    ],
    "volume": [
        "tick_volume_zero",
        "tick_volume_negative",
        "volume_nonzero_rows",
        "volume_all_zero",
        *[f"tick_volume_{prob_name(p)}" for p in TICK_VOLUME_PROBS],
    ],
    "weekday_distribution": WEEKDAYS,
    "hour_distribution": ["hours_with_data", "first_hour"],
    "price_jumps": ["jumps", "median_range"],
}


def _metrics_sql(check: str) -> str:
    names = METRICS.get(check, [])
    if not names:
        return "CAST(NULL AS MAP<STRING, DOUBLE>)"
    return "map(" + ", ".join(f"'{n}', double({n})" for n in names) + ")"


def run_all(
    bars: DataFrame,
    order: str = "ts",
    z: float = JUMP_FACTOR,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """All checks of all series: (symbol, timeframe, position, check_name, status, summary, metrics).

    ``datasets`` lists the series that should exist; one without bars fails on its row count and gets
    no further checks. A table without the canonical columns fails on the schema in the same way, and so
    does a series in which one of them never has a value.
    """
    missing = missing_columns(bars)
    if missing:
        listed = bars.select(*SERIES).distinct() if datasets is None else datasets
        return _short(listed, "FAIL", "missing canonical columns: " + ", ".join(missing), bars)
    rows = ", ".join(
        f"struct({i} AS position, '{check}' AS check_name, {STATUS[check]} AS status, "
        f"{SUMMARY[check]} AS summary, {_metrics_sql(check)} AS metrics)"
        for i, check in enumerate(CHECKS, start=1)
    )
    results = facts(bars, order, z).selectExpr(*SERIES, "missing", f"inline(array({rows}))")
    results = results.where("missing = '' OR position <= 2").drop("missing")
    if datasets is None:
        # no bar at all names no series: one verdict for the empty frame, without a series
        empty = bars.limit(1).agg(F.count(F.lit(1)).alias("rows")).where("rows = 0")
        nothing = F.lit(None).cast("string")
        results = results.unionByName(
            _short(empty.select(nothing.alias("symbol"), nothing.alias("timeframe")), "PASS", "no column missing", None)
        )
    else:
        absent = datasets.select(*SERIES).join(bars.select(*SERIES).distinct(), SERIES, "left_anti")
        results = results.unionByName(_short(absent, "PASS", "no column missing", None))
    return results


def _short(series: DataFrame, schema_status: str, schema_summary: str, bars: DataFrame | None) -> DataFrame:
    """Schema and row count only."""
    if bars is None:
        sized = series.select(*SERIES).withColumn("rows", F.lit(0).cast("bigint"))
    else:
        counted = bars.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("rows"))
        sized = series.select(*SERIES).join(counted, SERIES, "left").na.fill(0, ["rows"])
    return sized.selectExpr(
        *SERIES,
        f"""inline(array(
            struct(1 AS position, 'schema' AS check_name, '{schema_status}' AS status,
                   '{schema_summary}' AS summary, CAST(NULL AS MAP<STRING, DOUBLE>) AS metrics),
            struct(2 AS position, 'row_count' AS check_name, CASE WHEN rows = 0 THEN 'FAIL' ELSE 'INFO' END AS status,
                   CASE WHEN rows = 0 THEN 'no bars' ELSE concat(rows, ' rows') END AS summary,
                   map('rows', double(rows)) AS metrics)))""",
    )


def overall(results: DataFrame) -> DataFrame:
    """Worst status per series; descriptive results count as passed."""
    rank = "max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)"
    worst = results.groupBy(*SERIES).agg(F.expr(f"{rank} AS _worst"))
    return worst.selectExpr(*SERIES, "element_at(array('PASS', 'WARN', 'FAIL'), _worst + 1) AS overall")


def first_rows(rows: DataFrame, keys: list[str], order: str, most: int, limit=None) -> DataFrame:
    """The first ``most`` rows of each group in frame order, and of these those within ``limit``.

    The constant bound lets Spark cut every group map-side, so a check that a third of all rows
    violates still sends only a few rows per task.
    """
    ranked = rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    ).where(F.col("rank") <= most)
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def _first_repeated(bars: DataFrame, order: str, n: int) -> DataFrame:
    """Rows of the timestamps that repeat first in frame order; the first examples are all among them."""
    per_ts = bars.groupBy(*SERIES, "ts").agg(
        F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first")
    )
    early = first_rows(per_ts.where("_n > 1"), SERIES, "_first", n)
    return bars.join(early.select(*SERIES, "ts"), [*SERIES, "ts"], "left_semi")


def examples(
    bars: DataFrame, order: str = "ts", z: float = JUMP_FACTOR, n: int = EXAMPLES, few: int = FEW_EXAMPLES
) -> DataFrame:
    """First ``n`` violating rows per series and check, in frame order; ``few`` for spreads and zero ranges."""
    quantiles = materialise(
        quantile_facts(counts_of_values(bars, "spread", "range"), {"spread": [0.99], "range": [0.5]}), "quantiles"
    )
    limits = quantiles.selectExpr(*SERIES, f"{EXTREME_LIMIT} AS _limit", "range_p50 AS typical")
    broken = with_jumps(bars, limits, order, z)
    flags = {
        "grid_alignment": OFF_GRID,
        "ohlc_integrity": BAD_OHLC,
        "price_positivity": BAD_PRICE,
        "zero_range_candles": ZERO_RANGE,
        "spread": "spread > _limit",
        "price_jumps": "is_jump",
    }
    named = ", ".join(f"CASE WHEN {cond} THEN '{check}' END" for check, cond in flags.items())
    kept = list(dict.fromkeys([*SERIES, *CANONICAL, order]))
    rows = broken.selectExpr(
        *kept, "prev_close", "jump", f"explode(array_compact(array({named}))) AS check_name"
    ).selectExpr(
        *kept,
        "check_name",
        "CASE WHEN check_name = 'price_jumps' THEN prev_close END AS prev_close",
        "CASE WHEN check_name = 'price_jumps' THEN jump END AS jump",
    )
    twice = _first_repeated(bars, order, n).selectExpr(
        *kept,
        "'duplicate_timestamps' AS check_name",
        "CAST(NULL AS DOUBLE) AS prev_close",
        "CAST(NULL AS DOUBLE) AS jump",
    )
    limit = F.when(F.col("check_name").isin("zero_range_candles", "spread"), few).otherwise(n)
    return first_rows(rows.unionByName(twice), [*SERIES, "check_name"], order, max(n, few), limit)
