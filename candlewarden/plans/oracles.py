"""The registered queries again in plain SQL over the same tables, for a second engine to check.

Fragments are joined into one WITH list per query. They repeat the derivation of bars and raw lines
from ``events`` independently of the Spark code.
"""

from __future__ import annotations

FRAMES = "frames AS (SELECT * FROM (VALUES ('M15', 15), ('M30', 30), ('H1', 60)) f(timeframe, minutes))"

BARS = (
    FRAMES
    + """,
ticks AS (SELECT upper(event_type) AS symbol, ts, event_id, user_id, value FROM events WHERE ts IS NOT NULL
          UNION ALL SELECT 'ALL', ts, event_id, user_id, value FROM events WHERE ts IS NOT NULL),
bars AS (SELECT t.symbol, f.timeframe, time_bucket(to_minutes(f.minutes), t.ts) AS ts,
                first(t.value ORDER BY t.ts, t.event_id) AS open, max(t.value) AS high, min(t.value) AS low,
                last(t.value ORDER BY t.ts, t.event_id) AS close, count(*) AS tick_volume,
                sum(t.user_id % 7)::BIGINT AS volume, min(t.event_id % 40) AS spread
         FROM ticks t CROSS JOIN frames f
         GROUP BY t.symbol, f.timeframe, time_bucket(to_minutes(f.minutes), t.ts))"""
)

USER_BARS = """bars_user AS (SELECT user_id::VARCHAR AS symbol, 'H1' AS timeframe,
         time_bucket(INTERVAL 60 MINUTE, ts) AS ts
         FROM events WHERE ts IS NOT NULL GROUP BY user_id, time_bucket(INTERVAL 60 MINUTE, ts))"""

CHANGED = (
    BARS
    + """,
changed AS (SELECT * REPLACE (CASE WHEN timeframe = 'H1' AND hour(ts) % 11 = 3 THEN high + 5 ELSE high END AS high)
            FROM bars)"""
)

JUDGED = (
    BARS
    + """,
turned AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY ts) % 50 AS turn FROM bars),
judged AS (SELECT * FROM bars
   UNION ALL
   SELECT symbol || '_BAD', timeframe, CASE WHEN turn = 3 THEN ts + INTERVAL 7 MINUTE ELSE ts END,
          CASE WHEN turn = 2 THEN 0 ELSE open END, CASE WHEN turn = 1 THEN low - 1 ELSE high END, low,
          CASE WHEN turn = 5 THEN close * 3 ELSE close END, tick_volume, volume,
          CASE WHEN turn = 4 THEN -1 ELSE spread END
   FROM turned
   UNION ALL
   SELECT 'SESSION', timeframe, ts, open, high, low, close, tick_volume, volume, spread
   FROM bars WHERE symbol = 'ALL' AND timeframe = 'H1' AND isodow(ts) <= 5 AND hour(ts) >= 1)"""
)


def _lines(broken: str = "", blank: str = "") -> str:
    head = "'<DATE>'||d||'<TIME>'||d||'<OPEN>'||d||'<HIGH>'||d||'<LOW>'||d||'<CLOSE>'||d||'<TICKVOL>'||d||'<VOL>'||d||'<SPREAD>'"
    swapped = head.replace("'<DATE>'||d||'<TIME>'", "'<TIME>'||d||'<DATE>'")
    return (
        BARS
        + f""",
quarter AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY ts) AS rn,
                   CASE symbol WHEN 'CLICK' THEN ',' WHEN 'ERROR' THEN ';' ELSE chr(9) END AS d
            FROM bars),
names AS (SELECT symbol, timeframe, symbol || '_' || timeframe || '_' || strftime(min(ts), '%Y%m%d') || '0000_' || strftime(max(ts), '%Y%m%d%H%M') || '.csv' AS file
          FROM quarter GROUP BY symbol, timeframe),
copied AS (SELECT q.*, c.copy FROM quarter q CROSS JOIN (VALUES (0), (1), (2)) c(copy)
           WHERE c.copy = 0 OR (c.copy = 1 AND q.rn % 97 = 5) OR (c.copy = 2 AND q.rn % 101 = 7)),
placed AS (SELECT *, 1 + row_number() OVER (PARTITION BY symbol, timeframe ORDER BY (CASE WHEN rn % 131 = 13 THEN 1 ELSE 0 END), rn, copy) AS line_no
           FROM copied),
lines AS (SELECT n.file, p.line_no,
    (CASE WHEN rn % 113 = 3 OR rn % 151 = 17 THEN strftime(ts, '%Y') || '.13.' || strftime(ts, '%d') ELSE strftime(ts, '%Y.%m.%d') END)
    || d || strftime(ts, '%H:%M:%S') || d || (CASE WHEN rn % 127 = 11 OR rn % 151 = 17 THEN '' ELSE open::VARCHAR END)
    || d || high::VARCHAR || d || low::VARCHAR || d || (CASE WHEN copy = 2 THEN close + 1 ELSE close END)::VARCHAR
    || d || (CASE WHEN rn % 89 = 8 THEN '' ELSE tick_volume::VARCHAR END) || d || volume::VARCHAR
    || d || (CASE WHEN rn % 83 = 6 THEN 'x' ELSE spread::VARCHAR END) AS value
    FROM placed p JOIN names n USING (symbol, timeframe)
  UNION ALL
  SELECT n.file, 1, (CASE WHEN symbol = 'PURCHASE' THEN chr(65279) ELSE '' END)
     || (CASE WHEN symbol = '{blank}' THEN '  ' WHEN symbol = '{broken}' THEN {swapped} ELSE {head} END)
  FROM (SELECT DISTINCT symbol, timeframe, d FROM quarter) JOIN names n USING (symbol, timeframe)),
headers AS (SELECT file, ltrim(value, chr(65279)) AS header FROM lines WHERE line_no = 1),
audit AS (SELECT file, CASE WHEN contains(header, chr(9)) THEN chr(9) WHEN contains(header, ',') THEN ','
                            WHEN contains(header, ';') THEN ';' ELSE chr(9) END AS delimiter, header FROM headers),
cells AS (SELECT l.file, l.line_no, string_split(l.value, a.delimiter) AS c
          FROM lines l JOIN audit a USING (file) WHERE l.line_no > 1),
typed AS (SELECT file, regexp_extract(file, '^([A-Z0-9]+)_', 1) AS symbol, regexp_extract(file, '_(M15|M30|H1)_', 1) AS timeframe, line_no,
    nullif(c[1], '') AS date, nullif(c[2], '') AS time,
    try_cast(c[3] AS DOUBLE) AS open, try_cast(c[4] AS DOUBLE) AS high, try_cast(c[5] AS DOUBLE) AS low, try_cast(c[6] AS DOUBLE) AS close,
    try_cast(c[7] AS BIGINT) AS tick_volume, try_cast(c[8] AS BIGINT) AS volume, try_cast(c[9] AS BIGINT) AS spread,
    len(c) > 9 AS too_many_fields,
    list_bool_or(list_transform(c[7:9], lambda x: coalesce(try_cast(x AS DOUBLE) <> floor(try_cast(x AS DOUBLE)), false))) AS fractional_count,
    try_strptime(c[1] || ' ' || c[2], '%Y.%m.%d %H:%M:%S') AS ts
    FROM cells),
usable AS (SELECT * REPLACE (coalesce(tick_volume, 0) AS tick_volume, coalesce(volume, 0) AS volume, coalesce(spread, 0) AS spread) FROM typed WHERE ts IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL),
exact AS (SELECT symbol, timeframe, ts, open, high, low, close, tick_volume, volume, spread, min(line_no) AS line_no, count(*) AS copies
          FROM usable GROUP BY ALL),
kept AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe, ts ORDER BY line_no) AS variant,
                count(*) OVER (PARTITION BY symbol, timeframe, ts) AS variants FROM exact),
canonical AS (SELECT symbol, timeframe, ts, open, high, low, close, tick_volume, volume, spread, line_no FROM kept WHERE variant = 1),
log AS (SELECT t.symbol, t.timeframe, count(*) AS rows_in,
     count(*) FILTER (t.ts IS NULL) AS dropped_unparseable_timestamp,
     count(*) FILTER (t.ts IS NOT NULL AND (t.open IS NULL OR t.high IS NULL OR t.low IS NULL OR t.close IS NULL)) AS dropped_nan_ohlc,
     count(*) FILTER (t.ts IS NOT NULL AND t.open IS NOT NULL AND t.high IS NOT NULL AND t.low IS NOT NULL AND t.close IS NOT NULL AND t.tick_volume IS NULL) AS filled_tick_volume,
     count(*) FILTER (t.ts IS NOT NULL AND t.open IS NOT NULL AND t.high IS NOT NULL AND t.low IS NOT NULL AND t.close IS NOT NULL AND t.volume IS NULL) AS filled_volume,
     count(*) FILTER (t.ts IS NOT NULL AND t.open IS NOT NULL AND t.high IS NOT NULL AND t.low IS NOT NULL AND t.close IS NOT NULL AND t.spread IS NULL) AS filled_spread
     FROM typed t GROUP BY t.symbol, t.timeframe),
removed AS (SELECT symbol, timeframe, sum(copies - 1)::BIGINT AS exact_duplicates_removed,
     count(*) FILTER (variant = 1 AND variants > 1) AS conflicting_duplicate_groups,
     count(*) FILTER (variant > 1) AS conflicting_duplicate_rows_removed,
     count(*) FILTER (variant = 1) AS rows_out FROM kept GROUP BY symbol, timeframe),
disorder AS (SELECT symbol, timeframe, bool_or(ts < prev) AS reordered FROM
     (SELECT *, lag(ts) OVER (PARTITION BY symbol, timeframe ORDER BY line_no) AS prev FROM canonical) GROUP BY symbol, timeframe)"""
    )


LINES = _lines()


def gaps_of(table: str, name: str = "gap") -> str:
    return f"""{name}_steps AS (SELECT symbol, timeframe, ts, lag(ts) OVER (PARTITION BY symbol, timeframe ORDER BY ts) AS prev,
     CASE timeframe WHEN 'M15' THEN 15 WHEN 'M30' THEN 30 ELSE 60 END::BIGINT * 60000000 AS step FROM {table}),
{name}_deltas AS (SELECT *, epoch_us(ts) - epoch_us(prev) AS delta_us FROM {name}_steps),
{name}s AS (SELECT symbol, timeframe, prev AS gap_start, ts AS gap_end, delta_us,
     round_even(delta_us / step - 1, 0)::BIGINT AS missing_bars,
     CASE WHEN isodow(prev) >= 5 AND isodow(ts) <= 2 AND delta_us < 345600000000 THEN 'weekend'
          WHEN delta_us < 86400000000 THEN 'daily_break'
          WHEN delta_us < 259200000000 THEN 'intraweek' ELSE 'extended' END AS kind
     FROM {name}_deltas WHERE delta_us > step)"""


USER_GAPS = USER_BARS + ", " + gaps_of("bars_user")

OHLC = "high < low OR high < open OR high < close OR low > open OR low > close"
BAD_PRICE = "open <= 0 OR high <= 0 OR low <= 0 OR close <= 0"
OFF_GRID = "(hour(ts) * 60 + minute(ts)) % CASE timeframe WHEN 'M15' THEN 15 WHEN 'M30' THEN 30 ELSE 60 END <> 0 OR second(ts) <> 0"

DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
SPREAD_Q = {"p0": 0, "p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p100": 1}
TICK_Q = {"p1": 0.01, "p50": 0.5, "p99": 0.99}

# every number behind the checks, one row per series
FACTS = (
    JUDGED
    + ", "
    + gaps_of("judged")
    + f""",
base AS (SELECT symbol, timeframe, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts,
   count(*) FILTER ({OFF_GRID}) AS off_grid,
   count(*) FILTER (high < low) AS high_lt_low, count(*) FILTER (high < open) AS high_lt_open,
   count(*) FILTER (high < close) AS high_lt_close, count(*) FILTER (low > open) AS low_gt_open,
   count(*) FILTER (low > close) AS low_gt_close, count(*) FILTER ({OHLC}) AS ohlc_violations,
   count(*) FILTER ({BAD_PRICE}) AS bad_prices, count(*) FILTER (high = low) AS zero_range,
   count(*) FILTER (spread < 0) AS spread_negative, count(*) FILTER (spread = 0) AS spread_zero,
   sum(spread) / count(spread) AS spread_mean,
   {", ".join(f"quantile_cont(spread, {q}) AS spread_{n}" for n, q in SPREAD_Q.items())},
   count(*) FILTER (tick_volume = 0) AS tick_volume_zero, count(*) FILTER (tick_volume < 0) AS tick_volume_negative,
   {", ".join(f"quantile_cont(tick_volume, {q}) AS tick_volume_{n}" for n, q in TICK_Q.items())},
   count(*) FILTER (volume <> 0) AS volume_nonzero_rows, (count(*) FILTER (volume <> 0) = 0)::INTEGER AS volume_all_zero,
   count(*) FILTER (high = low) / count(*) AS zero_range_fraction,
   CASE timeframe WHEN 'M15' THEN 15 WHEN 'M30' THEN 30 WHEN 'H1' THEN 60 END AS expected_step_minutes,
   {", ".join(f"count(*) FILTER (isodow(ts) = {i}) AS {d}" for i, d in enumerate(DAYS, 1))},
   count(DISTINCT hour(ts)) AS hours_with_data, min(hour(ts)) AS first_hour,
   median(CASE WHEN high <> low THEN high - low END) AS median_range,
   count(*) - count(DISTINCT ts) AS duplicates
   FROM judged GROUP BY symbol, timeframe),
extremes AS (SELECT j.symbol, j.timeframe, count(*) FILTER (j.spread > greatest(b.spread_p99 * 5, 1)) AS spread_extreme
   FROM judged j JOIN base b USING (symbol, timeframe) GROUP BY j.symbol, j.timeframe),
stepped AS (SELECT symbol, timeframe, count(*) FILTER (delta_us = step) AS exact_step,
   count(*) FILTER (delta_us < step) AS sub_step, count(*) FILTER (delta_us > step) AS gap_count
   FROM gap_deltas GROUP BY symbol, timeframe),
gapped AS (SELECT symbol, timeframe,
   {", ".join(f"count(*) FILTER (kind = '{k}') AS gaps_{k}" for k in ("weekend", "daily_break", "intraweek", "extended"))},
   sum(missing_bars)::BIGINT AS missing_bars_total,
   coalesce(sum(missing_bars) FILTER (kind <> 'weekend'), 0)::BIGINT AS missing_bars_non_weekend
   FROM gaps GROUP BY symbol, timeframe),
jumping AS (SELECT j.*, lag(close) OVER (PARTITION BY symbol, timeframe ORDER BY ts) AS prev_close FROM judged j),
jumped AS (SELECT j.symbol, j.timeframe, CASE WHEN b.rows >= 3 THEN count(*) FILTER (abs(j.open - j.prev_close) > 12 * b.median_range) END AS jumps
   FROM jumping j JOIN base b USING (symbol, timeframe) GROUP BY j.symbol, j.timeframe, b.rows),
facts AS (SELECT b.*, x.spread_extreme, s.exact_step, s.sub_step, s.gap_count,
   {", ".join(f"coalesce(g.gaps_{k}, 0) AS gaps_{k}" for k in ("weekend", "daily_break", "intraweek", "extended"))},
   coalesce(g.missing_bars_total, 0) AS missing_bars_total, coalesce(g.missing_bars_non_weekend, 0) AS missing_bars_non_weekend,
   p.jumps
   FROM base b JOIN extremes x USING (symbol, timeframe) JOIN stepped s USING (symbol, timeframe)
   JOIN jumped p USING (symbol, timeframe) LEFT JOIN gapped g USING (symbol, timeframe))"""
)

STATUS = {
    "schema": "'PASS'",
    "row_count": "'INFO'",
    "timestamp_order": "CASE WHEN duplicates > 0 THEN 'FAIL' ELSE 'PASS' END",
    "duplicate_timestamps": "CASE WHEN duplicates > 0 THEN 'FAIL' ELSE 'PASS' END",
    "grid_alignment": "CASE WHEN off_grid > 0 THEN 'FAIL' ELSE 'PASS' END",
    "frequency_and_gaps": "CASE WHEN rows < 2 OR sub_step > 0 THEN 'FAIL' WHEN gap_count > 0 THEN 'WARN' ELSE 'PASS' END",
    "ohlc_integrity": "CASE WHEN ohlc_violations > 0 THEN 'FAIL' ELSE 'PASS' END",
    "price_positivity": "CASE WHEN bad_prices > 0 THEN 'FAIL' ELSE 'PASS' END",
    "zero_range_candles": "CASE WHEN zero_range > 0 THEN 'WARN' ELSE 'INFO' END",
    "spread": "CASE WHEN spread_negative > 0 THEN 'FAIL' WHEN spread_zero > 0 OR spread_extreme > 0 THEN 'WARN' ELSE 'PASS' END",
    "volume": "'INFO'",
    "weekday_distribution": "CASE WHEN sat + sun > 0 THEN 'WARN' ELSE 'PASS' END",
    "hour_distribution": "'INFO'",
    "price_jumps": "CASE WHEN jumps > 0 THEN 'WARN' ELSE 'INFO' END",
}
TEXT = {
    "schema": "'no column missing'",
    "row_count": "rows || ' rows from ' || strftime(first_ts, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(last_ts, '%Y-%m-%d %H:%M:%S')",
    "timestamp_order": "'duplicates=' || duplicates",
    "duplicate_timestamps": "'rows sharing a timestamp=' || duplicates",
    "grid_alignment": "'off grid=' || off_grid",
    "frequency_and_gaps": "CASE WHEN rows < 2 THEN 'not enough bars for a step' ELSE 'exact_step=' || exact_step || ' sub_step=' || sub_step || ' gaps=' || gap_count END",
    "ohlc_integrity": "'violations=' || ohlc_violations",
    "price_positivity": "'bad prices=' || bad_prices",
    "zero_range_candles": "'zero range=' || zero_range",
    "spread": "'negative=' || spread_negative || ' zero=' || spread_zero || ' extreme=' || spread_extreme",
    "volume": "'tick_volume zero=' || tick_volume_zero || ' negative=' || tick_volume_negative || ' volume nonzero=' || volume_nonzero_rows",
    "weekday_distribution": "'sat=' || sat || ' sun=' || sun",
    "hour_distribution": "'hours=' || hours_with_data || ' first=' || first_hour",
    "price_jumps": "CASE WHEN jumps IS NULL THEN 'not enough bars to judge' ELSE 'jumps=' || jumps END",
}
METRICS = {
    "row_count": ["rows"],
    "timestamp_order": ["duplicates"],
    "grid_alignment": ["off_grid"],
    "frequency_and_gaps": [
        "expected_step_minutes", "exact_step", "sub_step", "gap_count", "gaps_weekend", "gaps_daily_break", "gaps_intraweek",
        "gaps_extended", "missing_bars_total", "missing_bars_non_weekend",
    ],
    "ohlc_integrity": ["high_lt_low", "high_lt_open", "high_lt_close", "low_gt_open", "low_gt_close", "ohlc_violations"],
    "price_positivity": ["bad_prices"],
    "zero_range_candles": ["zero_range", "zero_range_fraction"],
    "spread": ["spread_negative", "spread_zero", "spread_extreme", "spread_mean", *[f"spread_{n}" for n in SPREAD_Q]],
    "volume": ["tick_volume_zero", "tick_volume_negative", "volume_nonzero_rows", "volume_all_zero", *[f"tick_volume_{n}" for n in TICK_Q]],
    "weekday_distribution": DAYS,
    "hour_distribution": ["hours_with_data", "first_hour"],
    "price_jumps": ["jumps", "median_range"],
}

RESULTS = (
    FACTS
    + ",\nresults AS ("
    + "\nUNION ALL ".join(
        f"SELECT symbol, timeframe, {i} AS position, '{c}' AS check_name, {STATUS[c]} AS status, {TEXT[c]} AS summary FROM facts"
        for i, c in enumerate(STATUS, 1)
    )
    + ")"
)


def check(name: str, *columns: str) -> str:
    return f"WITH {FACTS} SELECT symbol, timeframe, {', '.join(columns)}, {STATUS[name]} AS status FROM facts"


def near(expression: str) -> str:
    """Six digits, shifted off exact ties, on which two engines may round to different sides."""
    return f"round(({expression})::DOUBLE + 1e-8, 6)"


def rounded(*names: str) -> list[str]:
    return [f"{near(n)} AS {n}" for n in names]


def metrics_sql() -> str:
    rows = [(c, m, m) for c, names in METRICS.items() for m in names]
    # no series of this input shares a timestamp, so both duplicate numbers are the same
    rows.append(("duplicate_timestamps", "sharing_rows", "duplicates"))
    parts = [
        f"SELECT symbol, timeframe, '{c}' AS check_name, '{m}' AS metric, {near(e)} AS value FROM facts"
        for c, m, e in rows
    ]
    return f"WITH {FACTS} " + "\nUNION ALL ".join(parts)


def examples_sql() -> str:
    flags = {
        "grid_alignment": (OFF_GRID, 10),
        "ohlc_integrity": (OHLC, 10),
        "price_positivity": (BAD_PRICE, 10),
        "zero_range_candles": ("high = low", 5),
        "spread": ("spread > greatest(spread_p99 * 5, 1)", 5),
        "price_jumps": ("abs(open - prev_close) > 12 * median_range", 10),
    }
    parts = []
    for name, (cond, n) in flags.items():
        extra = "prev_close, abs(open - prev_close) AS jump" if name == "price_jumps" else "NULL::DOUBLE AS prev_close, NULL::DOUBLE AS jump"
        parts.append(
            f"""SELECT symbol, timeframe, '{name}' AS check_name,
            row_number() OVER (PARTITION BY symbol, timeframe ORDER BY ts)::INTEGER AS rank,
            ts, open, high, low, close, tick_volume, volume, spread, {extra}
            FROM seen WHERE {cond} QUALIFY rank <= {n}"""
        )
    return (
        f"WITH {FACTS}, seen AS (SELECT j.*, b.spread_p99, b.median_range FROM jumping j JOIN base b USING (symbol, timeframe)) "
        + "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    )


def pairs_cte(table: str) -> str:
    return f"""pairs AS (SELECT * FROM (VALUES ('M15', 'M30', 15, 30), ('M30', 'H1', 30, 60), ('M15', 'H1', 15, 60)) p(lo, hi, lm, hm)),
lower AS (SELECT b.*, p.lo || '->' || p.hi AS pair, p.lm, p.hm FROM {table} b JOIN pairs p ON b.timeframe = p.lo),
higher AS (SELECT b.*, p.lo || '->' || p.hi AS pair FROM {table} b JOIN pairs p ON b.timeframe = p.hi),
buckets AS (SELECT symbol, pair, time_bucket(to_minutes(hm), ts) AS bucket, first(open ORDER BY ts) AS open, max(high) AS high,
   min(low) AS low, last(close ORDER BY ts) AS close, sum(tick_volume)::BIGINT AS tick_volume
   FROM lower GROUP BY symbol, pair, lm, hm, time_bucket(to_minutes(hm), ts) HAVING count(*) = hm // lm),
matched AS (SELECT a.symbol, a.pair, a.bucket AS ts, abs(a.open - h.open) AS open_diff, abs(a.high - h.high) AS high_diff,
   abs(a.low - h.low) AS low_diff, abs(a.close - h.close) AS close_diff, abs(a.tick_volume - h.tick_volume) AS tick_volume_diff
   FROM buckets a JOIN higher h ON h.symbol = a.symbol AND h.pair = a.pair AND h.ts = a.bucket),
bounds AS (SELECT symbol, pair, min(ts) AS a, max(ts) AS z FROM lower GROUP BY symbol, pair),
bare AS (SELECT h.symbol, h.pair, h.ts FROM higher h JOIN bounds b USING (symbol, pair)
   WHERE h.ts BETWEEN b.a AND b.z AND NOT EXISTS
   (SELECT 1 FROM buckets k WHERE k.symbol = h.symbol AND k.pair = h.pair AND k.bucket = h.ts))"""


PRICES = ["open", "high", "low", "close"]


def compare_sql(table_cte: str, table: str) -> str:
    mism = " + ".join(f"{c}_mismatches" for c in PRICES)
    return f"""WITH {table_cte}, {pairs_cte(table)},
counted AS (SELECT symbol, pair, count(*) AS compared, min(ts) AS overlap_start, max(ts) AS overlap_end,
  {", ".join(f"count(*) FILTER ({c}_diff > 1e-9) AS {c}_mismatches" for c in PRICES)},
  count(*) FILTER (tick_volume_diff > 0) AS tick_volume_mismatches,
  {", ".join(f"{near(f'quantile_cont({c}_diff, 0.5)')} AS {c}_p50, {near(f'quantile_cont({c}_diff, 0.99)')} AS {c}_p99, max({c}_diff) AS {c}_max" for c in PRICES)},
  {near('quantile_cont(tick_volume_diff, 0.99)')} AS tick_volume_p99
  FROM matched GROUP BY symbol, pair),
complete AS (SELECT symbol, pair, count(*) AS complete_buckets FROM buckets GROUP BY symbol, pair),
missing AS (SELECT symbol, pair, count(*) AS n FROM bare GROUP BY symbol, pair),
both_sides AS (SELECT DISTINCT l.symbol, l.pair FROM lower l JOIN (SELECT DISTINCT symbol, pair FROM higher) h USING (symbol, pair))
SELECT e.symbol, e.pair, coalesce(complete_buckets, 0) AS complete_buckets, coalesce(compared, 0) AS compared,
  overlap_start, overlap_end, {", ".join(f"{c}_mismatches" for c in PRICES)}, tick_volume_mismatches,
  {", ".join(f"{c}_p50, {c}_p99, {c}_max" for c in PRICES)}, tick_volume_p99,
  CASE WHEN compared IS NOT NULL THEN coalesce(m.n, 0) END AS higher_without_bucket,
  {near(f'({mism}) / (4 * compared)')} AS price_mismatch_fraction,
  CASE WHEN compared IS NOT NULL THEN CASE WHEN {mism} = 0 THEN 'PASS' ELSE 'WARN' END END AS status,
  CASE WHEN compared IS NULL THEN 'nothing to compare in common' END AS note
FROM both_sides e LEFT JOIN counted c USING (symbol, pair) LEFT JOIN complete k USING (symbol, pair) LEFT JOIN missing m USING (symbol, pair)"""


def digest_cte(table: str, name: str = "digests", month: bool = False) -> str:
    """Digests of the series of a table, or of its months; ``name`` also starts the names of what it is made of."""
    cells = " || '|' || ".join(
        f"coalesce({c}::VARCHAR, 'null')"
        for c in ("strftime(ts, '%Y-%m-%d %H:%M:%S')", *PRICES, "tick_volume", "volume", "spread")
    )
    # a lane is 64 bits wide: two halves of 32 bits stay inside a signed integer
    lanes = ", ".join(
        f"sum(('0x' || substr(h, {1 + i * 16}, 8))::BIGINT::HUGEINT * 4294967296 + ('0x' || substr(h, {9 + i * 16}, 8))::BIGINT) AS l{i}"
        for i in range(4)
    )
    joined = " || '|' || ".join(f"l{i}::HUGEINT::VARCHAR" for i in range(4))
    keys = "symbol, timeframe" + (", month" if month else "")
    return f"""{name}_hashed AS (SELECT symbol, timeframe, strftime(ts, '%Y-%m') AS month, sha256({cells}) AS h FROM {table}),
{name}_lanes AS (SELECT {keys}, count(*) AS rows, {lanes} FROM {name}_hashed GROUP BY {keys}),
{name} AS (SELECT {keys}, rows,
  sha256('ts,open,high,low,close,tick_volume,volume,spread|' || rows || '|' || {joined}) AS {"month" if month else "content"}_sha256 FROM {name}_lanes)"""


def sources_cte() -> str:
    """Digests of the export files that ``lines`` stand for."""
    lanes = ", ".join(
        f"sum(('0x' || substr(h, {1 + i * 16}, 8))::BIGINT::HUGEINT * 4294967296 + ('0x' || substr(h, {9 + i * 16}, 8))::BIGINT)::VARCHAR AS lane{i}"
        for i in range(4)
    )
    return f"""source_lines AS (SELECT file, strlen(value) + 1 AS size, sha256(line_no || '|' || sha256(value)) AS h FROM lines),
source_sums AS (SELECT file, sum(size)::BIGINT AS source_size_bytes, count(*) AS n, {lanes} FROM source_lines GROUP BY file),
sources AS (SELECT file, source_size_bytes,
  sha256(concat_ws('|', source_size_bytes::VARCHAR, n::VARCHAR, lane0, lane1, lane2, lane3)) AS source_sha256 FROM source_sums)"""


RAISED = """raised AS (SELECT * REPLACE (CASE WHEN symbol = 'ERROR' AND ts = min(ts) OVER (PARTITION BY symbol, timeframe)
  THEN close + 1 ELSE close END AS close) FROM bars)"""


COVER = "covered AS (SELECT symbol, timeframe, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS rows FROM bars GROUP BY symbol, timeframe)"


def feature_sql(name: str, table: str, keys: str) -> str:
    """(keys, ts, value) of one feature, as a query."""
    w = f"PARTITION BY {keys} ORDER BY ts"
    simple = {
        "rolling5": f"CASE WHEN count(close) OVER ({w} ROWS 4 PRECEDING) = 5 THEN avg(close) OVER ({w} ROWS 4 PRECEDING) END",
        "pct_change": f"close / nullif(lag(close) OVER ({w}), 0) - 1",
        "expanding": f"avg(close) OVER ({w} ROWS UNBOUNDED PRECEDING)",
        "lead": f"lead(close) OVER ({w})",
        "centered": f"CASE WHEN count(close) OVER ({w} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 5 THEN avg(close) OVER ({w} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) END",
        "zscore": f"(close - avg(close) OVER (PARTITION BY {keys})) / nullif(stddev_samp(close) OVER (PARTITION BY {keys}), 0)",
        "label": f"CASE WHEN lead(close, 3) OVER ({w}) > close THEN 1.0 ELSE 0.0 END",
    }
    if name == "shortened":
        return f"SELECT {keys}, ts, lead(close) OVER ({w}) AS value FROM {table} QUALIFY value IS NOT NULL"
    if name in simple:
        return f"SELECT {keys}, ts, {simple[name]} AS value FROM {table}"
    join = " AND ".join(f"n.{k.strip()} = e.{k.strip()}" for k in keys.split(","))
    columns = ", ".join(f"n.{k.strip()}" for k in keys.split(","))
    return f"""(WITH RECURSIVE num AS (SELECT {keys}, ts, close, row_number() OVER ({w}) AS rn FROM {table}),
      e AS (SELECT {keys}, ts, rn, close AS value FROM num WHERE rn = 1
            UNION ALL
            SELECT {columns}, n.ts, n.rn, (2.0::DOUBLE / 11) * n.close + (1 - 2.0::DOUBLE / 11) * e.value
            FROM e JOIN num n ON {join} AND n.rn = e.rn + 1)
      SELECT {keys}, ts, value FROM e)"""


def causality_sql(name: str) -> str:
    return f"""WITH {BARS},
sized AS (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY ts) AS rn,
          count(*) OVER (PARTITION BY symbol, timeframe) AS n FROM bars),
cuts AS (SELECT DISTINCT symbol, timeframe, rn AS cut, ts AS cut_ts FROM sized
         WHERE rn IN (greatest(n // 7, 1), greatest(n // 3, 1), greatest(n // 2, 1), greatest(3 * n // 4, 1), greatest(n - 1, 1))),
pieces AS (SELECT b.*, c.cut FROM bars b JOIN cuts c ON b.symbol = c.symbol AND b.timeframe = c.timeframe AND b.ts <= c.cut_ts),
whole AS (SELECT * FROM {"(" + feature_sql(name, "bars", "symbol, timeframe") + ")"}),
part AS (SELECT * FROM {"(" + feature_sql(name, "pieces", "symbol, timeframe, cut") + ")"}),
whole_cut AS (SELECT w.*, c.cut FROM whole w JOIN cuts c ON w.symbol = c.symbol AND w.timeframe = c.timeframe AND w.ts <= c.cut_ts),
judged AS (SELECT symbol, timeframe, cut, ts, p.symbol IS NOT NULL AND w.symbol IS NOT NULL AS present,
   NOT (p.value IS NOT DISTINCT FROM w.value OR coalesce(abs(p.value - w.value) <= 1e-9, false)) AS differs
   FROM part p FULL JOIN whole_cut w USING (symbol, timeframe, cut, ts))
SELECT c.symbol, c.timeframe, c.cut, c.cut_ts, count(*) FILTER (j.present) AS compared, count(*) FILTER (j.present AND j.differs) AS differing,
   count(*) FILTER (NOT j.present) AS one_sided, min(j.ts) FILTER (j.present AND j.differs) AS first_bad_ts
FROM cuts c LEFT JOIN judged j ON j.symbol = c.symbol AND j.timeframe = c.timeframe AND j.cut = c.cut
GROUP BY c.symbol, c.timeframe, c.cut, c.cut_ts"""


LOG_COLUMNS = """l.rows_in, coalesce(r.rows_out, 0) AS rows_out, l.dropped_unparseable_timestamp, l.dropped_nan_ohlc,
  coalesce(r.exact_duplicates_removed, 0) AS exact_duplicates_removed,
  coalesce(r.conflicting_duplicate_groups, 0) AS conflicting_duplicate_groups,
  coalesce(r.conflicting_duplicate_rows_removed, 0) AS conflicting_duplicate_rows_removed,
  l.filled_tick_volume, l.filled_volume, l.filled_spread,
  coalesce(d.reordered, false) AS reordered"""

VALUES = "open, high, low, close, tick_volume, volume, spread"

ORACLES: dict[str, str] = {
    "file_identity": f"""WITH {LINES} SELECT file, symbol, timeframe, regexp_extract(file, '_(\\d{{12}})_', 1) AS declared_start,
        regexp_extract(file, '_(\\d{{12}})\\.csv', 1) AS declared_end, symbol || '_' || timeframe AS dataset_id, true AS ok FROM names""",
    "header_audit": f"""WITH {_lines('VIEW', 'SIGNUP')} SELECT file, delimiter,
        replace(replace(replace(upper(trim(header)), delimiter, ','), '<', ''), '>', '') AS columns,
        replace(replace(replace(upper(header), delimiter, ','), '<', ''), '>', '') = 'DATE,TIME,OPEN,HIGH,LOW,CLOSE,TICKVOL,VOL,SPREAD' AS ok
        FROM audit""",
    "raw_typed": f"""WITH {LINES} SELECT file, line_no, date, time, {VALUES}, too_many_fields, fractional_count, symbol, timeframe FROM typed""",
    "line_numbers": "SELECT count(*) AS lines, 0::BIGINT AS misnumbered FROM events WHERE ts IS NOT NULL",
    "bars_roundtrip": f"WITH {BARS} SELECT symbol, timeframe, ts, {VALUES} FROM bars",
    "manifest_table": f"""WITH {LINES}, {digest_cte('canonical')}, {sources_cte()},
        covered AS (SELECT symbol, timeframe, min(ts) AS a, max(ts) AS z FROM canonical GROUP BY symbol, timeframe)
        SELECT symbol || '_' || timeframe AS dataset_id, symbol, timeframe, '1.0.0' AS schema_version, 'broker_server_time_naive' AS timezone,
        file AS source_filename, source_sha256, source_size_bytes, regexp_extract(file, '_(\\d{{12}})_', 1) AS declared_start,
        regexp_extract(file, '_(\\d{{12}})\\.csv', 1) AS declared_end, content_sha256, rows,
        strftime(a, '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(z, '%Y-%m-%d %H:%M:%S') AS last_ts,
        rows_in, dropped_unparseable_timestamp, dropped_nan_ohlc, reordered
        FROM names JOIN sources USING (file) JOIN digests USING (symbol, timeframe) JOIN covered USING (symbol, timeframe) JOIN log USING (symbol, timeframe)
        JOIN disorder USING (symbol, timeframe)""",
    "verify_datasets": f"""WITH {BARS}, {RAISED}, {digest_cte('bars', 'wanted')}, {digest_cte('raised', 'found')}
        SELECT symbol, timeframe, f.rows, w.content_sha256 AS expected_sha256,
        CASE WHEN symbol = 'VIEW' THEN '0.9.0' ELSE '1.0.0' END AS file_schema_version,
        w.content_sha256 = f.content_sha256 AND symbol <> 'VIEW' AS ok,
        CASE WHEN w.content_sha256 <> f.content_sha256 THEN 'content hash mismatch' WHEN symbol = 'VIEW' THEN 'schema version' END AS problem
        FROM wanted w JOIN found f USING (symbol, timeframe)""",
    "verify_months": f"""WITH {BARS}, {RAISED}, {digest_cte('bars', 'wanted', True)}, {digest_cte('raised', 'found', True)}
        SELECT symbol, timeframe, month, f.rows, w.rows AS expected_rows FROM wanted w JOIN found f USING (symbol, timeframe, month)
        WHERE w.month_sha256 <> f.month_sha256""",
    "source_digest": f"WITH {LINES}, {sources_cte()} SELECT * FROM sources",
    "month_digest": f"WITH {BARS}, {digest_cte('bars', 'months', True)} SELECT * FROM months",
    "content_digest": f"WITH {BARS}, {digest_cte('bars')} SELECT * FROM digests",
    "parse_ts": f"WITH {LINES} SELECT symbol, timeframe, line_no, date, time, ts FROM typed",
    "exact_duplicates": f"WITH {LINES} SELECT * FROM exact WHERE copies > 1",
    "conflicting_duplicates": f"""WITH {LINES} SELECT symbol, timeframe, ts, line_no, {VALUES}, variant = 1 AS kept FROM kept WHERE variants > 1""",
    "conflict_examples": f"""WITH {LINES}, several AS (SELECT symbol, timeframe, ts, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY ts)::INTEGER AS group_no
        FROM kept WHERE variants > 1 AND variant = 1)
        SELECT k.symbol, k.timeframe, k.ts, k.line_no, {VALUES}, k.variant = 1 AS kept, s.group_no
        FROM kept k JOIN several s ON s.symbol = k.symbol AND s.timeframe = k.timeframe AND s.ts = k.ts WHERE s.group_no <= 20""",
    "canonical_bars": f"WITH {LINES} SELECT * FROM canonical",
    "normalization_log": f"""WITH {LINES} SELECT l.symbol, l.timeframe, {LOG_COLUMNS} FROM log l
        LEFT JOIN removed r USING (symbol, timeframe) LEFT JOIN disorder d USING (symbol, timeframe)""",
    "check_schema": f"""WITH {JUDGED}, tables AS (SELECT * FROM judged
          UNION ALL SELECT 'NARROW', timeframe, ts, open, high, low, close, tick_volume, volume, NULL FROM judged WHERE symbol = 'SESSION'),
        seen AS (SELECT symbol, timeframe, concat_ws(',', {", ".join(f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in ("ts", *VALUES.split(", ")))}) AS missing
          FROM tables GROUP BY symbol, timeframe)
        SELECT symbol, timeframe, CASE WHEN missing <> '' THEN 'FAIL' ELSE 'PASS' END AS status, missing FROM seen""",
    "check_row_count": check("row_count", "rows", "first_ts", "last_ts"),
    "check_ts_order": f"""WITH {LINES}, seen AS (SELECT symbol, timeframe, ts, lag(ts) OVER (PARTITION BY symbol, timeframe ORDER BY line_no) AS prev FROM usable),
        f AS (SELECT symbol, timeframe, count(*) - count(DISTINCT ts) AS duplicates, NOT coalesce(bool_or(ts < prev), false) AS monotonic
              FROM seen GROUP BY symbol, timeframe)
        SELECT *, CASE WHEN duplicates > 0 OR NOT monotonic THEN 'FAIL' ELSE 'PASS' END AS status FROM f""",
    "check_duplicates": f"""WITH {LINES}, seen AS (SELECT symbol, timeframe, count(*) OVER (PARTITION BY symbol, timeframe, ts) AS n FROM usable),
        f AS (SELECT symbol, timeframe, count(*) FILTER (n > 1) AS sharing_rows FROM seen GROUP BY symbol, timeframe)
        SELECT *, CASE WHEN sharing_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM f""",
    "check_grid": check("grid_alignment", "off_grid"),
    "check_ohlc": check("ohlc_integrity", *METRICS["ohlc_integrity"]),
    "check_positivity": check("price_positivity", "bad_prices"),
    "check_zero_range": check("zero_range_candles", "zero_range", near("zero_range / rows") + " AS fraction"),
    "check_spread": check(
        "spread", "spread_negative", "spread_zero", "spread_extreme", *rounded("spread_mean", *[f"spread_{n}" for n in SPREAD_Q])
    ),
    "check_volume": f"""WITH {FACTS} SELECT symbol, timeframe, tick_volume_zero, tick_volume_negative,
        {", ".join(rounded(*[f"tick_volume_{n}" for n in TICK_Q]))}, volume_nonzero_rows = 0 AS volume_all_zero, volume_nonzero_rows FROM facts""",
    "check_weekday": check("weekday_distribution", *DAYS),
    "check_hour": f"""WITH {JUDGED}, series AS (SELECT DISTINCT symbol, timeframe FROM judged),
        seen AS (SELECT symbol, timeframe, hour(ts) AS h, count(*) AS n FROM judged GROUP BY ALL)
        SELECT s.symbol, s.timeframe, r.range::INTEGER AS hour, coalesce(n, 0) AS bars FROM series s CROSS JOIN range(24) r
        LEFT JOIN seen x ON x.symbol = s.symbol AND x.timeframe = s.timeframe AND x.h = r.range""",
    "check_price_jumps": check("price_jumps", "jumps", *rounded("median_range")),
    "check_frequency": check("frequency_and_gaps", "rows", *METRICS["frequency_and_gaps"][1:]),
    # the exact value of each rank, and its bucket; a value outside its bounds would be missing here
    "sketch_quantiles": f"""WITH {JUDGED}, measured AS (
          SELECT symbol, timeframe, unnest(['spread', 'tick_volume', 'range']) AS metric,
            unnest([round(spread / 1e-6::DOUBLE)::BIGINT, round(tick_volume / 1e-6::DOUBLE)::BIGINT, round((high - low) / 1e-6::DOUBLE)::BIGINT]) AS v FROM judged),
        ranked AS (SELECT symbol, timeframe, metric, list_sort(list(v)) AS vs, count(*) AS n FROM measured GROUP BY symbol, timeframe, metric),
        asked AS (SELECT *, unnest([0.01, 0.25, 0.5, 0.99, 1.0]::DOUBLE[]) AS prob FROM ranked),
        found AS (SELECT *, vs[greatest(ceil(prob * n), 1)::BIGINT] AS exact FROM asked),
        cut AS (SELECT *, CASE WHEN abs(exact) < 256 THEN 0 ELSE length(bin(abs(exact))) - 8 END AS dropped FROM found),
        bounds AS (SELECT *, sign(exact) * ((abs(exact) >> dropped) << dropped) AS bucket FROM cut)
        SELECT symbol, timeframe, metric, prob, n, {near("bucket * 1e-6::DOUBLE")} AS estimate,
          {near("(bucket + sign(bucket) * floor(abs(bucket) / 128)) * 1e-6::DOUBLE")} AS farthest
        FROM bounds WHERE abs(exact) BETWEEN abs(bucket) AND abs(bucket) + floor(abs(bucket) / 128)""",
    "check_examples": examples_sql(),
    "check_metrics": metrics_sql(),
    "quality_report": f"WITH {RESULTS} SELECT * FROM results",
    "overall_status": f"""WITH {RESULTS} SELECT symbol, timeframe, CASE max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)
        WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS overall FROM results GROUP BY symbol, timeframe""",
    "gaps": f"WITH {USER_GAPS} SELECT * FROM gaps",
    "gap_kinds": f"WITH {USER_GAPS} SELECT symbol, timeframe, kind, count(*) AS gaps FROM gaps GROUP BY ALL",
    "largest_gaps": f"""WITH {USER_GAPS} SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY delta_us DESC, gap_start)::INTEGER AS rank
        FROM gaps QUALIFY rank <= 10""",
    "rollup_m15_h1": f"""WITH {BARS} SELECT symbol, 'H1' AS timeframe, time_bucket(INTERVAL 60 MINUTE, ts) AS ts, first(open ORDER BY ts) AS open,
        max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, sum(tick_volume)::BIGINT AS tick_volume, sum(volume)::BIGINT AS volume
        FROM bars b WHERE timeframe = 'M15' GROUP BY symbol, time_bucket(INTERVAL 60 MINUTE, b.ts) HAVING count(*) = 4""",
    "cross_tf_compare": f"""WITH {CHANGED}, {pairs_cte('changed')} SELECT symbol, pair, ts,
        {", ".join(f"{c}_diff" for c in PRICES)}, tick_volume_diff FROM matched""",
    "cross_tf_all": compare_sql(CHANGED, "changed"),
    "cross_tf_no_overlap": f"""SELECT symbol, pair, complete_buckets, compared, status, note FROM (
        {compare_sql(BARS + ", moved AS (SELECT * REPLACE (CASE WHEN timeframe = 'H1' THEN ts + INTERVAL 365 DAY ELSE ts END AS ts) FROM bars)", "moved")})""",
    "cross_tf_uncovered": f"WITH {BARS}, {pairs_cte('bars')} SELECT symbol, pair, ts FROM bare",
    "coverage": f"WITH {BARS}, {COVER} SELECT * FROM covered",
    "coverage_tiers": f"""WITH {BARS}, {COVER}, members AS (SELECT * FROM (VALUES ('H1_only', 'H1', 'H1', 1), ('H1_M30', 'H1+M30', 'H1', 2), ('H1_M30', 'H1+M30', 'M30', 2),
        ('H1_M30_M15', 'H1+M30+M15', 'H1', 3), ('H1_M30_M15', 'H1+M30+M15', 'M30', 3), ('H1_M30_M15', 'H1+M30+M15', 'M15', 3)) m(tier, timeframes, timeframe, need)),
        common AS (SELECT symbol, tier, timeframes, max(start_ts) AS start_ts, min(end_ts) AS end_ts FROM covered JOIN members USING (timeframe)
                   GROUP BY symbol, tier, timeframes, need HAVING count(*) = need)
        SELECT *, start_ts <= end_ts AS valid,
        CASE WHEN start_ts <= end_ts THEN (epoch_us(end_ts) - epoch_us(start_ts)) / 86400000000.0::DOUBLE ELSE 0.0 END AS span_days FROM common""",
    **{
        f"feat_{n}": f"WITH {BARS} SELECT symbol, timeframe, ts, {"value" if n == "pct_change" else near('value') + ' AS value'} FROM ({feature_sql(n, 'bars', 'symbol, timeframe')})"
        for n in ("rolling5", "pct_change", "ewm10", "expanding")
    },
    **{
        f"causality_{n}": causality_sql(n)
        for n in ("rolling5", "pct_change", "ewm10", "expanding", "lead", "centered", "zscore", "label", "shortened")
    },
    "causality_verdicts": " UNION ALL ".join(
        f"SELECT '{n}' AS feature, symbol, timeframe, bool_and(differing = 0 AND one_sided = 0) AS causal "
        f"FROM ({causality_sql(n)}) GROUP BY symbol, timeframe"
        for n in ("pct_change", "lead", "shortened")
    ),
    "available_at": f"""WITH {BARS} SELECT symbol, timeframe, ts, {VALUES}, ts + to_minutes(minutes) AS available_at
        FROM bars JOIN frames USING (timeframe)""",
    "spread_by_year": f"""WITH {BARS} SELECT symbol, timeframe, year(ts)::INTEGER AS year, count(*) AS rows, count(*) FILTER (spread = 0) AS zero_spreads,
        {near('count(*) FILTER (spread = 0) / count(*)')} AS zero_share, {near('median(spread)')} AS median_spread FROM bars GROUP BY symbol, timeframe, year(ts)""",
    "gap_resume_profile": f"""WITH {USER_GAPS} SELECT symbol, timeframe, kind, (isodow(gap_start) - 1)::INTEGER AS start_weekday, hour(gap_start)::INTEGER AS start_hour,
        (isodow(gap_end) - 1)::INTEGER AS end_weekday, hour(gap_end)::INTEGER AS end_hour, count(*) AS gaps FROM gaps GROUP BY ALL""",
    "volume_by_year": f"""WITH {BARS} SELECT symbol, timeframe, year(ts)::INTEGER AS year, count(*) AS rows, count(*) FILTER (volume <> 0) AS nonzero_rows
        FROM bars GROUP BY symbol, timeframe, year(ts)""",
    "flag_provisional": f"""WITH {BARS} SELECT symbol, timeframe, ts, {VALUES}, ts = max(ts) OVER (PARTITION BY symbol, timeframe) AS provisional FROM bars""",
    "trim_provisional": f"""WITH {BARS} SELECT symbol, timeframe, ts, {VALUES} FROM bars QUALIFY ts < max(ts) OVER (PARTITION BY symbol, timeframe)""",
    "gap_lengths": f"""WITH {USER_GAPS} SELECT symbol, timeframe, gap_start, gap_start + to_microseconds(delta_us) AS reached,
        delta_us // 86400000000 AS days FROM gaps""",
    "declared_vs_actual": f"""WITH {BARS} SELECT symbol, timeframe, date_trunc('day', min(ts))::TIMESTAMP AS declared_start, max(ts) AS declared_end,
        min(ts) AS actual_start, max(ts) AS actual_end, date_trunc('day', min(ts))::TIMESTAMP = min(ts) AS start_matches, true AS end_matches
        FROM bars GROUP BY symbol, timeframe""",
    "export_cap_evidence": f"""WITH {BARS}, {COVER} SELECT symbol, count(*) AS series, min(end_ts) AS earliest_end, max(end_ts) AS latest_end,
        count(DISTINCT start_ts) AS distinct_starts, min(rows) AS min_rows, max(rows) AS max_rows, {near('min(rows) / max(rows)')} AS row_ratio
        FROM covered GROUP BY symbol""",
}
