"""Raw text lines to typed rows: header audit, typing and timestamps.

Input is a table of (file, line_no, value) text lines, line 1 being the header, whatever it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values
from candlewarden.schema import COUNTS, FILE_NAME_PATTERN, PRICES, RAW_COLUMNS, SERIES, ExportLayoutError

BOM = "\ufeff"
TIMESTAMP_PATTERN = r"^\d{4}\.\d{1,2}\.(?:\d{1,2}| [1-9]) \d{1,2}:\d{1,2}:\d{1,2}$"
NUMBER_PATTERN = r"(?i)^\s*([+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity))\s*$"
# The first and last second a 64-bit nanosecond timestamp can hold.
FIRST_TS = "1677-09-21 00:12:44"
LAST_TS = "2262-04-11 23:47:16"
SHOWN = 20


def identity_columns(name: Column) -> list[Column]:
    """symbol, timeframe and declared range from a file name; NULL where the name does not match."""
    def part(i: int) -> Column:
        found = F.regexp_extract(name, FILE_NAME_PATTERN, i)
        return F.when(found != "", found)

    return [
        part(1).alias("symbol"),
        part(2).alias("timeframe"),
        part(3).alias("declared_start"),
        part(4).alias("declared_end"),
    ]


def file_identity(files: DataFrame) -> DataFrame:
    """One row per file: identity parsed from the name, ``ok`` false when the name is not an export name."""
    parsed = files.select("file", *identity_columns(F.col("file")))
    return parsed.select(
        "*",
        F.concat_ws("_", "symbol", "timeframe").alias("dataset_id"),
        F.col("symbol").isNotNull().alias("ok"),
    )


def refuse(bad: DataFrame, error, what: str) -> None:
    """Raise one error that counts the bad files and names the first of them."""
    n = bad.count()
    if n:
        shown = [r[0] for r in bad.select("file").orderBy("file").limit(SHOWN).collect()]
        raise error(f"{n} file(s) with {what}: {', '.join(shown)}")


def header_audit(lines: DataFrame) -> DataFrame:
    """Delimiter and column names of each file's first line, and whether the layout is the expected one."""
    first = lines.where(F.col("line_no") == 1).select("file", F.ltrim("value", F.lit(BOM)).alias("header"))
    delimiter = (
        F.when(F.instr("header", "\t") > 0, "\t")
        .when(F.instr("header", ",") > 0, ",")
        .when(F.instr("header", ";") > 0, ";")
        .otherwise("\t")
    )
    split = first.withColumn("delimiter", delimiter).withColumn(
        "cells", F.split("header", F.col("delimiter"))
    )
    names = F.transform("cells", lambda c: F.upper(F.btrim(F.btrim(c, F.lit(" \t\r\n")), F.lit("<>"))))
    expected = F.array(*[F.lit(c) for c in RAW_COLUMNS])
    return split.select("file", "delimiter", names.alias("columns")).withColumn(
        "ok", F.col("columns") == expected
    )


def require_headers(audit: DataFrame) -> None:
    refuse(audit.where(~F.col("ok")), ExportLayoutError, f"a header other than {', '.join(RAW_COLUMNS)}")


def number_sql(text: str) -> str:
    """Text to DOUBLE; anything that is not a number, NaN included, becomes NULL.

    The pattern keeps out what Java alone reads as a number, such as the type suffix in ``1d``.
    """
    return f"try_cast(regexp_extract({text}, r'{NUMBER_PATTERN}', 1) AS DOUBLE)"


def integral_sql(number: str) -> str:
    """A whole number that a BIGINT holds; 2^63 itself is the first one that it does not."""
    return f"({number} = floor({number}) AND abs({number}) < 9223372036854775808D)"


def count_sql(text: str, number: str) -> str:
    """Text to BIGINT; integral decimals count as integers, other text becomes NULL."""
    integral = f"CASE WHEN {integral_sql(number)} THEN try_cast({number} AS BIGINT) END"
    return f"coalesce(try_cast({text} AS BIGINT), {integral})"


def fractional_sql(text: str, number: str) -> str:
    """A count that is a number but no integer of 64 bits, which the loader refuses."""
    return f"coalesce(try_cast({text} AS BIGINT) IS NULL AND NOT {integral_sql(number)}, false)"


# yyyy.mm.dd and HH:MM:SS to an instant; NULL when they do not form a valid one
SHAPED = f"""replace(translate(regexp_extract(
    concat(coalesce(date, ''), ' ', coalesce(time, '')), r'{TIMESTAMP_PATTERN}', 0), '.', '-'), '- ', '-')"""
# seconds 60 and 61 are leap seconds and run into the next minute
LEAP = """try_cast(regexp_replace(_shaped, ':6[01]$', ':00') AS TIMESTAMP_NTZ)
    + make_dt_interval(0, 0, 0, CAST(right(_shaped, 2) AS INT))"""
INSTANT = f"CASE WHEN _shaped RLIKE ':6[01]$' THEN {LEAP} ELSE try_cast(_shaped AS TIMESTAMP_NTZ) END"


def with_ts(typed: DataFrame) -> DataFrame:
    """Add ``ts`` from ``date`` and ``time``."""
    bounded = f"CASE WHEN _ts BETWEEN TIMESTAMP_NTZ'{FIRST_TS}' AND TIMESTAMP_NTZ'{LAST_TS}' THEN _ts END"
    shaped = typed.withColumn("_shaped", F.expr(SHAPED)).withColumn("_ts", F.expr(INSTANT))
    return shaped.withColumn("ts", F.expr(bounded)).drop("_shaped", "_ts")


def typed_rows(lines: DataFrame, delimiter: str = "'\t'") -> DataFrame:
    """Typed columns of every data line, with its line number and what is wrong with its shape.

    ``delimiter`` is a SQL expression. Empty text is NULL; DATE and TIME stay text. The steps are
    separate projections, so that no parsed value is computed more than once.
    """
    kept = [c for c in lines.columns if c not in ("value", "delimiter")]
    names = ["date", "time", *PRICES, *COUNTS]
    cells = lines.where("line_no > 1").selectExpr(*kept, f"split(value, {delimiter}) AS _cells")
    text = cells.selectExpr(
        *kept, "size(_cells) AS _fields", *[f"get(_cells, {i}) AS _{name}" for i, name in enumerate(names)]
    )
    numbers = text.selectExpr("*", *[f"{number_sql(f'_{c}')} AS _n_{c}" for c in [*PRICES, *COUNTS]])
    broken = " OR ".join(fractional_sql(f"_{c}", f"_n_{c}") for c in COUNTS)
    return numbers.selectExpr(
        *kept,
        *[f"nullif(_{c}, '') AS {c}" for c in ("date", "time")],
        *[f"_n_{c} AS {c}" for c in PRICES],
        *[f"{count_sql(f'_{c}', f'_n_{c}')} AS {c}" for c in COUNTS],
        f"_fields > {len(RAW_COLUMNS)} AS too_many_fields",
        f"({broken}) AS fractional_count",
    )


def with_delimiters(lines: DataFrame, audit: DataFrame) -> DataFrame:
    """Attach each file's delimiter to its lines; a huge file stays spread over many tasks."""
    return join_series_values(lines, audit.select("file", "delimiter"), ["file"], "line_no")


def require_typed(typed: DataFrame) -> None:
    """Refuse files with lines of too many fields or with counts that are not integers."""
    bad = typed.where(F.col("too_many_fields") | F.col("fractional_count")).select("file").distinct()
    refuse(bad, ExportLayoutError, "too many fields in a line or a fractional count")


def with_identity(rows: DataFrame) -> DataFrame:
    identity = identity_columns(F.col("file"))
    return rows.select(*[c for c in rows.columns if c not in SERIES], *identity[:2])
