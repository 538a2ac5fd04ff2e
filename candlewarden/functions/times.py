"""Time arithmetic on TIMESTAMP_NTZ columns, independent of the session time zone.

Arguments are SQL expressions, usually column names; results are columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 24 * 60 * MICROS_PER_MINUTE

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros_sql(start: str, end: str) -> str:
    """``end - start`` in whole microseconds.

    Subtracting two NTZ values never consults the session zone, unlike ``timestampdiff``.
    """
    return f"CAST(CAST(CAST({end} - {start} AS INTERVAL SECOND) AS DECIMAL(18,6)) * 1000000 AS BIGINT)"


def micros_between(start: str, end: str) -> Column:
    return F.expr(micros_sql(start, end))


def order_key(ts: str, tie: str) -> Column:
    """One orderable number for (ts, tie).

    A decimal is a fixed-width aggregation buffer, so ``min_by``/``max_by`` over it stay in a hash
    aggregate; a struct key would force sorting all rows before the map-side aggregation.
    """
    micros = f"CAST({micros_sql(EPOCH, ts)} AS DECIMAL(18,0))"
    return F.expr(f"CAST({micros} * CAST('20000000000000000000' AS DECIMAL(20,0)) + {tie} AS DECIMAL(38,0))")


def minute_of_day_sql(ts: str) -> str:
    return f"(hour({ts}) * 60 + minute({ts}))"


def floor_to(ts: str, minutes: int | str) -> Column:
    """Start of the bucket of ``minutes`` (a divisor of 1440, literal or column) that holds ``ts``."""
    inside = minute_of_day_sql(ts)
    midnight = f"CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ)"
    return F.expr(f"{midnight} + make_dt_interval(0, 0, {inside} - {inside} % {minutes})")
