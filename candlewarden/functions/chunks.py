"""Ordered operations over long series without one task per series.

A window partitioned by series alone puts a whole series into one task. Here a series is cut into
chunks that follow its order, the window runs inside (series, chunk), and what crosses a chunk border
is carried in a table with one row per chunk. Canonical bars have unique timestamps, so a month of one
series is bounded by its grid; frames that are not canonical yet are chunked by line number instead.
Chunk tables join on (series, chunk), the partitioning the rows already have, so the rows are shuffled
once and never meet a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.functions.session import materialise

CHUNK = "_chunk"
HALO = "_halo"
LINES_PER_CHUNK = 100_000


def chunk_of(order: str) -> Column:
    """Order-preserving chunk number: calendar month of ``ts``, or a block of line numbers."""
    if order == "ts":
        return F.year("ts") * 12 + F.month("ts")
    return F.floor(F.col(order) / LINES_PER_CHUNK).cast("bigint")


def with_chunk(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn(CHUNK, chunk_of(order))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, str],
    series_values: DataFrame | None = None,
) -> DataFrame:
    """Add ``{new: source}`` columns holding the source value of the preceding row of the series.

    ``series_values`` has one row per series. Its columns travel to the rows inside the chunk table, so
    they cost no second join of the rows and a long series stays spread out.
    """
    rows = with_chunk(df, order)
    part = [*keys, CHUNK]
    last = rows.groupBy(*part).agg(
        *[F.max_by(source, order).alias(f"_last_{new}") for new, source in columns.items()]
    )
    over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = last.select(
        *part, *[F.lag(f"_last_{new}").over(over_chunks).alias(f"_carry_{new}") for new in columns]
    )
    given = []
    if series_values is not None:
        given = [c for c in series_values.columns if c not in keys]
        carry = carry.join(series_values, list(keys), "left")
    inside = Window.partitionBy(*part).orderBy(order)
    numbered = rows.select(
        "*",
        F.row_number().over(inside).alias("_row"),
        *[F.lag(source).over(inside).alias(f"_lag_{new}") for new, source in columns.items()],
    )
    joined = numbered.join(carry, part, "left")
    picked = [
        F.when(F.col("_row") == 1, F.col(f"_carry_{new}")).otherwise(F.col(f"_lag_{new}")).alias(new)
        for new in columns
    ]
    return joined.select(*df.columns, *picked, *given)


def with_halo(
    df: DataFrame, keys: Sequence[str], order: str, before: int = 0, after: int = 0
) -> DataFrame:
    """Give every chunk copies of the ``before`` rows ahead of it and the ``after`` rows behind it.

    A frame that reaches at most that far then gives the same result inside (series, chunk) as over
    the whole series. Copies are marked in ``_halo`` and must be dropped after the window.
    """
    rows = with_chunk(df, order)
    out = rows.withColumn(HALO, F.lit(False))
    if before:
        out = out.unionByName(_copies(rows, df.columns, keys, order, before, ahead=True))
    if after:
        out = out.unionByName(_copies(rows, df.columns, keys, order, after, ahead=False))
    return out


def _copies(rows, columns, keys, order, n, ahead: bool) -> DataFrame:
    """Border rows of each chunk, addressed to the neighbouring chunk that needs them."""
    edge_first = F.col(order).desc() if ahead else F.col(order).asc()
    edge = Window.partitionBy(*keys, CHUNK).orderBy(edge_first)
    # row_number() <= n lets Spark cut each chunk to n rows before the shuffle
    border = rows.withColumn("_rank", F.row_number().over(edge)).where(F.col("_rank") <= n)
    series = Window.partitionBy(*keys).orderBy(order)
    frame = series.rowsBetween(1 - n, 0) if ahead else series.rowsBetween(0, n - 1)
    payload = F.struct(*[F.col(c) for c in columns])
    reach = border.select(*keys, CHUNK, "_rank", F.collect_list(payload).over(frame).alias("_rows"))
    reach = reach.where(F.col("_rank") == 1)
    over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    target = F.lead(CHUNK) if ahead else F.lag(CHUNK)
    addressed = reach.select("_rows", target.over(over_chunks).alias(CHUNK))
    return (
        addressed.where(F.col(CHUNK).isNotNull())
        .select(CHUNK, F.explode("_rows").alias("_copy"))
        .select("_copy.*", CHUNK, F.lit(True).alias(HALO))
    )


def halo_window(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def with_running(
    df: DataFrame, keys: Sequence[str], order: str, value: str, total: str, count: str
) -> DataFrame:
    """Add the running sum and running count of ``value`` (NULLs skipped) along each series.

    Chunk totals are read off the last running value, not from a grouped sum, so the order of the
    additions is fixed and a prefix of the data gives bit-identical results.
    """
    part = [*keys, CHUNK]
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = with_chunk(df, order).select(
        "*",
        F.coalesce(F.sum(value).over(inside), F.lit(0.0)).alias("_sum"),
        F.count(value).over(inside).alias("_count"),
    )
    ends = rows.groupBy(*part).agg(
        F.max_by("_sum", order).alias("_end_sum"), F.max("_count").alias("_end_count")
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *part,
        F.coalesce(F.sum("_end_sum").over(earlier), F.lit(0.0)).alias("_before_sum"),
        F.coalesce(F.sum("_end_count").over(earlier), F.lit(0)).alias("_before_count"),
    )
    return rows.join(carry, part, "left").select(
        *df.columns,
        (F.col("_before_sum") + F.col("_sum")).alias(total),
        (F.col("_before_count") + F.col("_count")).alias(count),
    )


def with_position(df: DataFrame, keys: Sequence[str], order: str, position: str) -> DataFrame:
    """Add the 1-based position of each row in its series, counted chunk by chunk."""
    part = [*keys, CHUNK]
    rows = with_chunk(df, order)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*part).orderBy(order)
    return (
        rows.withColumn("_row", F.row_number().over(inside))
        .join(carry, part, "left")
        .select(*df.columns, (F.col("_before") + F.col("_row")).alias(position))
    )


SMALL = 10_000  # values that every task may hold: one row per series, counted before they are broadcast
HOT = 200  # a key with more than one in so many rows is split


def hot_salts(rows: DataFrame, keys: Sequence[str], hot: int = HOT) -> DataFrame:
    """(keys, _salts) for the keys that hold more than one in ``hot`` of the rows.

    Fewer than ``hot`` keys can, whatever the number of keys. A key gets as many salts as it takes to bring
    each down to that share. Only the key columns are read, and they are counted map-side.
    """
    known = rows.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    sizes = materialise(known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 1
    found = sizes.where(F.col("_n") * hot > total).select(*keys, F.ceil(F.col("_n") * hot / total).cast("int").alias("_salts"))
    return rows.sparkSession.createDataFrame(found.collect(), found.schema)


def join_series_values(rows: DataFrame, values: DataFrame, keys: Sequence[str], salt_by: str) -> DataFrame:
    """Left-join values, one row per key, onto rows, whatever share of the rows a key holds.

    The values are written and counted. Up to ``SMALL`` of them are broadcast, and the rows stay where they
    are. Beyond that both sides are shuffled by key; keys that hold a large share of the rows are measured
    and dealt over salts by a hash of ``salt_by``, and only their values are copied, once per salt. Rows
    with a null key get no values, and are dealt over as many tasks as there are.
    """
    values = materialise(values, "series-values")
    if values.count() <= SMALL:
        return rows.join(F.broadcast(values), list(keys), "left")
    marks = F.broadcast(hot_salts(rows, keys))
    unknown = F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    salt = F.when(unknown, F.hash(salt_by)).when(F.col("_salts").isNotNull(), F.pmod(F.hash(salt_by), F.col("_salts"))).otherwise(0)
    salted = rows.join(marks, list(keys), "left").withColumn("_salt", salt).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = values.join(marks, list(keys), "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")


def of_series(rows: DataFrame, series: DataFrame, keys: Sequence[str], salt_by: str, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of the listed series, with ``columns`` of the list, protected against a dominating series alike."""
    marked = series.select(*keys, *columns).withColumn("_listed", F.lit(True))
    return join_series_values(rows, marked, keys, salt_by).where("_listed").drop("_listed")
