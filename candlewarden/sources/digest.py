"""Digests of source files and of canonical content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.functions.session import materialise
from candlewarden.schema import CANONICAL, SERIES
from candlewarden.sources.files import numbered, split_offsets

LANES = 4
LANE_DIGITS = 16
LANE_COLUMNS = [f"_lane{i}" for i in range(LANES)]


def _lane_sums(digest: str) -> list[Column]:
    """Sums of the four 64-bit lanes of a hexadecimal SHA-256 column."""
    lanes = [
        F.conv(F.substring(digest, 1 + i * LANE_DIGITS, LANE_DIGITS), 16, 10).cast("decimal(28,0)") for i in range(LANES)
    ]
    return [F.sum(lane).alias(name) for name, lane in zip(LANE_COLUMNS, lanes, strict=True)]


def row_digest() -> Column:
    """SHA-256 of one row's canonical values; NULL has its own token, as concat_ws would skip it."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in CANONICAL]
    return F.sha2(F.concat_ws("|", *cells), 256)


def leaf_sums(bars: DataFrame, *more: str) -> DataFrame:
    """Leaves of the digest tree: rows and lane sums of every (symbol, timeframe, month), by ``more`` columns too.

    The four 64-bit lanes of the row digests are added up, which needs no sort, no list of rows and
    combines map-side. Sums of leaves are the sums of their rows, so any level is made from the one below.
    """
    hashed = bars.select(*SERIES, *more, F.date_format("ts", "yyyy-MM").alias("month"), row_digest().alias("_h"))
    return hashed.groupBy(*SERIES, "month", *more).agg(F.count(F.lit(1)).alias("rows"), *_lane_sums("_h"))


def node_digest(leaves: DataFrame, *keys: str) -> DataFrame:
    """(keys, rows, sha256) of the nodes above ``leaves``: their lanes are added up and hashed with the row count."""
    sums = leaves.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in LANE_COLUMNS]
    )
    cells = [F.lit(",".join(CANONICAL)), F.col("rows").cast("string"), *[F.col(c).cast("string") for c in LANE_COLUMNS]]
    return sums.select(*keys, "rows", F.sha2(F.concat_ws("|", *cells), 256).alias("sha256"))


def month_digest(bars: DataFrame) -> DataFrame:
    """(symbol, timeframe, month, rows, month_sha256): the nodes that tell where two contents differ."""
    return node_digest(leaf_sums(bars), *SERIES, "month").withColumnRenamed("sha256", "month_sha256")


def content_digest(bars: DataFrame) -> DataFrame:
    """(symbol, timeframe, rows, content_sha256), independent of row order, files and extra columns."""
    return node_digest(leaf_sums(bars), *SERIES).withColumnRenamed("sha256", "content_sha256")


def lines_digest(lines: DataFrame) -> DataFrame:
    """(file, source_size_bytes, source_sha256) from every line of each file: file, line_no, line_sha256, size.

    A line is hashed with its place in the file, the lanes of these hashes are added up per file, and
    the sums are hashed with the size and the number of lines. Any share of the input may be one file.
    """
    placed = lines.select("file", "size", F.sha2(F.concat_ws("|", "line_no", "line_sha256"), 256).alias("_h"))
    sums = placed.groupBy("file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), *_lane_sums("_h"))
    cells = [F.col("size").cast("string"), F.col("n").cast("string"), *[F.col(c).cast("string") for c in LANE_COLUMNS]]
    return sums.select("file", F.col("size").alias("source_size_bytes"), F.sha2(F.concat_ws("|", *cells), 256).alias("source_sha256"))


def source_digest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, source_size_bytes, source_sha256) of every file at ``path`` that has a byte.

    Files are cut at line feeds only, so carriage returns and blank lines count, and the size tells
    whether the last line ends. Splits of a file are read in parallel, from any file system Spark reads;
    how a file was split does not change its digest.
    """
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.sha2(F.col("value").cast("binary"), 256).alias("line_sha256"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    stored = materialise(text, "line_digests")
    return lines_digest(numbered(stored, materialise(split_offsets(stored), "splits")))
