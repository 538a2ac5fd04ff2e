"""Scan of raw export files: discovery, line numbers and typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from candlewarden.functions.session import materialise
from candlewarden.operators import parse
from candlewarden.schema import SERIES, ExportLayoutError

GLOB = "*.csv"
SPLIT = ["file", "block"]


def discover(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(file, path, bytes) of the exports in ``raw_dir``; FileNotFoundError when there are none.

    Listing only: the binary source does not read a column nobody asks for. It skips files without a
    single byte, which have no header either and are refused.
    """
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load(raw_dir)
        listed = len(listing.inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = 0
    if not listed:
        raise FileNotFoundError(f"no CSV files in {raw_dir}")
    files = listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "path", F.col("length").alias("bytes")
    )
    empty = listed - files.count()
    if empty:
        raise ExportLayoutError(f"{empty} empty CSV file(s) in {raw_dir}")
    return files


def identities(files: DataFrame) -> DataFrame:
    """Identity of every file; ValueError naming the files that are not exports.

    One series has one source: of several exports of it the last by name counts, as if they had been
    ingested one after another.
    """
    audit = parse.file_identity(files)
    parse.refuse(audit.where(~F.col("ok")), ValueError, "a name other than SYMBOL_TF_start_end.csv")
    latest = audit.groupBy(*SERIES).agg(F.max("file").alias("file"))
    return audit.join(latest, [*SERIES, "file"], "left_semi")


def superseded(files: DataFrame) -> DataFrame:
    """Exports that do not count because a later one of the same series is there: file, series, and the one that counts."""
    audit = parse.file_identity(files).where("ok")
    latest = audit.groupBy(*SERIES).agg(F.max("file").alias("counting_file"))
    return audit.join(latest, SERIES).where("file <> counting_file").select("file", *SERIES, "counting_file")


def stored_lines(spark: SparkSession, raw_dir: str, glob: str = GLOB) -> DataFrame:
    """Every line with file, split start and a row id that grows along the file, written once.

    The row id depends on how the scan was split, so everything that uses it reads this table. ``empty``
    lines have nothing but blanks, ``white`` lines nothing but blanks and tabs.
    """
    text = spark.read.option("pathGlobFilter", glob).text(raw_dir).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        (F.btrim("value", F.lit(" ")) == "").alias("empty"),
        (F.btrim("value", F.lit(" \t")) == "").alias("white"),
    )
    return materialise(text.withColumn("row_id", F.monotonically_increasing_id()), "lines")


def split_offsets(stored: DataFrame) -> DataFrame:
    """Per file split: its first row id and the number of lines in the splits before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.groupBy(*SPLIT)
        .agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .select(*SPLIT, "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )


def data_splits(stored: DataFrame, delimiters: DataFrame) -> DataFrame:
    """Per split of the listed files (file, delimiter): first row id, its blank lines, and the lines before it.

    Blank lines are no data. A tab is white space only where it is not the delimiter.
    """
    counts = stored.groupBy(*SPLIT).agg(
        F.min("row_id").alias("first_id"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if("empty").alias("_empty"),
        F.count_if("white").alias("_white"),
    )
    blank = F.when(F.col("delimiter") == "\t", F.col("_empty")).otherwise(F.col("_white"))
    sized = counts.join(delimiters, "file").withColumn("blank_lines", blank)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def earlier(n) -> Column:
        return F.coalesce(F.sum(n).over(before), F.lit(0))

    return sized.select(
        *SPLIT, "delimiter", "first_id", "blank_lines",
        earlier(F.col("_n")).alias("lines_before"), earlier(F.col("_n") - F.col("blank_lines")).alias("data_before"),
    )


def first_lines(stored: DataFrame) -> DataFrame:
    """The first line of every file, reduced inside each task before anything is shuffled."""
    return (
        stored.where(F.col("block") == 0)
        .groupBy("file")
        .agg(F.min_by("value", "row_id").alias("value"))
        .withColumn("line_no", F.lit(1))
    )


def numbered(stored: DataFrame, splits: DataFrame) -> DataFrame:
    """Line numbers from 1, counted over all lines.

    One file may be a large part of the input, so lines are numbered inside their split and shifted by
    the lines before it. The split table has been written, so Spark broadcasts it if it is small; a
    large one joins on (file, block), whose groups are no larger than a split.
    """
    number = F.col("offset") + F.col("row_id") - F.col("first_id") + 1
    return (
        stored.join(splits, SPLIT)
        .withColumn("line_no", number)
        .drop("block", "row_id", "first_id", "offset")
    )


def data_lines(stored: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, line_no, physical_line, value, delimiter) of the lines that are not blank.

    ``line_no`` counts them from 1, as the loader of such exports does; ``physical_line`` is the place in the file.
    Both are shifts of the row id, except in splits with blank lines, whose lines are counted by themselves.
    """
    lines = stored.join(splits, SPLIT)
    lines = lines.withColumn("physical_line", F.col("lines_before") + F.col("row_id") - F.col("first_id") + 1)
    inside = Window.partitionBy(*SPLIT).orderBy("row_id")
    blank = F.col("empty") | (F.col("white") & (F.col("delimiter") != "\t"))
    whole = lines.where("blank_lines = 0").withColumn("line_no", F.col("data_before") + F.col("row_id") - F.col("first_id") + 1)
    holed = lines.where((F.col("blank_lines") > 0) & ~blank).withColumn("line_no", F.col("data_before") + F.row_number().over(inside))
    return whole.unionByName(holed).select("file", "line_no", "physical_line", "value", "delimiter")


def read_lines(spark: SparkSession, raw_dir: str, glob: str = GLOB) -> DataFrame:
    """(file, line_no, value) for every line that is not empty, the first line of a file being 1."""
    stored = stored_lines(spark, raw_dir, glob=glob)
    files = stored.select("file").distinct().withColumn("delimiter", F.lit("\t"))
    splits = materialise(data_splits(stored, files), "splits")
    return data_lines(stored, splits).select("file", "line_no", "value")


def read_raw(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all exports with symbol and timeframe, and the identity of their files.

    Lines are written twice, as text and typed. The split table carries the delimiter of its file and
    lists only the files that count, so one join numbers, delimits and selects the lines. The header is the
    first line of a file, blank or not, so a file that begins with a blank line is refused.
    """
    known = materialise(identities(discover(spark, raw_dir)), "files")
    stored = stored_lines(spark, raw_dir)
    audit = known.select("file").join(parse.header_audit(first_lines(stored)), "file", "left")
    audit = materialise(audit.withColumn("ok", F.coalesce("ok", F.lit(False))), "headers")
    parse.require_headers(audit)
    splits = materialise(data_splits(stored, audit.select("file", "delimiter")), "splits")
    typed = materialise(parse.with_ts(parse.typed_rows(data_lines(stored, splits), "delimiter")), "typed")
    parse.require_typed(typed)
    return parse.with_identity(typed), known
