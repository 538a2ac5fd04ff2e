"""Canonical tables on disk: clustered files, snapshots, manifests, and verification of what is read back.

A store is a folder of tables. Nothing in it is ever changed in place: a ``Change`` writes new folders and
then appends one row to the pointer table, which makes them the current snapshot. A reader sees the state
of the last row of the pointer, so an ingest that dies at any step leaves the old state.

    pointer/                          one row per snapshot
    manifests/snapshot=<id>/          one row per series, saying which change wrote its bars
    bars/change=<id>/bucket=<k>/      bars of a change; buckets by hash of the symbol, files by range of
                                      (symbol, timeframe, ts), so folders do not grow with symbols
    digests/change=<id>/              leaves of the digest tree by file, series and month, read back from the files
    conflicts, superseded, ingested   tables of the last ingest, by snapshot
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyspark
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

import candlewarden
from candlewarden.functions.chunks import of_series
from candlewarden.functions.session import delete
from candlewarden.schema import BAR_SCHEMA, CANONICAL, SCHEMA_VERSION, SERIES, TIMEZONE_LABEL
from candlewarden.sources.digest import LANE_COLUMNS, leaf_sums, node_digest

BARS = "bars"
MANIFESTS = "manifests"
DIGESTS = "digests"
POINTER = "pointer"
BUCKETS = 64
NAMED_FILES = 500  # changed files that a scan is told by name; more are found by reading all
LOG_FIELDS = [
    "rows_in",
    "rows_out",
    "dropped_unparseable_timestamp",
    "dropped_nan_ohlc",
    "exact_duplicates_removed",
    "conflicting_duplicate_groups",
    "conflicting_duplicate_rows_removed",
    "filled_tick_volume",
    "filled_volume",
    "filled_spread",
]

MANIFEST_SCHEMA = T.StructType(
    [
        *[
            T.StructField(c, T.StringType())
            for c in (
                "dataset_id",
                "schema_version",
                "timezone",
                "source_filename",
                "source_sha256",
                "declared_start",
                "declared_end",
                "content_sha256",
                "first_ts",
                "last_ts",
                "created_at_utc",
                "engine_version",
                "spark_version",
            )
        ],
        T.StructField("source_size_bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField(
            "normalization",
            T.StructType(
                [*[T.StructField(c, T.LongType()) for c in LOG_FIELDS], T.StructField("reordered", T.BooleanType())]
            ),
        ),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("change_series", T.LongType()),
    ]
)
#: What a file says about itself, beside its bars: equal values of a series, which take next to no room.
STAMPS = ["schema_version", "content_sha256"]
STORED_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in STAMPS], T.StructField("change", T.StringType()), T.StructField("bucket", T.LongType())]
)
_FILE = ["file", "file_bytes", "file_time"]
POINTER_DDL = "number bigint, id string, buckets bigint, at timestamp"


@dataclass(frozen=True)
class Snapshot:
    number: int
    id: str
    buckets: int


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The last committed snapshot; of two with one number the earlier."""
    try:
        row = spark.read.schema(POINTER_DDL).json(f"{root}/{POINTER}").orderBy(F.desc("number"), "at", "id").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and Snapshot(row["number"], row["id"], row["buckets"])


def bucket_of(symbol: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("bigint")


class Change:
    """A state that is being written; it counts once ``commit`` has appended to the pointer."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.base, self.id = spark, root, current(spark, root), uuid.uuid4().hex
        self.buckets = self.base.buckets if self.base else buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/{'change' if table in (BARS, DIGESTS) else 'snapshot'}={self.id}"

    def write(self, df: DataFrame, table: str) -> None:
        df.write.option("compression", "zstd").parquet(self.path(table))

    def write_bars(self, bars: DataFrame, manifests: DataFrame) -> None:
        """Write canonical bars, and the digests of what was stored."""
        self.write_files(bars, manifests)
        self.write(leaves(_stored(self.spark, self.root, [self.id])), DIGESTS)

    def write_files(self, bars: DataFrame, manifests: DataFrame, mode: str = "errorifexists") -> None:
        """Write canonical bars, stamped with version and content hash of their series.

        Ranges of (bucket, series, ts) give tasks of equal size, so a long series is split by time instead of
        landing in one task, and row-group statistics on symbol and ``ts`` are selective. A folder has one file
        per range that touches its bucket.
        """
        note = {"schema_version": SCHEMA_VERSION, "timezone": TIMEZONE_LABEL}
        columns = [F.col(c).alias(c, metadata=note) for c in [*CANONICAL, "line_no"]]
        order = ["bucket", *SERIES, "ts"]
        stamped = of_series(bars.select(*CANONICAL, "line_no", *SERIES), manifests.where("rows > 0"), SERIES, "ts", STAMPS)
        (
            stamped.select(*columns, *SERIES, *STAMPS, bucket_of(F.col("symbol"), self.buckets).alias("bucket"))
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode(mode)
            .option("compression", "zstd")
            .partitionBy("bucket")
            .parquet(self.path(BARS))
        )

    def check(self, manifests: DataFrame) -> None:
        """RuntimeError if what is stored differs from what the manifests say."""
        digests = self.spark.read.parquet(self.path(DIGESTS))
        bad = compare(manifests, series_nodes(digests)).where("NOT ok")
        n = bad.count()
        if n:
            raise RuntimeError(f"{n} dataset(s) differ after reload, first {bad.select(F.concat_ws('_', *SERIES)).first()[0]}")

    def write_manifests(self, manifests: DataFrame) -> None:
        """The manifests of this change and those of all other series, as one table."""
        with_bars = manifests.where("rows > 0").count()
        new = manifests.select("*", F.lit(self.id).alias("change"), F.lit(with_bars).cast("bigint").alias("change_series"))
        new = new.select(*MANIFEST_SCHEMA.names)
        if self.base:
            old = _manifests(self.spark, self.root, self.base).join(new.select(*SERIES), SERIES, "left_anti")
            new = new.unionByName(old.select(*MANIFEST_SCHEMA.names))
        self.write(new.repartitionByRange(*SERIES).sortWithinPartitions(*SERIES), MANIFESTS)

    def commit(self) -> Snapshot:
        """Make this the current snapshot: one file is renamed into the pointer table.

        There should be one writer at a time. Of two that began from one snapshot the later is refused.
        """
        made = Snapshot(self.base.number + 1 if self.base else 1, self.id, self.buckets)
        row = self.spark.createDataFrame([(made.number, made.id, made.buckets)], "number bigint, id string, buckets bigint")
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{self.root}/{POINTER}")
        found = current(self.spark, self.root)
        if found != made:
            raise RuntimeError(f"another change was committed meanwhile: {found}")
        return made


def _stored(spark: SparkSession, root: str, changes: Sequence[str]) -> DataFrame:
    """Stored rows of some changes with their stamps, change and bucket."""
    if not changes:
        return spark.createDataFrame([], STORED_SCHEMA)
    paths = [f"{root}/{BARS}/change={c}" for c in changes]
    try:
        return spark.read.schema(STORED_SCHEMA).option("basePath", f"{root}/{BARS}").parquet(*paths)
    except AnalysisException as e:
        # a change whose exports had no usable row wrote a folder without files
        if e.getCondition() != "PATH_NOT_FOUND" or len(paths) > 1:
            raise
        return spark.createDataFrame([], STORED_SCHEMA)


def _manifests(spark: SparkSession, root: str, at: Snapshot) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{MANIFESTS}/snapshot={at.id}")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per series of the current snapshot; empty for a folder that is no store yet."""
    at = current(spark, root)
    return _manifests(spark, root, at) if at else spark.createDataFrame([], MANIFEST_SCHEMA)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table that the last ingest wrote beside the bars."""
    return spark.read.parquet(f"{root}/{table}/snapshot={current(spark, root).id}")


def _of_ids(df: DataFrame, ids: Sequence[str] | None) -> DataFrame:
    """Rows of the named datasets. Both parts are filtered by themselves as well, which Parquet statistics understand."""
    if ids is None:
        return df
    parts = [i.rpartition("_") for i in ids]
    symbols, frames = sorted({p[0] for p in parts}), sorted({p[2] for p in parts})
    return df.where(F.col("symbol").isin(symbols) & F.col("timeframe").isin(frames) & F.concat_ws("_", *SERIES).isin(list(ids)))


def read_stored(spark: SparkSession, root: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Bars of the current snapshot with the stamps of their files; ``ids`` prune buckets and row groups.

    Changes none of whose series has been replaced since are read as they are. Of the others only the rows of
    series that still belong to them count.
    """
    at = current(spark, root)
    if at is None:
        return spark.createDataFrame([], STORED_SCHEMA)
    live = _manifests(spark, root, at).where("rows > 0")
    # a row per change, not per series
    changes = live.groupBy("change").agg(F.count("*").alias("n"), F.max("change_series").alias("of")).collect()
    whole = [r["change"] for r in changes if r["n"] == r["of"]]
    partly = [r["change"] for r in changes if r["n"] != r["of"]]
    rows = _stored(spark, root, whole)
    if partly:
        kept = _stored(spark, root, partly).join(live.select(*SERIES, "change"), [*SERIES, "change"], "left_semi")
        rows = rows.unionByName(kept.select(*rows.columns)) if whole else kept.select(*STORED_SCHEMA.names)
    if ids is not None:
        buckets = [bucket_of(F.lit(s), at.buckets) for s in sorted({i.rpartition("_")[0] for i in ids})]
        rows = _of_ids(rows.where(F.col("bucket").isin(buckets)), ids)
    return rows


def read_bars(spark: SparkSession, root: str, ids: Sequence[str] | None = None) -> DataFrame:
    """All stored bars, or those of the named datasets; filters on symbol and ts prune row groups."""
    return read_stored(spark, root, ids).select(*BAR_SCHEMA.names)


def leaves(stored: DataFrame) -> DataFrame:
    """Leaves of the digest tree with the file that holds the rows, and what the file says about their series."""
    said = stored.select(
        *SERIES,
        *CANONICAL,
        *STAMPS,
        "change",
        F.concat_ws("/", F.concat(F.lit("bucket="), F.col("bucket").cast("string")), F.col("_metadata.file_name")).alias("file"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )
    return leaf_sums(said, *_FILE, "change", *STAMPS)


def series_nodes(found: DataFrame) -> DataFrame:
    """Per series: rows, actual_sha256 and the versions and hashes that its files state."""
    nodes = node_digest(found, *SERIES).withColumnRenamed("sha256", "actual_sha256")
    said = found.groupBy(*SERIES).agg(*[f(c).alias(f"{name}_{c}") for c in STAMPS for name, f in (("low", F.min), ("high", F.max))])
    return nodes.join(said, SERIES)


def compare(manifests: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per manifest: expected and actual digest, ``ok`` and what is wrong."""
    wanted = manifests.select(*SERIES, "schema_version", "rows", F.col("content_sha256").alias("expected_sha256"))
    joined = wanted.withColumnRenamed("rows", "_rows").join(nodes, SERIES, "left")
    same = F.col("expected_sha256").eqNullSafe(F.col("actual_sha256"))

    def stated(column: str, value: Column) -> Column:
        low, high = (F.col(f"{x}_{column}") for x in ("low", "high"))
        return F.col("actual_sha256").isNull() | (low.eqNullSafe(value) & high.eqNullSafe(value))

    problem = (
        F.when(~same | (F.coalesce("rows", F.lit(0)) != F.coalesce("_rows", F.lit(0))), "content hash mismatch")
        .when((F.col("schema_version") != SCHEMA_VERSION) | ~stated("schema_version", F.lit(SCHEMA_VERSION)), "schema version")
        .when(~stated("content_sha256", F.col("expected_sha256")), "content hash in file")
    )
    return joined.select(
        *SERIES,
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        "expected_sha256",
        "actual_sha256",
        F.col("high_schema_version").alias("file_schema_version"),
        problem.isNull().alias("ok"),
        problem.alias("problem"),
    )


def verify_datasets(spark: SparkSession, root: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Verify the named datasets, or all with a manifest; an id without manifest is reported as failed.

    All rows are read again and digested in one grouped job; a failing series does not stop the others.
    Content, schema version and the hash that the files state are compared with the manifest.
    """
    result = compare(_of_ids(read_manifests(spark, root), ids), series_nodes(leaves(read_stored(spark, root, ids))))
    if ids is None:
        return result
    asked = spark.createDataFrame([(i.rpartition("_")[0], i.rpartition("_")[2]) for i in ids], "symbol string, timeframe string")
    joined = asked.join(result, SERIES, "left")
    return joined.withColumn("ok", F.coalesce("ok", F.lit(False))).withColumn(
        "problem", F.when(~F.col("ok"), F.coalesce("problem", F.lit("no manifest")))
    )


def recorded(spark: SparkSession, root: str) -> DataFrame:
    """The leaves that were read back when the live bars were written."""
    live = read_manifests(spark, root).where("rows > 0").select(*SERIES, "change")
    changes = [r[0] for r in live.select("change").distinct().collect()]
    if not changes:
        return spark.createDataFrame([], leaves(_stored(spark, root, [])).schema)
    known = spark.read.option("basePath", f"{root}/{DIGESTS}").parquet(*[f"{root}/{DIGESTS}/change={c}" for c in changes])
    return known.join(live, [*SERIES, "change"], "left_semi")


def file_states(spark: SparkSession, root: str, changes: Sequence[str]) -> DataFrame:
    """(change, file, bytes, time) of the data files as they are now: a listing, no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    listed = reader.load([f"{root}/{BARS}/change={c}" for c in changes])
    return listed.select(
        F.regexp_extract("path", r"/change=([^/]+)/bucket=[^/]+/[^/]+$", 1).alias("change"),
        F.regexp_extract("path", r"/(bucket=[^/]+/[^/]+)$", 1).alias("file"),
        F.col("length").alias("bytes_now"),
        F.col("modificationTime").alias("time_now"),
    )


def verify_months(spark: SparkSession, root: str, changed_only: bool = False) -> DataFrame:
    """The months whose stored rows are not those that were written: symbol, timeframe, month, rows, expected_rows.

    With ``changed_only`` files of unchanged size and time are trusted, and only the others are read again;
    files that are missing or were not there before count as changed.
    """
    known = recorded(spark, root)
    if not changed_only:
        return differing_months(known, leaves(read_stored(spark, root)))
    changes = [r[0] for r in known.select("change").distinct().collect()]
    if not changes:
        return differing_months(known, known)
    before = known.select("change", *_FILE).distinct()
    both = before.join(file_states(spark, root, changes), ["change", "file"], "full_outer")
    same = F.col("file_bytes").eqNullSafe(F.col("bytes_now")) & F.col("file_time").eqNullSafe(F.col("time_now"))
    touched = both.where(~same).select("change", "file")
    names = [r["file"].rpartition("/")[2] for r in touched.head(NAMED_FILES + 1)]
    stored = read_stored(spark, root)
    if len(names) <= NAMED_FILES:  # file names are unique, and Spark opens only those
        stored = stored.where(F.col("_metadata.file_name").isin(names))
    keys = ["change", "file"]
    return differing_months(known.join(touched, keys, "left_semi"), leaves(stored).join(touched, keys, "left_semi"))


def differing_months(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Month nodes of two sets of leaves that are not equal; a side that has no rows counts 0."""
    keys = [*SERIES, "month"]
    a = node_digest(expected, *keys).withColumnsRenamed({"rows": "expected_rows", "sha256": "_a"})
    b = node_digest(actual, *keys).withColumnRenamed("sha256", "_b")
    zero = F.lit(0).cast("bigint")
    return a.join(b, keys, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(
        *keys, F.coalesce("rows", zero).alias("rows"), F.coalesce("expected_rows", zero).alias("expected_rows")
    )


def column_drift(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, timeframe, column, rows_without): canonical columns that a series' files lack, in whole or in part.

    A column that is missing from a file reads as null, and canonical columns have no nulls; so a
    row without a value shows a file without the column, or one with a hole.
    """
    stored = read_stored(spark, root)
    lacking = stored.groupBy(*SERIES).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in CANONICAL])
    pairs = ", ".join(f"'{c}', `{c}`" for c in CANONICAL)
    return lacking.selectExpr(*SERIES, f"stack({len(CANONICAL)}, {pairs}) AS (column, rows_without)").where("rows_without > 0")


def compact(spark: SparkSession, root: str) -> Snapshot:
    """Write the live rows of all changes as one, so that readers need no longer look for replaced series."""
    change = Change(spark, root)
    manifests = read_manifests(spark, root)
    change.write_bars(read_bars(spark, root), manifests)
    change.check(manifests)
    change.write_manifests(manifests.drop("change", "change_series"))
    for table in tables_of(spark, root):
        change.write(read_table(spark, root, table), table)
    return change.commit()


def tables_of(spark: SparkSession, root: str) -> list[str]:
    """Which of the tables of an ingest the current snapshot has."""
    found = []
    for table in ("conflicts", "superseded", "ingested"):
        try:
            read_table(spark, root, table)
            found.append(table)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete snapshots before the last ``keep``, and changes that none of the kept has; returns the deleted folders.

    Only for stores that nobody writes to at the time; a reader of a deleted snapshot fails. It needs a session
    that can delete folders (not Spark Connect); everything else here does without.
    """
    rows = spark.read.schema(POINTER_DDL).json(f"{root}/{POINTER}").orderBy(F.desc("number"), "at", "id").collect()
    kept = [Snapshot(r["number"], r["id"], r["buckets"]) for r in rows[:keep]]
    live = {r[0] for at in kept for r in _manifests(spark, root, at).select("change").distinct().collect()}
    dead = [r["id"] for r in rows if r["id"] not in live]
    gone = [f"{root}/{t}/change={i}" for i in dead for t in (BARS, DIGESTS)]
    gone += [f"{root}/{t}/snapshot={r['id']}" for r in rows[keep:] for t in (MANIFESTS, "conflicts", "superseded", "ingested")]
    for path in gone:
        delete(spark, path)
    return gone


def build_manifest(
    identity: DataFrame, sources: DataFrame, digests: DataFrame, covered: DataFrame, log: DataFrame
) -> DataFrame:
    """One provenance row per series; a series without any usable row is kept with 0 rows."""
    joined = identity.drop("ok").join(sources, "file", "left")
    joined = joined.join(digests.drop("rows"), SERIES, "left")
    joined = joined.join(covered, SERIES, "left").join(log, SERIES, "left")
    return joined.select(
        "dataset_id",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(TIMEZONE_LABEL).alias("timezone"),
        F.col("file").alias("source_filename"),
        "source_sha256",
        "declared_start",
        "declared_end",
        "content_sha256",
        F.coalesce(F.col("start_ts").cast("string"), F.lit("")).alias("first_ts"),
        F.coalesce(F.col("end_ts").cast("string"), F.lit("")).alias("last_ts"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias(
            "created_at_utc"
        ),
        F.lit(candlewarden.__version__).alias("engine_version"),
        F.lit(pyspark.__version__).alias("spark_version"),
        "source_size_bytes",
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        F.struct(*[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in LOG_FIELDS], F.coalesce("reordered", F.lit(False)).alias("reordered")).alias(
            "normalization"
        ),
        *SERIES,
    )


def load_dataset(
    spark: SparkSession, root: str, dataset_id: str, check: bool = True
) -> tuple[DataFrame, Row]:
    """One stored series and its manifest; ValueError when the content or the version differs."""
    found = _of_ids(read_manifests(spark, root), [dataset_id]).head(1)
    if not found:
        raise FileNotFoundError(f"{dataset_id}: no manifest under {root}")
    if check:
        verdict = verify_datasets(spark, root, [dataset_id]).head()
        if not verdict["ok"]:
            raise ValueError(
                f"{dataset_id}: {verdict['problem']} (manifest={verdict['expected_sha256']}, "
                f"actual={verdict['actual_sha256']}, schema={verdict['file_schema_version'] or found[0]['schema_version']})"
            )
    return read_bars(spark, root, [dataset_id]), found[0]
