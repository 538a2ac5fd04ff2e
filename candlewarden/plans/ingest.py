"""Raw exports to verified canonical tables and quality results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.functions.chunks import of_series
from candlewarden.functions.session import job_folder, materialise
from candlewarden.operators import checks, coverage, crosstf, gaps, normalise
from candlewarden.schema import SERIES
from candlewarden.sources import digest, files, store


CONFLICTS = "conflicts"
SUPERSEDED = "superseded"
INGESTED = "ingested"


@dataclass
class Reports:
    """Result tables of one ingest, written under the report folder and read back from there."""

    checks: DataFrame
    overall: DataFrame
    hours: DataFrame
    examples: DataFrame
    largest_gaps: DataFrame
    coverage: DataFrame
    tiers: DataFrame
    cross_timeframe: DataFrame
    conflicts: DataFrame


def ingest(spark: SparkSession, raw_dir: str, root: str) -> DataFrame:
    """Read, normalise, store and verify every export in ``raw_dir``; returns the manifests.

    Bars are stored before they are judged, so a series that fails its checks is kept, with its verdict.
    All conflicting rows and the exports that a later one supersedes are stored too. Everything goes to new
    folders, is read back and compared, and becomes the current snapshot by the last step; a job that dies
    before leaves the store as it was.
    """
    typed, known = files.read_raw(spark, raw_dir)
    resolved = materialise(normalise.resolve(normalise.usable(typed)), "resolved")
    bars = normalise.canonical(resolved)
    manifests = materialise(
        store.build_manifest(
            known,
            digest.source_digest(spark, raw_dir, files.GLOB),
            digest.content_digest(bars),
            coverage.coverage(bars),
            normalise.normalisation_log(typed, resolved),
        ),
        "manifests",
    )
    change = store.Change(spark, root)
    change.write_bars(bars, manifests)
    change.check(manifests)
    # every row that lost or won a conflict, so that what was left out can be looked at
    change.write(normalise.conflicting_rows(normalise.usable(typed)), CONFLICTS)
    change.write(files.superseded(files.discover(spark, raw_dir)), SUPERSEDED)
    change.write(known, INGESTED)
    change.write_manifests(manifests)
    change.commit()
    return store.read_manifests(spark, root).join(ingested(spark, root), SERIES, "left_semi")


def ingested(spark: SparkSession, root: str) -> DataFrame:
    """The series of the last ingest into ``root``."""
    return store.read_table(spark, root, INGESTED).select(*SERIES)


def quality(spark: SparkSession, root: str, report_dir: str) -> Reports:
    """Judge the series of the last ingest and write every result table as JSON."""
    datasets = ingested(spark, root)
    bars = store.read_bars(spark, root)
    if store.read_manifests(spark, root).count() != datasets.count():
        bars = of_series(bars, datasets, SERIES, "ts")
    results = checks.run_all(bars, datasets=datasets)
    covered = coverage.coverage(bars)
    all_gaps = gaps.classify_gaps(bars)

    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{report_dir}/{name}"
        df.write.mode("overwrite").json(path)
        return spark.read.schema(df.schema).json(path)

    judged = write(results, "checks")
    return Reports(
        checks=judged,
        overall=write(checks.overall(judged), "overall"),
        hours=write(checks.hour_counts(bars), "hours"),
        examples=write(checks.examples(bars), "examples"),
        largest_gaps=write(gaps.largest_gaps(all_gaps), "largest_gaps"),
        coverage=write(covered, "coverage"),
        tiers=write(coverage.coverage_tiers(covered), "tiers"),
        cross_timeframe=write(crosstf.compare(bars), "cross_timeframe"),
        conflicts=store.read_table(spark, root, CONFLICTS),
    )


def run(spark: SparkSession, raw_dir: str, root: str, report_dir: str) -> tuple[DataFrame, Reports]:
    """Ingest and judge; raises nothing for bad data, the verdict is in ``Reports.overall``."""
    with job_folder(spark):
        manifests = ingest(spark, raw_dir, root)
        reports = quality(spark, root, report_dir)
    return manifests, reports
