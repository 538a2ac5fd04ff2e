"""The registered queries: every operator over the whole ``events`` table of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.functions.session import materialise, working_dir
from candlewarden.functions.chunks import join_series_values
from candlewarden.functions.quantiles import prob_name
from candlewarden.operators import (
    causality,
    checks,
    coverage,
    crosstf,
    features,
    gaps,
    normalise,
    parse,
    profiles,
    sketches,
)
from candlewarden.plans import bindings as b
from candlewarden.schema import CANONICAL, PRICES, SCHEMA_VERSION, SERIES
from candlewarden.sources import digest, files, store

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
OFF_TIES = 1e-8


def rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Round interpolated or averaged columns, whose last bits depend on the order of operations.

    A mean of two-digit prices can lie exactly between two rounded values, hence the small shift.
    """
    return df.withColumns({c: F.round(F.col(c) + OFF_TIES, DIGITS) for c in columns})


def over_events(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(b.read_events(spark, sf_dir))


def over_stored(derive: Callable[[DataFrame], DataFrame], make: Callable[[DataFrame], DataFrame]) -> Query:
    """For operators that pass over their input several times: derive it once, write it, then judge it."""

    def query(spark, sf_dir):
        return make(materialise(derive(b.read_events(spark, sf_dir)), "input"))

    return query


# --- raw files ---------------------------------------------------------------------------------


def file_identity(events):
    return parse.file_identity(b.files(b.bars(events)))


def header_audit(events):
    audit = parse.header_audit(b.raw_lines(events, broken_header="VIEW", blank_header="SIGNUP"))
    return audit.select("file", "delimiter", F.concat_ws(",", "columns").alias("columns"), "ok")


def raw_typed(events):
    return b.typed(events).drop("ts")


def parse_ts(events):
    return b.typed(events).select(*SERIES, "line_no", "date", "time", "ts")


def line_numbers(spark, sf_dir):
    """Write the events as text, read the text back with line numbers, and count wrong numbers."""
    events = b.read_events(spark, sf_dir)
    path = f"{working_dir(spark)}/text-{uuid.uuid4().hex}"
    text = events.repartitionByRange("event_id").sortWithinPartitions("event_id")
    text.select(F.col("event_id").cast("string").alias("value")).write.text(path)
    lines = files.read_lines(spark, path, glob="*.txt").withColumn("id", F.col("value").cast("bigint"))
    # ids ascend along each file, so the k-th line of a file starting at id s with no id missing is s + k - 1
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("line_no").alias("numbers"),
        F.min("line_no").alias("low"),
        F.max("line_no").alias("high"),
        F.min(F.col("id") - F.col("line_no")).alias("a"),
        F.max(F.col("id") - F.col("line_no")).alias("z"),
    )
    right = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("numbers") == F.col("n"))
    in_order = F.col("a") == F.col("z")
    return per_file.agg(
        F.sum("n").alias("lines"),
        F.coalesce(F.sum(F.when(right & in_order, 0).otherwise(F.col("n"))), F.lit(0)).alias("misnumbered"),
    )


def exact_duplicates(events):
    return normalise.exact_duplicates(normalise.usable(b.typed(events)))


def conflicting_duplicates(events):
    return normalise.conflicting_rows(normalise.usable(b.typed(events)))


def conflict_examples(events):
    return normalise.conflict_examples(normalise.usable(b.typed(events)))


def canonical_bars(events):
    return normalise.canonical(normalise.resolve(normalise.usable(b.typed(events))))


# --- checks ------------------------------------------------------------------------------------


def check_schema(events):
    """The judged series, and one whose files have no spread."""
    made = materialise(b.judged_bars(events), "judged")
    narrow = made.where("symbol = 'SESSION'").withColumn("symbol", F.lit("NARROW")).drop("spread")
    both = made.unionByName(narrow, allowMissingColumns=True)
    return checks.schema_check(both, both.select(*SERIES).distinct())


def _profiled(check: str, *columns: str) -> Query:
    """A check that needs only the fused profile."""

    def make(bars):
        return checks.profile(bars).select(*SERIES, *columns, checks.status_of(check).alias("status"))

    return over_events(lambda events: make(b.judged_bars(events)))


def check_ts_order(events):
    facts = checks.timestamp_order(normalise.usable(b.typed(events)), "line_no")
    return facts.select(
        *SERIES, "duplicates", "monotonic", checks.status_of("timestamp_order").alias("status")
    )


def check_duplicates(events):
    facts = checks.duplicates(normalise.usable(b.typed(events)))
    return facts.select(*SERIES, "sharing_rows", checks.status_of("duplicate_timestamps").alias("status"))


def check_spread(bars):
    counts = materialise(checks.counts_of_values(bars, "spread"), "value_counts")
    quantiles = materialise(checks.quantile_facts(counts, {"spread": checks.SPREAD_PROBS}), "quantiles")
    facts = checks.profile(bars).join(quantiles, SERIES).join(
        checks.extreme_spreads(counts, quantiles), SERIES
    )
    facts = facts.withColumn("spread_mean", F.col("_spread_sum") / F.col("_spread_rows"))
    names = [f"spread_{prob_name(p)}" for p in checks.SPREAD_PROBS]
    out = facts.select(
        *SERIES,
        "spread_negative",
        "spread_zero",
        "spread_extreme",
        "spread_mean",
        *names,
        checks.status_of("spread").alias("status"),
    )
    return rounded(out, ["spread_mean", *names])


def check_volume(bars):
    probs = {"tick_volume": checks.TICK_VOLUME_PROBS}
    quantiles = checks.quantile_facts(checks.counts_of_values(bars, "tick_volume"), probs)
    names = [f"tick_volume_{prob_name(p)}" for p in checks.TICK_VOLUME_PROBS]
    out = (
        checks.profile(bars)
        .join(quantiles, SERIES)
        .select(
            *SERIES,
            "tick_volume_zero",
            "tick_volume_negative",
            *names,
            (F.col("volume_nonzero_rows") == 0).alias("volume_all_zero"),
            "volume_nonzero_rows",
        )
    )
    return rounded(out, names)


def _jumps(bars):
    facts = checks.quantile_facts(checks.counts_of_values(bars, "range"), {"range": [0.5]})
    return checks.with_jumps(bars, checks.typical_range(facts))


def check_price_jumps(bars):
    facts = checks.jump_facts(_jumps(bars))
    out = facts.select(*SERIES, "jumps", "median_range", checks.status_of("price_jumps").alias("status"))
    return rounded(out, ["median_range"])


def check_frequency(bars):
    facts = gaps.frequency(gaps.steps(bars.select(*SERIES, "ts")))
    return facts.select("*", checks.status_of("frequency_and_gaps").alias("status"))


SKETCHED = {"spread": "spread", "tick_volume": "tick_volume", "range": "high - low"}
SKETCH_PROBS = [0.01, 0.25, 0.5, 0.99, 1.0]


def sketch_quantiles(bars):
    """Quantiles from the sketches of two parts of the bars, as of two ingests, merged."""
    parts = [sketches.sketch(bars.where(F.dayofmonth("ts") % 2 == k), SKETCHED) for k in (0, 1)]
    return rounded(sketches.quantiles(sketches.merge(parts), SKETCH_PROBS), ["estimate", "farthest"])


def check_examples(bars):
    return checks.examples(bars).select(*SERIES, "check_name", "rank", *CANONICAL, "prev_close", "jump")


def quality_report(bars):
    return checks.run_all(bars).drop("metrics")


def check_metrics(bars):
    """The numbers behind every check, one row each."""
    results = checks.run_all(bars).where(F.col("metrics").isNotNull())
    long = results.select(*SERIES, "check_name", F.explode("metrics").alias("metric", "value"))
    return rounded(long, ["value"])


def overall_status(bars):
    return checks.overall(checks.run_all(bars))


# --- gaps, coverage, timeframes ----------------------------------------------------------------


def gap_table(events):
    return gaps.classify_gaps(b.bars_user(events))


def largest_gaps(events):
    return gaps.largest_gaps(gap_table(events))


def gap_lengths(events):
    """The gaps with their length, as the end that start and length give."""
    longer = gaps.with_delta(gap_table(events)).withColumn("reached", F.col("gap_start") + F.col("delta"))
    return longer.select(*SERIES, "gap_start", "reached", F.expr("extract(DAY FROM delta)").cast("bigint").alias("days"))


def compare(bars):
    out = crosstf.compare(bars)
    return rounded(
        out,
        [*[f"{c}_{q}" for c in PRICES for q in ("p50", "p99")], "tick_volume_p99", "price_mismatch_fraction"],
    )


def cross_tf_no_overlap(bars):
    """Series whose timeframes share no complete bucket: the H1 side is moved away by a year."""
    away = F.when(F.col("timeframe") == "H1", F.col("ts") + F.expr("INTERVAL '365' DAY"))
    moved = bars.withColumn("ts", F.coalesce(away, F.col("ts")))
    return crosstf.compare(moved).select(
        "symbol", "pair", "complete_buckets", "compared", "status", "note"
    )


def tiers(events):
    return coverage.coverage_tiers(coverage.coverage(b.bars(events)))


# --- store and digests -------------------------------------------------------------------------


def _root(spark) -> str:
    return f"{working_dir(spark)}/store-{uuid.uuid4().hex}"


def _with_line_no(bars):
    return bars.withColumn("line_no", F.lit(None).cast("bigint"))


def _manifests(bars):
    """Manifests of bars that come from no export: digest and rows of each series."""
    known = digest.content_digest(bars).withColumn("schema_version", F.lit(SCHEMA_VERSION))
    fields = [f for f in store.MANIFEST_SCHEMA if f.name not in ("change", "change_series")]
    cells = [F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return materialise(known.select(*cells), "manifests")


def _store(bars):
    """A store of all series of ``bars``, its change and its manifests."""
    spark = bars.sparkSession
    change, manifests = store.Change(spark, _root(spark)), _manifests(bars)
    change.write_bars(bars, manifests)
    change.write_manifests(manifests)
    change.commit()
    return change, manifests


def _first_close_raised(bars):
    """The first close of each ERROR series is one higher."""
    first = bars.where(F.col("symbol") == "ERROR").groupBy(*SERIES).agg(F.min("ts").alias("_first"))
    placed = join_series_values(bars, first, SERIES, "ts")
    raised = F.when(F.col("ts") == F.col("_first"), F.col("close") + 1).otherwise(F.col("close"))
    return placed.withColumn("close", raised).drop("_first")


def bars_roundtrip(spark, sf_dir):
    """A store whose CLICK series are first stored wrongly and then replaced by a second change."""
    bars = materialise(_with_line_no(b.bars(b.read_events(spark, sf_dir))), "bars")
    click = F.col("symbol") == "CLICK"
    change, _ = _store(bars.withColumn("open", F.when(click, F.col("open") + 1).otherwise(F.col("open"))))
    later, right = store.Change(spark, change.root), bars.where(click)
    manifests = _manifests(right)
    later.write_bars(right, manifests)
    later.check(manifests)
    later.write_manifests(manifests)
    later.commit()
    return store.read_bars(spark, change.root).select(*SERIES, *CANONICAL)


def manifest_table(spark, sf_dir):
    """Manifests of the series in the raw lines, with the digests of the files that the lines stand for."""
    lines = materialise(b.raw_lines(b.read_events(spark, sf_dir)), "lines")
    rows = b.typed_lines(lines)
    resolved = materialise(normalise.resolve(normalise.usable(rows)), "resolved")
    bars = normalise.canonical(resolved)
    made = materialise(
        store.build_manifest(
            parse.file_identity(rows.select("file").distinct()),
            lines_as_sources(lines),
            digest.content_digest(bars),
            coverage.coverage(bars),
            normalise.normalisation_log(rows, resolved),
        ),
        "manifests",
    )
    change = store.Change(spark, _root(spark))
    change.write_bars(bars, made)
    change.check(made)
    change.write_manifests(made)
    change.commit()
    return store.read_manifests(spark, change.root).select(
        "dataset_id",
        *SERIES,
        "schema_version",
        "timezone",
        "source_filename",
        "source_sha256",
        "source_size_bytes",
        "declared_start",
        "declared_end",
        "content_sha256",
        "rows",
        "first_ts",
        "last_ts",
        "normalization.rows_in",
        "normalization.dropped_unparseable_timestamp",
        "normalization.dropped_nan_ohlc",
        "normalization.reordered",
    )


def verify_datasets(spark, sf_dir):
    """Verify a store whose files hold a changed price of the ERROR series, and VIEW series of another version."""
    bars = materialise(_with_line_no(b.bars(b.read_events(spark, sf_dir))), "bars")
    change, manifests = store.Change(spark, _root(spark)), _manifests(bars)
    older = F.when(F.col("symbol") == "VIEW", "0.9.0").otherwise(F.col("schema_version"))
    change.write_bars(_first_close_raised(bars), manifests.withColumn("schema_version", older))
    change.write_manifests(manifests)
    change.commit()
    return store.verify_datasets(spark, change.root).drop("actual_sha256")


def verify_months(spark, sf_dir):
    """The months that differ after the files of a committed change were written over with a changed price."""
    bars = materialise(_with_line_no(b.bars(b.read_events(spark, sf_dir))), "bars")
    change, manifests = _store(bars)
    change.write_files(_first_close_raised(bars), manifests, mode="overwrite")
    return store.verify_months(spark, change.root, changed_only=True)


def source_digest(events):
    """Digest of the raw export lines as the files they stand for, each line closed by a line feed."""
    return lines_as_sources(b.raw_lines(events))


def lines_as_sources(lines):
    lines = lines.withColumns(
        {"size": F.octet_length("value") + F.lit(1), "line_sha256": F.sha2(F.col("value").cast("binary"), 256)}
    )
    lines = materialise(lines.select("file", "line_no", "size", "line_sha256"), "line_digests")
    sizes = lines.groupBy("file").agg(F.sum("size").alias("size"))
    return digest.lines_digest(lines.drop("size").join(sizes, "file"))


# --- features and causality --------------------------------------------------------------------

FEATURES = {
    "rolling5": features.rolling_mean(5),
    "pct_change": features.pct_change(),
    "ewm10": features.ewm_mean(10),
    "expanding": features.expanding_mean(),
}
LEAKS = {
    "lead": features.ahead(1),
    "centered": features.centred_mean(5),
    "zscore": features.zscore(),
    "label": features.future_label(3),
    "shortened": features.known_ahead(1),
}
# sums of all rows come out of a grouped aggregate or a chunk scan, whose last bits may differ
TOLERANCE = {"zscore": 1e-9, "ewm10": 1e-9, "expanding": 1e-9}


# quotients of two stored prices: both engines take the same steps
EXACT = {"pct_change"}


def _feature(name: str) -> Query:
    def make(bars):
        out = FEATURES[name](bars, SERIES)
        return out if name in EXACT else rounded(out, ["value"])

    return over_stored(b.bars, make)


def _causality(name: str) -> Query:
    feature = {**FEATURES, **LEAKS}[name]

    def make(bars):
        return causality.compare_prefixes(bars, feature, atol=TOLERANCE.get(name, 0.0)).drop(
            "prefix_value", "full_value"
        )

    return over_stored(b.bars, make)


def causality_verdicts(bars):
    """Which of three features are causal in which series."""
    verdicts = None
    for name in ("pct_change", "lead", "shortened"):
        compared = causality.compare_prefixes(bars, {**FEATURES, **LEAKS}[name])
        judged = compared.groupBy(*SERIES).agg(F.expr("bool_and(differing = 0 AND one_sided = 0)").alias("causal"))
        judged = judged.select(F.lit(name).alias("feature"), *SERIES, "causal")
        verdicts = judged if verdicts is None else verdicts.unionByName(judged)
    return verdicts


def declared_vs_actual(events):
    bars = b.bars(events)
    return profiles.declared_vs_actual(parse.file_identity(b.files(bars)), coverage.coverage(bars))


def spread_by_year(bars):
    return rounded(profiles.spread_by_year(bars), ["zero_share", "median_spread"])


def export_cap_evidence(events):
    return rounded(profiles.export_cap_evidence(coverage.coverage(b.bars(events))), ["row_ratio"])


QUERIES: dict[str, Query] = {
    # scans, sources, sinks
    "file_identity": over_events(file_identity),
    "header_audit": over_events(header_audit),
    "raw_typed": over_events(raw_typed),
    "line_numbers": line_numbers,
    "bars_roundtrip": bars_roundtrip,
    "manifest_table": manifest_table,
    "verify_datasets": verify_datasets,
    "verify_months": verify_months,
    "source_digest": over_events(source_digest),
    "content_digest": over_events(lambda e: digest.content_digest(b.bars(e))),
    "month_digest": over_events(lambda e: digest.month_digest(b.bars(e))),
    # normalisation
    "parse_ts": over_events(parse_ts),
    "exact_duplicates": over_events(exact_duplicates),
    "conflicting_duplicates": over_events(conflicting_duplicates),
    "conflict_examples": over_events(conflict_examples),
    "canonical_bars": over_events(canonical_bars),
    "normalization_log": over_events(lambda e: normalise.normalisation_log(b.typed(e))),
    # checks
    "check_schema": over_events(check_schema),
    "check_row_count": _profiled("row_count", "rows", "first_ts", "last_ts"),
    "check_ts_order": over_events(check_ts_order),
    "check_duplicates": over_events(check_duplicates),
    "check_grid": _profiled("grid_alignment", "off_grid"),
    "check_ohlc": _profiled("ohlc_integrity", *checks.OHLC_RULES, "ohlc_violations"),
    "check_positivity": _profiled("price_positivity", "bad_prices"),
    "check_zero_range": over_events(
        lambda e: rounded(
            checks.profile(b.judged_bars(e)).select(
                *SERIES,
                "zero_range",
                (F.col("zero_range") / F.col("rows")).alias("fraction"),
                checks.status_of("zero_range_candles").alias("status"),
            ),
            ["fraction"],
        )
    ),
    "check_spread": over_stored(b.judged_bars, check_spread),
    "check_volume": over_stored(b.judged_bars, check_volume),
    "check_weekday": _profiled("weekday_distribution", *checks.WEEKDAYS),
    "check_hour": over_events(lambda e: checks.hour_counts(b.judged_bars(e))),
    "check_price_jumps": over_stored(b.judged_bars, check_price_jumps),
    "check_frequency": over_stored(b.judged_bars, check_frequency),
    "sketch_quantiles": over_stored(b.judged_bars, sketch_quantiles),
    "check_examples": over_stored(b.judged_bars, check_examples),
    "check_metrics": over_stored(b.judged_bars, check_metrics),
    "quality_report": over_stored(b.judged_bars, quality_report),
    "overall_status": over_stored(b.judged_bars, overall_status),
    # gaps
    "gaps": over_events(gap_table),
    "gap_kinds": over_events(lambda e: gaps.gap_kind_counts(gap_table(e))),
    "largest_gaps": over_events(largest_gaps),
    # timeframes and coverage
    "rollup_m15_h1": over_events(lambda e: crosstf.roll_up(b.bars(e), "M15", "H1")),
    "cross_tf_compare": over_events(lambda e: crosstf.matched(b.bars_h1_changed(b.bars(e)))),
    "cross_tf_all": over_stored(lambda e: b.bars_h1_changed(b.bars(e)), compare),
    "cross_tf_no_overlap": over_stored(b.bars, cross_tf_no_overlap),
    "cross_tf_uncovered": over_stored(b.bars, crosstf.uncovered),
    "coverage": over_events(lambda e: coverage.coverage(b.bars(e))),
    "coverage_tiers": over_events(tiers),
    # features and causality
    **{f"feat_{name}": _feature(name) for name in FEATURES},
    **{f"causality_{name}": _causality(name) for name in [*FEATURES, *LEAKS]},
    "causality_verdicts": over_stored(b.bars, causality_verdicts),
    "available_at": over_events(lambda e: features.available_at(b.bars(e))),
    # documented analyses
    "spread_by_year": over_stored(b.bars, spread_by_year),
    "gap_resume_profile": over_events(lambda e: profiles.gap_resume_profile(gap_table(e))),
    "volume_by_year": over_events(lambda e: profiles.volume_by_year(b.bars(e))),
    "flag_provisional": over_events(lambda e: profiles.flag_provisional(b.bars(e))),
    "trim_provisional": over_events(lambda e: profiles.trim_provisional(b.bars(e))),
    "gap_lengths": over_events(gap_lengths),
    "declared_vs_actual": over_events(declared_vs_actual),
    "export_cap_evidence": over_events(export_cap_evidence),
}
