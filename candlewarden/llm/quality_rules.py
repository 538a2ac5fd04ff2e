"""Quality rules whose cutoffs carry a guarantee: few good documents of a stratum are rejected.

Every rule is a whole-number score of a document (higher is worse) and rejects from some cutoff up. For
each stratum (language) and rule, labelled good documents count how many of them a cutoff would reject.
If at most ``x`` of ``n`` would be, the exact (Clopper-Pearson) upper bound of the rejection rate is at
most ``SHARE`` as long as P(Binomial(n, SHARE) <= x) <= the test's level. The level is ``ERROR`` shared
over all strata, rules and cutoffs (Bonferroni), so with probability 1 - ERROR every cutoff in use keeps
its rule's false rejections at or below SHARE. That is ``RISK`` divided by the number of rules, so in every
stratum all rules together reject at most RISK of the good documents. The lowest cutoff that passes is used; a stratum with too
few labels has none, and its documents are judged by the base rules alone.

Everything is DataFrame functions; per document nothing leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import WHITE, materialise

MIN_WORDS = 50
RISK = 0.02  # of the good documents of a stratum, by all rules together
ERROR = 0.05
# Cutoffs are tried from 1 to TOP, and scores over TOP count as TOP. The scores are fortieths (symbols: twentieths a
# word), so only ratios of one and more are lumped together; a cutoff of TOP rejects all of them.
TOP = 40

# rule name -> whole-number score from the feature columns
RULES: dict[str, str] = {
    "symbols": "20 * n_symbols div n_words",
    "capitals": "40 * n_capitals div greatest(word_chars, 1)",
    "dup_lines": "40 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "40 * n_repeat_words div n_words",
}


SHARE = RISK / len(RULES)


ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "base_failed", "kept"]


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_capitals and base_failed. Null text has no words.

    Three-word windows are compared by 64-bit hash. Most texts repeat none, which one hash set tells;
    only the others are sorted.
    """
    temporary = ["_cw_words", "_cw_windows", "_cw_lines", "_cw_order"]
    step = docs.withColumn("_cw_words", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WHITE), ""))
    step = step.withColumns(
        {
            "_cw_windows": F.expr(
                "if(size(_cw_words) < 4, cast(array() as array<bigint>), transform(sequence(0, size(_cw_words) - 3), "
                "i -> xxhash64(_cw_words[i], _cw_words[i + 1], _cw_words[i + 2])))"
            ),
            "_cw_lines": F.expr(
                f"transform(filter(split(coalesce(`{text}`, ''), '\\n'), l -> rlike(l, '[^\\\\x20\\\\x09-\\\\x0D]')), l -> xxhash64(l))"
            ),
        }
    )
    # (window, place) in window order, but only if some window comes twice
    step = step.withColumn(
        "_cw_order",
        F.expr(
            "if(size(array_distinct(_cw_windows)) = size(_cw_windows), null, "
            "sort_array(transform(_cw_windows, (w, i) -> struct(w, i))))"
        ),
    )
    repeated = (
        "coalesce(size(array_distinct(flatten(transform(filter(transform(_cw_order, (o, k) -> "
        "if((k > 0 and _cw_order[k - 1].w = o.w) or (k < size(_cw_order) - 1 and _cw_order[k + 1].w = o.w), o.i, -1)), "
        "p -> p >= 0), p -> array(p, p + 1, p + 2))))), 0)"
    )
    return step.withColumns(
        {
            "n_words": F.size("_cw_words").cast("bigint"),
            "word_chars": F.length(F.concat_ws("", "_cw_words")).cast("bigint"),
            "n_symbols": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[#*$%&|<>]")).cast("bigint"),
            "n_capitals": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\p{Lu}")).cast("bigint"),
            "n_lines": F.size("_cw_lines").cast("bigint"),
            "n_dup_lines": (F.size("_cw_lines") - F.size(F.array_distinct("_cw_lines"))).cast("bigint"),
            "n_repeat_words": F.expr(f"if(_cw_order is null, 0, {repeated})").cast("bigint"),
        }
    ).drop(*temporary).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def _scores() -> Column:
    """rule -> score, at most TOP; only for documents that pass the base rules, so n_words > 0."""
    return F.create_map(
        *[x for name, score in RULES.items() for x in (F.lit(name), F.least(F.expr(score), F.lit(TOP)).cast("int"))]
    )


def most_rejected(n: Column, level: Column, risk: float = SHARE) -> Column:
    """The largest x with P(Binomial(n, risk) <= x) <= level; -1 if none.

    Terms are summed from the logarithm of the one before. No x above n * risk can pass for levels under
    a half, so that many terms are enough.
    """
    odds = risk / (1 - risk)
    return F.expr(
        f"aggregate(sequence(0L, cast(ceil({{n}} * {risk}D) as bigint)), "
        f"named_struct('x', -1L, 'term', {{n}} * ln(1 - {risk}D), 'total', 0D), "
        f"(s, j) -> named_struct("
        f"'x', if(s.total + exp(if(j = 0, s.term, s.term + ln(({{n}} - j + 1) / greatest(j, 1L) * {odds!r}D))) <= {{level}}, j, s.x), "
        f"'term', if(j = 0, s.term, s.term + ln(({{n}} - j + 1) / greatest(j, 1L) * {odds!r}D)), "
        f"'total', s.total + exp(if(j = 0, s.term, s.term + ln(({{n}} - j + 1) / greatest(j, 1L) * {odds!r}D)))), "
        f"s -> s.x)".format(n=n, level=level)
    )


def cutoffs(featured: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """(stratum, one column per rule): the lowest cutoff that passes its test; null if none does.

    All labelled good documents that pass the base rules are counted, by score, before they are
    shuffled: a row per stratum, rule and score. A document labelled twice is good if one label says so.
    """
    good = (
        labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("q")).where("q = 1")
    )
    cells = (
        featured.where(~F.col("base_failed"))
        .join(good, "doc_id", "left_semi")
        .select(F.col(stratum).alias("stratum"), F.explode(_scores()).alias("rule", "score"))
        .groupBy("stratum", "rule", "score")
        .count()
    )
    sums = (
        cells.groupBy("stratum", "rule")
        .agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("score", "count"))).alias("by"))
    )
    strata = sums.agg(F.greatest(F.count_distinct(F.coalesce(F.col("stratum"), F.lit("\x00null"))), F.lit(1)).alias("strata"))
    tests = sums.crossJoin(F.broadcast(strata)).withColumn("level", ERROR / (F.col("strata") * len(RULES) * TOP))
    tests = tests.withColumn("allowed", most_rejected("n", "level"))
    passing = tests.withColumn(
        "cutoff",
        F.expr(
            f"array_min(filter(sequence(1, {TOP}), c -> "
            f"aggregate(sequence(c, {TOP}), 0L, (s, v) -> s + coalesce(by[v], 0L)) <= allowed))"
        ),
    )
    return passing.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(name) for name in RULES]
    )


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """All columns of ``docs`` with the features, base_failed and kept.

    Null text has no words and fails the base rules. A null stratum is one of its own. Repeated rows are
    judged alike. Without labels only the base rules reject. The columns that are added must not be there.
    """
    if taken := {*ADDED, *(f"_cw_{name}" for name in RULES)} & set(docs.columns):
        raise ValueError(f"the input already has {', '.join(sorted(taken))}")
    narrow = materialise(
        with_features(docs.select("doc_id", F.col(text).alias("text"), F.col(stratum).alias("lang"))).drop("text"), "features"
    )
    limits = materialise(cutoffs(narrow, labels), "cutoffs").withColumnsRenamed({name: f"_cw_{name}" for name in RULES})
    return _verdict(with_features(docs, text), limits, stratum)


def judge_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """As ``judge``, without the text: doc_id, lang, the features, base_failed and kept. Texts are read once."""
    columns = [F.col("doc_id"), F.col("text"), F.col("lang")]
    narrow = materialise(with_features(docs.select(columns)).drop("text"), "features")
    limits = materialise(cutoffs(narrow, labels), "cutoffs").withColumnsRenamed({name: f"_cw_{name}" for name in RULES})
    return _verdict(narrow, limits, "lang")


def _verdict(featured: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    limits = limits.withColumnRenamed("stratum", "_cw_stratum")
    joined = featured.join(limits, featured[stratum].eqNullSafe(limits["_cw_stratum"]), "left")
    rejected = F.lit(False)
    for name, score in RULES.items():
        rejected = rejected | F.coalesce(F.least(F.expr(score), F.lit(TOP)) >= F.col(f"_cw_{name}"), F.lit(False))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected)
    return joined.withColumn("kept", kept).drop(*[c for c in limits.columns])
