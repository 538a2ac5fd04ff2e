"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.llm import (
    alignment,
    html_text,
    mixing,
    packing,
    pivot_search,
    prefix_trie,
    quality_nbsvm,
    quality_rules,
    simhash,
    syncmers,
    tokens,
    toxicity_cnn,
    warc_index,
)
from candlewarden.llm.common import in_fold, table


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op7_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_nbsvm.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_nbsvm.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_cnn.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_cnn.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id",
        in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity_cnn.THRESHOLD).cast("int").alias("predicted"),
        toxicity_cnn.rejected(model, "score").alias("rejected"),
    )


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_index.archive_and_index(table(spark, sf_dir, "pages"), partitions(spark))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"), 4 * partitions(spark))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    narrow = found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "pair_links")
    counted = alignment.with_pair_counts(narrow, alignment.vocabulary_size(b))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_token_counts,
        op3_packing,
        op4_html_text,
        op5_quality_rules,
        op6_mixing,
        op7_quality_nbsvm,
        op8_toxicity_cnn,
        op9_warc_index,
        op10_syncmers,
        op11_token_alignment,
        op12_pivot_search,
        op13_prefix_trie,
    )
}
