"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewarden.functions.session import materialise, working_dir

__all__ = ["Memo", "WHITE", "as_bytes", "in_fold", "labelled_sample", "materialise", "table", "working_dir"]

# The white space that separates words in every text contract: space, tab, LF, VT, FF, CR.
# bytes.split() without arguments cuts at exactly these.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


class Memo(dict):
    """A dictionary that computes what it lacks, and starts anew when it holds ``most`` entries."""

    def __init__(self, compute: Callable[[Any], Any], most: int = 200_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def in_fold(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is held out: crc32 of its id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` labelled documents outside the held-out fold, or all if fewer: doc_id, text, lang, label, place.

    A hash of the id decides which, so reruns choose the same ones, and no ranking of all labels is
    needed. The chosen ids are broadcast: ``most`` rows of three numbers bound their size. A document
    labelled twice takes the larger label.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .withColumn("place", F.xxhash64(F.lit(label), F.col("doc_id")))
    )
    share = most / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod("place", F.lit(1 << 30)) < int(share * (1 << 30)))
    columns = [F.col("doc_id"), F.col("text"), F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")]
    return docs.select(columns).join(F.broadcast(known), "doc_id")


def append_columns(
    docs: DataFrame, text: str, added: str, compute: Callable[[list[bytes]], dict[str, pa.Array]]
) -> DataFrame:
    """``docs`` with further columns (``added``, as DDL) computed from its whole texts, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = compute(as_bytes(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*batch.schema.names, *new.keys()])

    fields = StructType.fromDDL(added).fields
    if taken := {f.name for f in fields} & set(docs.columns):
        raise ValueError(f"the input already has {', '.join(sorted(taken))}")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))
