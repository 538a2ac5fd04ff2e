"""What the two trained text scorers share: fitting in one task on a bounded sample, and calibration."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewarden.llm.common import as_bytes


def fit_once(sample: DataFrame, encode: Callable[[bytes], np.ndarray], fit: Callable[[list], object]) -> object:
    """Encode the texts of a bounded ``sample`` in its tasks, and ``fit`` in one task of the cluster.

    ``fit`` gets a list of (codes, label, lang) in the order of ``place``, so it does not depend on how
    the sample was split. The fitted object, of bounded size, returns to the driver as bytes.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [encode(x).tobytes() for x in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), *batch.columns[1:]], ["codes", *batch.schema.names[1:]])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (np.frombuffer(c or b"", np.int32), y, lang)
            for b in batches
            for c, y, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    codes = sample.select("text", "label", "lang", "place", "doc_id").mapInArrow(
        encoded, "codes binary, label int, lang string, place bigint, doc_id bigint"
    )
    one = codes.repartition(1).sortWithinPartitions("place", "doc_id", "codes").drop("place", "doc_id").mapInArrow(fitted, "model binary")
    row = one.first()
    return pickle.loads(row[0]) if row else fit([])  # no task runs on an empty sample


def logistic(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through (margin, label), with a light ridge on the slope."""
    y = labels.astype(float)
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return 0.0, float(np.log(p / (1 - p)))
    scale = max(float(np.abs(margins).std()), 1e-6)
    x = np.stack([margins / scale, np.ones(len(y))], 1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve((x * w[:, None]).T @ x + np.diag([0.01, 1e-6]), x.T @ (y - p) - np.array([0.01, 1e-6]) * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def curve(margins: np.ndarray, slope: float, intercept: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margins + intercept, -30, 30)))
