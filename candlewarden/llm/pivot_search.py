"""Exact k largest inner products, with candidates eliminated by a table of distances to pivots.

Every vector is stored with its distances to a few pivots. For a query q and a candidate x the largest
difference of their distances to one pivot is a lower bound L of their own distance, so the inner product
is at most (|q|^2 + |x|^2 - L^2) / 2. Candidates are evaluated in the order of this bound, and a query stops
as soon as its k-th best score is above the next bound: nothing that could still enter is left out.

Candidates lie in cells (nearest pivot, ring of distance to it), and a cell of many vectors, which may hold
any share of them, in blocks of about ``BLOCK`` rows by a hash. The table of cells has at most ``PIVOTS`` times
``RINGS`` rows, so every task holds it; a query goes only to the blocks of cells whose bound reaches what it
finds in the pivots' sample. A task holds one block and a few queries at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewarden.llm.common import materialise

SCALE = 1024
K = 10
PIVOTS = 16
RINGS = 64
BLOCK = 4096
SAMPLE = 4096  # vectors that pivots are chosen from; only the speed depends on them
_QUERIES = 64  # queries compared with a block at a time
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def plain(column: pa.Array, width: int) -> np.ndarray:
    """A list column of ``width`` doubles each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """floor(1024 * x) of a list column, as doubles; missing components at the end count as zero."""
    lengths = np.diff(column.offsets.to_numpy())
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(values) == len(lengths) * width and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Each further pivot is the sample vector farthest from those chosen; fewer, if no other is left."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax(((sample - sample.mean(0)) ** 2).sum(1)))]
    nearest = distances(sample, sample[chosen])[:, 0]
    while len(chosen) < most and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 53 bits by whole numbers, held within the range of a long."""
    bound = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1])
    if bound < _EXACT:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q.tolist()]
    return np.array([max(-_LONG, min(_LONG, sum(int(a) * b for a, b in zip(r, whole, strict=True)))) for r in x.tolist()], np.int64)


def best_of_block(
    q: np.ndarray, bounds: np.ndarray, x: np.ndarray, ids: np.ndarray, floor: int | None, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the best ``k`` of a block of at least ``floor``, and how many were evaluated.

    ``bounds`` are upper bounds of the scores (minus infinity: no candidate). Ties go to the smaller id.
    """
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > -np.inf]
    at, step, least = 0, 4 * k, -np.inf if floor is None else floor
    places, found = np.empty(0, np.int64), np.empty(0, np.int64)
    while at < len(order) and bounds[order[at]] >= least:
        part = order[at : at + step]
        places, found = np.concatenate([places, part]), np.concatenate([found, scores(x[part], q)])
        keep = np.lexsort((ids[places], -found))[:k]
        places, found = places[keep], found[keep]
        if len(found) == k:
            least = max(least, found[-1])
        at, step = at + len(part), min(2 * step, 1024)
    keep = slice(None) if floor is None else found >= floor
    return places[keep], found[keep], at


def upper_bounds(q: np.ndarray, q_far: np.ndarray, x_norm: np.ndarray, x_far: np.ndarray) -> np.ndarray:
    """Bounds (queries by candidates) of the inner products, a little raised against rounding."""
    q_norm = (q * q).sum(1)
    total = q_norm[:, None] + x_norm[None, :]
    if total.max(initial=0) * 4 >= _EXACT:  # distances are no longer exact enough to rely on
        return np.full(total.shape, np.inf)
    low = np.zeros(total.shape)
    for p in range(q_far.shape[1]):
        np.maximum(low, np.abs(q_far[:, p, None] - x_far[None, :, p]), out=low)
    return (total - low * low) / 2 + 1e-9 * total + 0.25


class Cells:
    """The summary of the cells: ranges of distances to each pivot, largest norm, number of blocks."""

    def __init__(self, rows: list, pivots: int):
        self.key = np.array([(r["cell"], r["ring"]) for r in rows], np.int64).reshape(-1, 2)
        self.blocks = np.array([r["blocks"] for r in rows], np.int64)
        self.norm = np.array([r["norm"] for r in rows], np.float64)
        self.low = np.array([[r[f"low{p}"] for p in range(pivots)] for r in rows], np.float64).reshape(-1, pivots)
        self.high = np.array([[r[f"high{p}"] for p in range(pivots)] for r in rows], np.float64).reshape(-1, pivots)

    def bounds(self, q: np.ndarray, q_far: np.ndarray) -> np.ndarray:
        total = (q * q).sum(1)[:, None] + self.norm[None, :]
        if total.max(initial=0) * 4 >= _EXACT:
            return np.full(total.shape, np.inf)
        low = np.zeros(total.shape)
        for p in range(q_far.shape[1]):
            mine = q_far[:, p, None]
            np.maximum(low, np.maximum(mine - self.high[None, :, p], self.low[None, :, p] - mine), out=low)
        return (total - low * low) / 2 + 1e-9 * total + 0.25


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and embedding of the rows that take part: an id, a vector, and only finite components."""
    x = F.col(embedding)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & finite).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("embedding")
    )


_PLACED = "row bigint, vec_id bigint, embedding array<double>, far array<double>, norm double, cell int, ring int"
_ROUTED = "cell int, ring int, block bigint, kind int, row bigint, vec_id bigint, embedding array<double>, far array<double>, floor bigint"


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def pivot_table(rows: DataFrame, pivots: np.ndarray, width: int, step: float) -> DataFrame:
    """Every vector, scaled, with its distances to the pivots, its square norm, cell and ring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), width)
            far = distances(x, pivots)
            cell = far.argmin(1) if len(pivots) else np.zeros(len(x), np.int64)
            ring = np.minimum(RINGS - 1, np.take_along_axis(far, cell[:, None], 1)[:, 0] / step)
            new = [_lists(x), _lists(far), pa.array((x * x).sum(1)), pa.array(cell.astype(np.int32)), pa.array(ring.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *new], ["row", "vec_id", "embedding", "far", "norm", "cell", "ring"])

    return rows.mapInArrow(run, _PLACED)


def summary(table: DataFrame, pivots: int) -> Cells:
    """At most ``PIVOTS`` times ``RINGS`` rows, whatever the size of the table."""
    ranges = [f(F.col("far")[p]).alias(f"{name}{p}") for p in range(pivots) for name, f in (("low", F.min), ("high", F.max))]
    blocks = F.ceil(F.count("*") / BLOCK).cast("bigint").alias("blocks")
    return Cells(table.groupBy("cell", "ring").agg(blocks, F.max("norm").alias("norm"), *ranges).collect(), pivots)


def _routed(batches: Iterator[pa.RecordBatch], cells: Cells, sample: np.ndarray, sample_ids: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """A row for each query and block to search, with the score that the query's k-th best reaches at least."""
    width = sample.shape[1]
    for batch in batches:
        for start in range(0, len(batch), _QUERIES):
            part = batch.slice(start, _QUERIES)
            row, ids = (part.column(c).to_numpy() for c in ("row", "vec_id"))
            q, far = plain(part.column("embedding"), width), plain(part.column("far"), cells.low.shape[1])
            floors: list[int | None] = []
            for x, own in zip(q, ids.tolist(), strict=True):
                known = scores(sample[sample_ids != own], x)
                floors.append(int(np.partition(known, -k)[-k]) if len(known) >= k else None)
            reach = cells.bounds(q, far) >= np.array([-np.inf if f is None else f for f in floors])[:, None]
            at, cell = np.nonzero(reach)
            n = cells.blocks[cell]
            at, cell = np.repeat(at, n), np.repeat(cell, n)
            block = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            for s in range(0, len(at), 16 * BLOCK):
                a, c, b = (v[s : s + 16 * BLOCK] for v in (at, cell, block))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells.key[c, 0].astype(np.int32)), pa.array(cells.key[c, 1].astype(np.int32)), pa.array(b),
                        pa.array(np.ones(len(a), np.int32)), pa.array(row[a]), pa.array(ids[a]), _lists(q[a]), _lists(far[a]),
                        pa.array([floors[i] for i in a.tolist()], pa.int64()),
                    ],
                    ["cell", "ring", "block", "kind", "row", "vec_id", "embedding", "far", "floor"],
                )


def _searched(batches: Iterator[pa.RecordBatch], width: int, pivots: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive by block, candidates before queries: hold the block, answer its queries as they come."""
    key, pieces, held = None, [], None

    def answers(q, far, row, ids, floors) -> pa.RecordBatch:
        x, x_far, norm, x_row, x_ids = held
        bounds = upper_bounds(q, far, norm, x_far)
        out: list[tuple] = []
        for j in range(len(q)):
            bounds[j, x_row == row[j]] = -np.inf
            places, found, _ = best_of_block(q[j], bounds[j], x, x_ids, floors[j], k)
            out += [(row[j], ids[j], v, r, s) for v, r, s in zip(x_ids[places].tolist(), x_row[places].tolist(), found.tolist(), strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_row", "query_id", "vec_id", "row", "score"])

    for batch in batches:
        block = [batch.column(c).to_numpy() for c in ("cell", "ring", "block", "kind")]
        change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in block], axis=0)) + 1
        for s, e in zip([0, *change.tolist()], [*change.tolist(), len(batch)], strict=True):
            if s == e:
                continue
            part, now = batch.slice(s, e - s), tuple(int(v[s]) for v in block[:3])
            if now != key:
                key, pieces, held = now, [], None
            x = plain(part.column("embedding"), width)
            far = plain(part.column("far"), pivots)
            row, ids = part.column("row").to_numpy(), part.column("vec_id").to_numpy()
            if not block[3][s]:
                pieces.append((x, far, (x * x).sum(1), row, ids))
                continue
            if held is None:
                held = tuple(np.concatenate(p) for p in zip(*pieces, strict=True)) if pieces else ()
            floors = part.column("floor").to_pylist()
            for a in range(0, len(x) if held else 0, _QUERIES):
                b = a + _QUERIES
                yield answers(x[a:b], far[a:b], row[a:b], ids[a:b], floors[a:b])


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank (from 1), vec_id, score.

    Components are floor(1024 * x); the score is their inner product, and a query's candidates are all rows but
    itself. Ties go to the smaller id; rows of equal id and score have adjacent ranks. Repeated rows are rows
    of their own, as queries too. Rows whose id or vector is null, or with a null or infinite component or NaN,
    take no part; of vectors of different lengths the shorter count as ending in zeros. With at most ``k``
    candidates all are returned; an empty table gives no rows. Scores beyond a long are held at its ends.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    n, width = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = width or 0
    share = int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share).limit(2 * SAMPLE).toArrow() if n else None
    sample = matrix(some.column("embedding").combine_chunks(), width) if n else np.empty((0, width))
    sample_ids = some.column("vec_id").to_numpy() if n else np.empty(0, np.int64)
    pivots = choose_pivots(sample if len(sample) else np.zeros((1, width)))
    # As many rings as it takes to bring cells down to a block, if vectors were spread evenly over them.
    rings = max(1, min(RINGS, round(n / (len(pivots) * BLOCK))))
    reach = distances(sample, pivots).min(1).max(initial=0) if len(sample) else 0.0
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    table = materialise(pivot_table(numbered, pivots, width, max(reach / rings, 1e-9)), "pivot-table")
    cells = summary(table, len(pivots))
    sizes = spark.createDataFrame(
        [(int(c), int(r), int(b)) for (c, r), b in zip(cells.key, cells.blocks, strict=True)], "cell int, ring int, blocks bigint"
    )
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block")
    candidates = table.join(F.broadcast(sizes), ["cell", "ring"]).select(
        "cell", "ring", block, F.lit(0).alias("kind"), "row", "vec_id", "embedding", "far", F.lit(None).cast("bigint").alias("floor")
    )
    asked = table.where(is_query).select("row", "vec_id", "embedding", "far")
    routed = asked.mapInArrow(functools.partial(_routed, cells=cells, sample=sample, sample_ids=sample_ids, k=k), _ROUTED)
    met = candidates.unionByName(routed).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell", "ring", "block")
    found = met.sortWithinPartitions("cell", "ring", "block", "kind").mapInArrow(
        functools.partial(_searched, width=width, pivots=len(pivots), k=k),
        "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint",
    )
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
