"""Near-duplicate documents by SimHash, with a Gray-order hierarchical index over the fingerprints.

The fingerprints within two bits of each other are found exactly. Of two such fingerprints at least one
of three bit bands is equal, so each distinct fingerprint goes to three keys. The members of a key are
sorted by Gray rank, which puts codes with long shared patterns side by side; runs of eight make a node
that keeps the bits its members share (mask and value), eight nodes make a node above, and so on. The
search walks pairs of nodes from the top and drops a pair, with all below it, once the shared bits
differ in more than two places.

A key with more members than ``MOST`` (a family of near copies may hold any share of the corpus) is not
gathered: its members are dealt again by three bands of the bits that are still free, and so on. After
five deals at most 10 bits are free, so no key can have more than 1024 members then: nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import append_columns, materialise
from candlewarden.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
MOST = 4096
FAN = 8
_BLOCK = 1 << 15  # shingles or node pairs handled at a time


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 values of the text's word shingles; 0 without words."""
    words = text.lower().split()  # bytes.lower() touches A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        starts, ends = [0], [len(joined)]
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - size] + 1).tolist()]
        ends = [*gaps[size - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), _BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + _BLOCK], ends[k : k + _BLOCK], strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of the whole text as a signed 64-bit number."""

    def compute(texts: list[bytes]) -> dict[str, pa.Array]:
        return {out: pa.array(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))}

    return append_columns(docs, text, f"`{out}` bigint", compute)


def gray_rank(code: Column) -> Column:
    """The place of a code in the reflected Gray sequence: each bit is the parity of those from it upwards."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _bands(free: int, n: int) -> list[int]:
    """``n`` masks that share out the set bits of ``free``."""
    bits = [1 << i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * k // n for k in range(n + 1)]
    return [sum(bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class _Forest:
    """Joins members of one key and keeps only the links that join something; ``known`` labels are joined already."""

    def __init__(self, size: int, known: np.ndarray | None = None):
        self.label, self.links = np.arange(size), []
        if known is not None and size:
            _, first, place = np.unique(known, return_index=True, return_inverse=True)
            self.label = first[place]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        news = self.label[a] != self.label[b]
        root = self.label.tolist() if news.any() else []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(a[news].tolist(), b[news].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                self.links.append((x, y))
        if root:
            self.label = np.array([find(x) for x in range(len(root))])


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, value) of the nodes, from the codes themselves up to one root."""
    low = high = codes
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    while len(low) > 1:
        at = np.arange(0, len(low), FAN)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        levels.append((~(low ^ high), low))
    return levels


def near_pairs(codes: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x < y) of all codes within ``distance`` bits of each other; ``codes`` are in Gray order.

    Pairs of nodes are walked from the root. The bits that two nodes both share among their members decide:
    where these differ in more than ``distance`` places, everything below the pair is left out.
    """
    levels, step = _levels(codes), np.arange(FAN)
    waiting = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    most = _BLOCK // (FAN * FAN)
    while waiting:
        level, a, b = waiting.pop()
        if not level:
            yield a[a < b], b[a < b]
            continue
        mask, value = levels[level - 1]
        for k in range(0, len(a), most):
            x, y = a[k : k + most], b[k : k + most]
            x = np.broadcast_to((x[:, None] * FAN + step)[:, :, None], (len(x), FAN, FAN)).ravel()
            y = np.broadcast_to((y[:, None] * FAN + step)[:, None, :], (len(y), FAN, FAN)).ravel()
            inside = (x <= y) & (y < len(value))
            x, y = x[inside], y[inside]
            near = np.bitwise_count((value[x] ^ value[y]) & mask[x] & mask[y]) <= distance
            if near.any():
                waiting.append((level - 1, x[near], y[near]))


def index_links(codes: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all codes within ``DISTANCE`` bits of each other; ``codes`` are distinct, in Gray order."""
    forest = _Forest(len(codes))
    for a, b in near_pairs(codes):
        forest.add(a, b)
    return forest.links


def _links_of_keys(key: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal ``key``, by the index of its codes."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[starts[1:], len(key)]
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        own = codes[start:end]
        if found := index_links(own):
            at = np.array(found)
            a.append(own[at[:, 0]])
            b.append(own[at[:, 1]])
    return np.concatenate(a), np.concatenate(b)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by key and Gray rank; the last key of a batch waits for the next one."""
    keys, codes = np.empty(0, np.int64), np.empty(0, np.uint64)

    def found(k: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        a, b = _links_of_keys(k, c)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column("deal").to_numpy(zero_copy_only=False)])
        codes = np.concatenate([codes, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        if len(keys):
            whole = int(np.searchsorted(np.arange(len(keys)), len(keys) - (keys[::-1] == keys[-1]).cumprod().sum()))
            if whole:
                yield found(keys[:whole], codes[:whole])
                keys, codes = keys[whole:], codes[whole:]
    if len(keys):
        yield found(keys, codes)


def dealt_keys(
    codes: DataFrame, search: Callable, result: str, width: int = 64, keep: Sequence[str] = (), distance: int = DISTANCE
) -> DataFrame:
    """``search`` over the rows of every key that codes (column ``fp``) within ``distance`` bits may share.

    Of two such codes one of ``distance`` + 1 bands is equal. Rows reach ``search`` as (deal, fp, keep...) by key and
    Gray rank of the code. ``keep[0]`` tells tables of codes apart; in a table codes are distinct, and every deal
    fixes its share of the bits that are still free, so keys become small after a few deals.
    """
    table, n = list(keep[:1]), distance + 1
    rest, masks, out = codes.select("fp", *keep, F.lit(0).alias("path")), [0], None
    while True:
        masks = [fixed | band for fixed in masks for band in _bands(~fixed & (1 << width) - 1, n)]
        fixed = F.array(*[F.lit(_signed(m)) for m in masks])
        dealt = rest.select("fp", *keep, F.explode(F.array(*[F.col("path") * n + i for i in range(n)])).alias("path"))
        dealt = dealt.withColumn("bits", F.col("fp").bitwiseAND(F.element_at(fixed, F.col("path") + 1)))
        key = [*table, "path", "bits"]
        sizes = materialise(dealt.groupBy(*key).count().where("count > 1"), "keys")
        some = dealt.join(sizes.where(F.col("count") <= MOST), key).select(F.xxhash64(*key).alias("deal"), "fp", *keep)
        part = some.repartition("deal").sortWithinPartitions("deal", gray_rank(F.col("fp"))).mapInArrow(search, result)
        out = part if out is None else out.unionByName(part)
        if sizes.where(F.col("count") > MOST).isEmpty():
            return out
        rest = materialise(dealt.join(sizes.where(F.col("count") > MOST), key, "left_semi").select("fp", *keep, "path"), "hot-codes")


def links(codes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that join all within two bits of each other."""
    return dealt_keys(codes, _search, "a bigint, b bigint")


def groups(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(fp, component_id) for the fingerprints in ``prints``: component_id is the least id that links reach.

    Null ids do not count; a group whose ids are all null has a null component_id. Equal fingerprints
    are one node, so copies are never expanded into pairs.
    """
    nodes = materialise(prints.groupBy("fp").agg(F.min(doc_id).alias("first_id")), "codes")
    joined = components(links(nodes))
    member = materialise(
        nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("label", "fp").alias("label")
        ),
        "members",
    )
    least = member.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return member.join(least, "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp (signed 64 bits), component_id.

    Null text counts as empty; texts without words have fingerprint zero and are linked like others.
    Repeated rows stay repeated. An empty table gives an empty result; other columns are not read.
    """
    prints = materialise(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), "prints")
    return prints.join(groups(prints), "fp").select("doc_id", "fp", "component_id")
