"""The trie of conversation prefixes, with totals over every subtree.

A node is a sequence of turns that at least one conversation starts with; its key is the sum of hashes of
(depth, turn) along the sequence, so that keys of all prefixes are running sums. A conversation may hold any
share of the turns: rows are laid out by (conversation, order) in ranges, sums run inside a range, and what
crosses a border is one row per range.

Totals over subtrees go up in bands of ``BAND`` depths. A node is exploded only to its ancestors within its
band. The tops of the bands form a smaller trie of a depth ``BAND`` times less, whose totals come from the
same function; a completed top is then exploded over the band above it. So a trie of depth D takes
log D rounds to the base ``BAND``, and no row is exploded to more than ``BAND`` rows in a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import materialise

FAMILY = 5
HEADS = 9
BAND = 16
BUCKET = 4096  # ids of conversations that one row of an ends list may hold
HOT = 1000  # a key with more than one in so many rows is looked up without a shuffle
NODE = ["k1", "k2", "depth"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, bytes) of every row with a conversation; null role or text is empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.substring(digest, 1, 32).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def _lane(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 1 + 16 * k, 16), 16, -10).cast("bigint")


def running(rows: DataFrame, order: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``pos``, the place of each row in its conversation, and ``sum_x``, running sums modulo 2^64.

    Rows are laid out in ranges of (conv_id, order), so a long conversation is in many tasks. What goes to
    the driver is one row per range, which says what its last conversation has added up to.
    """
    spark, names = rows.sparkSession, [f"sum_{c}" for c in sums]
    stored = materialise(rows.withColumn("_tie", F.monotonically_increasing_id()), "turns")
    keys = ["conv_id", *order, "_tie"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    added = "".join(f", {c} bigint" for c in ["pos", *names])
    kept = rows.columns

    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = None, np.zeros(1 + len(sums), np.uint64)
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column("conv_id").to_numpy()
            values = [np.ones(len(conv), np.uint64), *(batch.column(c).to_numpy().view(np.uint64) for c in sums)]
            first = np.r_[True, conv[1:] != conv[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(len(conv)), 0))
            same = start == 0 if conv[0] == last else np.zeros(len(conv), bool)
            out = []
            for k, v in enumerate(values):
                total = np.cumsum(v, dtype=np.uint64)
                run = total - (total - v)[start]
                run[same] += carried[k]
                out.append(run)
            last, carried = conv[-1], np.array([run[-1] for run in out], np.uint64)
            columns = [batch.column(c) for c in kept] + [pa.array(run.view(np.int64)) for run in out]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(conv), part, np.int32))], [*kept, "pos", *names, "_part"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    local = materialise(laid.mapInArrow(added_up, f"{fields}{added}, _part int"), "ranges")
    ends = local.groupBy("_part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos", *names)).alias("last"))
    carry: dict[int, tuple] = {}
    before, total = None, [0] * (1 + len(sums))
    for row in sorted(ends.collect()):
        if row["first"] == before:
            carry[row["_part"]] = (before, *total)
        own = [row["last"][c] for c in ("pos", *names)]
        onward = row["last"]["conv_id"] == before
        total = [(a + b) % (1 << 64) if onward else b % (1 << 64) for a, b in zip(total, own, strict=True)]
        before = row["last"]["conv_id"]

    def carried_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part = batch.column("conv_id").to_numpy(), batch.column("_part").to_numpy()
            out = [batch.column(c).to_numpy().view(np.uint64).copy() for c in ("pos", *names)]
            for p in np.unique(part).tolist():
                if p in carry:
                    at = (part == p) & (conv == carry[p][0])
                    for run, more in zip(out, carry[p][1:], strict=True):
                        run[at] += np.uint64(more)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(run.view(np.int64)) for run in out)], [*kept, "pos", *names]
            )

    return local.mapInArrow(carried_on, f"{fields}{added}")


def lookup(rows: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with ``values`` (unique keys; ``n``, how many rows have the key).

    Fewer than ``HOT`` keys can each have more than one in ``HOT`` of all rows; these are broadcast and
    their rows stay where they are.
    """
    total = values.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(values.where(F.col("n") > total / HOT).drop("n"))
    usual = rows.join(hot.select(*keys), list(keys), "left_anti").join(values.where(F.col("n") <= total / HOT).drop("n"), list(keys))
    return rows.join(hot, list(keys)).unionByName(usual)


def rebuild(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: (conv_id, length) and (conv_id, depth, digest, bytes).

    Conversation c takes the first h turns of conversation c - c % ``family`` (all if it has fewer, none if it
    is absent), then its own after its first h; h is the CRC-32 of c in decimal modulo ``heads``. Turns go by
    number, null first; equal numbers by role, then by the digest of the turn, and repeated rows are turns of
    their own. Rows without a conv_id belong to no conversation and take no part.
    """
    own = materialise(running(turns(conversations), ["turn", "role", "digest"]).drop("turn", "role"), "own-turns")
    sizes = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = sizes.select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
    )
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = materialise(
        convs.join(base, "base", "left").withColumn("kept", F.least("h", F.coalesce("n_base", F.lit(0).cast("bigint")))), "conversations"
    )
    first = own.where((F.col("pos") < heads) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    begin = first.join(convs.select("base", "conv_id", "kept"), "base").where("pos <= kept")
    rest = lookup(own, convs.select("conv_id", "h", "kept", "n"), ["conv_id"]).where("pos > h")
    rebuilt = begin.select("conv_id", F.col("pos").alias("depth"), "digest", "bytes").unionByName(
        rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("kept")).alias("depth"), "digest", "bytes")
    )
    length = (F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("bigint"))).alias("length")
    return convs.select("conv_id", length), rebuilt


def _within(nodes: DataFrame, paths: DataFrame, band: int) -> DataFrame:
    """Totals of the nodes below each node in its own band of depths."""
    above = paths.select("conv_id", F.floor(F.col("depth") / band).alias("band"), F.col("depth").alias("up"), "k1", "k2")
    each = nodes.select("conv_id", F.floor(F.col("depth") / band).alias("band"), "depth", "saved", "leaves")
    met = each.join(above, ["conv_id", "band"]).where("up <= depth")
    return met.groupBy("k1", "k2", F.col("up").alias("depth")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def subtree_totals(nodes: DataFrame, paths: DataFrame, top: int, band: int = BAND) -> DataFrame:
    """(k1, k2, depth, saved, leaves) added up over every subtree.

    ``nodes`` has keys, depth, saved, leaves and a conversation that goes through the node; ``paths`` has
    conv_id, depth and key of every prefix of a conversation, the root included; ``top`` is the largest depth.
    """
    inside = materialise(_within(nodes, paths, band), "bands")
    if top < band:
        return inside
    tops = inside.where(F.col("depth") % band == 0).join(nodes.select("conv_id", *NODE), NODE)
    smaller = materialise(tops.withColumn("depth", (F.col("depth") / band).cast("bigint")), "tops")
    steps = paths.where(F.col("depth") % band == 0).withColumn("depth", (F.col("depth") / band).cast("bigint"))
    whole = subtree_totals(smaller, steps, top // band, band).where("depth > 0").join(smaller.select("conv_id", *NODE), NODE)
    above = paths.select("conv_id", F.floor(F.col("depth") / band).alias("band"), F.col("depth").alias("up"), "k1", "k2")
    sent = whole.select("conv_id", (F.col("depth") - 1).alias("band"), "saved", "leaves").join(above, ["conv_id", "band"])
    both = inside.unionByName(sent.select("k1", "k2", F.col("up").alias("depth"), "saved", "leaves"))
    return both.groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its rows of joined ids, which arrive in order."""
    now, state = None, None

    def done(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NODE, "ends_sha256"])

    for batch in batches:
        ended = []
        for k1, k2, depth, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if (k1, k2, depth) == now:
                state.update(b",")
            else:
                if now:
                    ended.append((*now, state.hexdigest()))
                now, state = (k1, k2, depth), hashlib.sha256()
            state.update(ids.encode())
        if ended:
            yield done(ended)
    if now:
        yield done([(*now, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids that end at each node.

    Ids are joined in rows of at most ``BUCKET``; the hash of a node is sequential, so one task reads the rows
    of a node in order and holds one at a time.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    joined = ends.groupBy(*NODE, F.floor(F.col("conv_id") / BUCKET).alias("bucket")).agg(ids.alias("ids"))
    laid = joined.repartition(*NODE).sortWithinPartitions(*NODE, "bucket")
    return laid.mapInArrow(_digests, "k1 bigint, k2 bigint, depth bigint, ends_sha256 string")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, depth from 1, digest of the turn, bytes of its text).

    ``convs`` has conv_id and length of every conversation, also of those without turns, which end at the root.
    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and the node's key k1, k2. Without conversations there are no nodes.
    """
    mixed = F.sha2(F.concat_ws(":", "digest", F.col("depth").cast("string")), 256)
    hashed = rows.select("conv_id", "depth", "bytes", _lane(mixed, 0).alias("l1"), _lane(mixed, 1).alias("l2"))
    keyed = running(hashed, ["depth"], ["l1", "l2"])
    prefixes = materialise(keyed.select("conv_id", "depth", "bytes", F.col("sum_l1").alias("k1"), F.col("sum_l2").alias("k2"), "l1", "l2"), "prefixes")
    zero = F.lit(0).cast("bigint")
    inner = prefixes.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("l1").alias("l1"), F.max("l2").alias("l2")
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"), zero.alias("l1"), zero.alias("l2"))
    found = materialise(inner.unionByName(root), "nodes")
    # The parent's key is the node's without its own hash: a difference modulo 2^64, by way of decimals.
    circle = F.lit(Decimal(1 << 64))

    def without(key: str, own: str) -> Column:
        return F.conv(((F.col(key).cast("decimal(20,0)") - F.col(own) + circle) % circle).cast("decimal(20,0)").cast("string"), 10, -10).cast("bigint")

    linked = materialise(
        found.select("*", without("k1", "l1").alias("p1"), without("k2", "l2").alias("p2"), (F.col("depth") - 1).alias("up")).drop("l1", "l2"), "linked"
    )
    children = linked.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("up").alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = materialise(
        linked.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes"
    )
    parents = nodes.where("n_children > 0").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("depth").alias("up"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n")
    )
    below = lookup(nodes.where("depth > 0"), parents, ["p1", "p2", "up"])
    placed = below.unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))

    weighed = nodes.select(
        "conv_id", *NODE, ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaves")
    )
    paths = prefixes.select("conv_id", *NODE).unionByName(convs.select("conv_id", zero.alias("k1"), zero.alias("k2"), zero.alias("depth")))
    top = prefixes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(weighed, paths, top)

    last = convs.select("conv_id", F.col("length").alias("depth"))
    ends = last.where("depth > 0").join(prefixes.select("conv_id", *NODE), ["conv_id", "depth"]).select("conv_id", *NODE)
    ends = ends.unionByName(last.where("depth = 0").select("conv_id", zero.alias("k1"), zero.alias("k2"), "depth"))
    return (
        placed.join(totals, NODE)
        .join(ends_digests(ends), NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"), "k1", "k2",
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations; see ``rebuild`` for what nulls, ties and repeated rows mean."""
    convs, rows = rebuild(conversations)
    return trie(convs, rows)
