"""Tokens of two tokenizers aligned by their bytes, with corpus-wide counts of linked id pairs.

Both token streams of a text tile the same bytes. Every token points to the farthest-right token that it
overlaps (of equal ends, that of the second tokenizer); doubling these successors, for all texts of a
block at once, carries each token to the terminal token of its component in logarithmically many steps.
A component is a group: it lies between two byte offsets where tokens of both sides end.

Counting pairs over the corpus must not send every link through a shuffle. Each task adds up its own
pairs first. The most frequent pairs, at most ``HEAD`` of them, then go to every task, where they settle
nearly all links; only links of the other pairs are shuffled, and none of those pairs is frequent.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer, pre_tokenizers

from candlewarden.llm.common import as_bytes, materialise

HEAD = 400_000  # pairs whose counts every task holds: 17 bytes each
_BLOCK = 1 << 20  # bytes of text aligned at a time
_HELD = 1 << 21  # distinct pairs a counting task holds before it hands them on
ADDED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, pair_links array<int>"
_ROW = "_cw_row"


class Side:
    """What one vocabulary adds to the alignment: the bytes of each id, as a list and as lengths."""

    def __init__(self, entries: list[bytes]):
        self.entries, self.lengths = entries, np.array([len(x) for x in entries], np.int64)

    def spells(self, ids: list[int], target: bytes) -> bool:
        return b"".join(map(self.entries.__getitem__, ids)) == target


class Aligner:
    """Encodes texts both ways and aligns them; made once per worker."""

    def __init__(self, a_path: str, b_path: str):
        whole = Tokenizer.from_file(a_path)
        whole.encode_special_tokens = True
        special = {t.content for t in whole.get_added_tokens_decoder().values()}
        # A byte is written as the character of its number where that can be seen; the others take the further signs in turn.
        alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
        unseen = [byte for byte in range(256) if chr(byte) not in alphabet]
        signs = {c: ord(c) for c in alphabet if ord(c) < 256} | dict(zip([c for c in alphabet if ord(c) > 255], unseen, strict=True))
        vocabulary = whole.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            entries[i] = token.encode() if token in special else bytes(signs[s] for s in token)
        self.a = Side(entries)
        # The vocabulary's ids are the ranks of its merges, so the faster library gives the same ids.
        ranks = {entries[i]: i for token, i in vocabulary.items() if token not in special}
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        probe = " One two,\tTHREE!!\n\n|x|  four's Été%%% 1234 (ab)-c Š中文 <|endoftext|> ▁ it'll"
        if self.fast.encode_ordinary(probe) != whole.encode(probe, add_special_tokens=False).ids:
            raise ValueError("the ids of this vocabulary are not the ranks of its merges")

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b = Side(
            [
                bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
                for i in range(model.get_piece_size())
            ]
        )

    def encode(self, text: bytes) -> tuple[list[int], list[int]]:
        """Ids of both sides; none where either side does not spell a space and the text."""
        if text:
            plain, target = text.decode(), b" " + text
            a, b = self.fast.encode_ordinary(" " + plain), self.model.encode(plain)
            if self.a.spells(a, target) and self.b.spells(b, target):
                return a, b
        return [], []

    def align(self, texts: list[bytes]) -> list[pa.Array]:
        """The columns of ``ADDED`` for a block of texts."""
        coded = [self.encode(x) for x in texts]
        counts = [np.array([len(pair[side]) for pair in coded], np.int64) for side in (0, 1)]
        a, b = (np.fromiter((i for pair in coded for i in pair[side]), np.int64, counts[side].sum()) for side in (0, 1))
        return aligned(a, b, *counts, self.a.lengths, self.b.lengths)


def vocabulary_size(b_path: str) -> int:
    """How many ids the second vocabulary has: pair codes are A's id times this, plus B's id."""
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def terminals(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the place in B of the last token of its component, by pointer jumping."""
    n = len(ends_a)
    over_a = np.searchsorted(starts_b, ends_a, "left") - 1  # the last token of B that begins before A's ends
    over_b = np.searchsorted(starts_a, ends_b, "left") - 1
    farther = ends_a[over_b] > ends_b if n else np.zeros(0, bool)
    jump = np.concatenate([n + over_a, np.where(farther, over_b, n + np.arange(len(ends_b)))])
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump[:n] - n, jump[n:] - n
        jump = further


def _written(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of every id followed by its mark, as one buffer, and where each id's bytes begin."""
    digits = np.ones(len(ids), np.int64)
    for k in range(1, 10):
        digits += ids >= 10**k
    begins = np.concatenate([[0], np.cumsum(digits + 1)])
    out = np.empty(begins[-1], np.uint8)
    last = begins[1:] - 2
    left = ids.copy()
    for k in range(int(digits.max(initial=0))):
        at = digits > k
        out[last[at] - k] = 48 + left[at] % 10
        left //= 10
    out[begins[1:] - 1] = marks
    return out, begins


def aligned(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray
) -> list[pa.Array]:
    """Align the concatenated ids of a block of texts, of which text k has ``n_a[k]`` and ``n_b[k]``."""
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    starts_a, starts_b = ends_a - size_a[a], ends_b - size_b[b]
    at_a, at_b = terminals(starts_a, ends_a, starts_b, ends_b)
    texts = np.arange(len(n_a))
    text_a, text_b = np.repeat(texts, n_a), np.repeat(texts, n_b)
    is_last = at_b == np.arange(len(b))
    n_groups = np.bincount(text_b[is_last], minlength=len(n_a))

    # groups as text: the tokens of A, then of B, group by group; the mark after a token tells what follows
    side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
    group = np.concatenate([at_a, at_b])
    order = np.argsort(2 * group + side, kind="stable")
    side, group = side[order], group[order]
    marks = np.full(len(order), ord(","), np.uint8)
    if len(order):
        closes = np.r_[group[1:] != group[:-1], True]
        marks[closes] = ord(";")
        marks[:-1][(side[1:] != side[:-1]) & ~closes[:-1]] = ord("|")
    buffer, begins = _written(np.concatenate([a, b])[order], marks)
    text_ends = begins[np.cumsum(n_a + n_b)]
    text_starts = np.r_[0, text_ends[:-1]]
    raw = buffer.tobytes()
    groups = pa.array([raw[s : max(s, e - 1)] for s, e in zip(text_starts.tolist(), text_ends.tolist(), strict=True)], pa.binary())

    # links: each token of A with the run of tokens of B that it overlaps
    first = np.searchsorted(starts_b, starts_a, "right") - 1
    width = np.searchsorted(starts_b, ends_a, "left") - first
    of_a = np.repeat(np.arange(len(a)), width)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first, width)
    code = a[of_a] * len(size_b) + b[of_b]
    n_links = np.bincount(text_a, weights=width, minlength=len(n_a)).astype(np.int64)
    by_text = np.lexsort((code, text_a[of_a]))
    code, text = code[by_text], text_a[of_a][by_text]
    new = np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])] if len(code) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    times = np.diff(np.r_[begin, len(code)])
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(text[begin], minlength=len(n_a)))].astype(np.int32))
    return [
        *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)),
        groups.cast(pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(code[begin])),
        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
    ]


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the alignment of each whole text.

    n_a, n_b, n_groups, n_links; ``groups``, the ids of each group in order (``a1,a2|b1;a3|b2,b3``);
    ``pairs``, the distinct linked id pairs (A's id times the size of B's vocabulary, plus B's id), and
    ``pair_links``, how often each is linked. Null and empty texts, and those that a tokenizer does not
    spell byte by byte, have zeros and empty values. Rows are neither moved nor dropped. A column of
    ``docs`` with a name of these is refused.
    """
    added = StructType.fromDDL(ADDED)
    if taken := set(added.names) & set(docs.columns):
        raise ValueError(f"the input already has {', '.join(sorted(taken))}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
            start = held = 0
            for k, x in enumerate(texts):
                held += len(x)
                if held >= _BLOCK or k == len(texts) - 1:
                    part = batch.slice(start, k + 1 - start)
                    new = aligner(a_path, b_path).align(texts[start : k + 1])
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *added.names])
                    start, held = k + 1, 0

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n): in how many of a task's texts each pair is, in parts of at most about ``_HELD`` pairs."""
    codes, counts, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        fresh, n = np.unique(np.concatenate([np.empty(0, np.int64), *waiting]), return_counts=True)
        both, place = np.unique(np.concatenate([codes, fresh]), return_inverse=True)
        return both, np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)

    for batch in batches:
        own = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        waiting.append(own)
        size += len(own)
        if size >= _HELD:
            codes, counts = merged()
            waiting, size = [], 0
            if len(codes) >= _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["pair", "n"])
                codes, counts = codes[:0], counts[:0]
    codes, counts = merged()
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["pair", "n"])


def pair_counts(aligned_docs: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): in how many documents (rows) each pair is linked, and whether no pair of its A id is in more."""
    counts = materialise(
        aligned_docs.select("pairs").mapInArrow(_added_up, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs"
    )
    of_a = F.floor(F.col("pair") / b_size).cast("bigint")
    top = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))  # a row per id of A, so broadcast
    return materialise(
        counts.withColumn("a", of_a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts"
    )


def head_of(counts: DataFrame, most: int = HEAD) -> tuple[int, pa.Table]:
    """The least count of the most frequent pairs, so that at most ``most`` have it, and those pairs by code.

    The cut is found in a table of at most about 900 rows: how many pairs have a count of each size class.
    """
    grade = F.floor(F.log(F.col("n").cast("double")) * 20)
    grades = sorted(counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect(), reverse=True)
    held, least = 0, (1 << 63) - 1
    for row in grades:
        held += row["pairs"]
        if held > most:
            break
        least = row["least"]
    return least, counts.where(F.col("n") >= least).toArrow().sort_by("pair")


def with_pair_counts(aligned_docs: DataFrame, b_size: int, most: int = HEAD) -> DataFrame:
    """``aligned_docs`` without its lists, but with n_best and count_sum.

    count_sum adds up, over the links of a document, the number of documents that have the link's pair;
    n_best is how many links have a pair that is no rarer than any other of its A id. Repeated rows count
    each by itself. ``aligned_docs`` is written once, with a number for each row, as it is read three times.
    """
    rows = materialise(aligned_docs.withColumn(_ROW, F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows, b_size)
    least, head = head_of(counts, most)
    known, n, best = (head.column(c).to_numpy() for c in ("pair", "n", "best"))

    def settle(batches: Iterator[pa.RecordBatch], rest: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, links, ids = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            code, times = pairs.flatten().to_numpy(zero_copy_only=False), links.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(ids)), np.diff(pairs.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
            found = known[at] == code if len(known) else np.zeros(len(code), bool)
            if rest:
                yield pa.RecordBatch.from_arrays([pa.array(x[~found]) for x in (ids[row], code, times)], [_ROW, "pair", "links"])
                continue
            sums, tops = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(sums, row[found], times[found] * n[at[found]])
            np.add.at(tops, row[found], times[found] * best[at[found]])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, sums, tops)], [_ROW, "count_sum", "n_best"])

    lists = rows.select("pairs", "pair_links", _ROW)
    settled = lists.mapInArrow(functools.partial(settle, rest=False), f"{_ROW} bigint, count_sum bigint, n_best bigint")
    tail = lists.mapInArrow(functools.partial(settle, rest=True), f"{_ROW} bigint, pair bigint, links bigint")
    later = tail.join(counts.where(F.col("n") < least), "pair").select(
        _ROW, (F.col("links") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best")
    )
    sums = settled.unionByName(later).groupBy(_ROW).agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.drop("pairs", "pair_links").join(sums, _ROW).drop(_ROW)
