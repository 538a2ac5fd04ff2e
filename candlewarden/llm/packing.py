"""Packing token sequences by minimum bin slack.

Documents are cut into full windows; what remains of each (shorter than a window) waits in a pool. A
window is filled with the largest waiting length and the multiset of other waiting lengths whose sum
comes closest to the capacity: a subset-sum table over the lengths, one bit per reachable sum and one
table per doubled count, walked back to the counts. A gap that no multiset fills is filled by cutting a
waiting piece. What is left at the end of a partition goes to sequences of power-of-two length, which
need no padding. Each task packs its own rows: nothing is shuffled, the pool bounds the memory, and a
task that runs again makes the same sequences.
"""

from __future__ import annotations

import bisect
import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from candlewarden.llm.common import Memo, as_bytes

CAPACITY = 2048
END = 1
POOL = 4096  # pieces that wait in a task; each is shorter than a window
_FLUSH = 8 << 20
WORDS, RUNS = 300_000, 250_000  # words and runs whose ids a worker remembers; about 200 bytes each

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


# A run of precomposed Latin letters or of ASCII punctuation without the apostrophe.
# Not among them: the dotted capital I, whose lower case is two characters.
_RUN = re.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+|[!-&(-/:-@\[-`{-~]+")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Token ids of whole texts, word by word.

    The tokenizer drops white space and merges only inside words, so a text's ids are those of its
    words in turn; it also never merges letters with punctuation, so a word made of plain runs of both
    is taken apart further. A tokenizer that is not like that is refused.

    A lower-case run is normal already and one pre-token, so only the merges of the vocabulary are left
    to do, over the signs by which the vocabulary writes the run's bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {
            byte: sign
            for c in map(chr, range(0x250))
            for byte, sign in zip(c.encode(), by_bytes.pre_tokenize_str(c)[0][0], strict=True)
        }
        self.memo = Memo(self._ids, WORDS)
        self.runs = Memo(self._run_ids, RUNS)
        if any("<|" not in t.content for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("this tokenizer has added tokens that may be plain runs")
        probe = "One two,\tTHREE!!\n\n|x|  four's Été%%% 5 (ab)-c ÀÿžŒ"
        whole = self._encode(probe)
        words = [i for w in probe.split() for i in self._encode(w)]
        if whole != words or whole != np.frombuffer(self.of(probe.encode()), "<u4").tolist():
            raise ValueError("this tokenizer does not work word by word")

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _run_ids(self, run: str) -> bytes:
        signs = run.encode().decode("latin-1").translate(self.signs)
        return _packed([t.id for t in self.merges.tokenize(signs)])

    def _ids(self, word: bytes) -> bytes:
        plain = word.decode()
        if _RUN.fullmatch(plain):
            return self.runs[plain.lower()]
        runs = _RUN.findall(plain)
        if sum(map(len, runs)) == len(plain) and "<|" not in plain:
            return b"".join([self.runs[run.lower()] for run in runs])
        return _packed(self._encode(plain))

    def of(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        # Lowering A-Z first halves the distinct words. It changes no ids, except for the added tokens' signs
        # and before combining marks (U+0300 to U+036F), some of which compose with small letters only.
        if not any(sign in text for sign in (b"<|", b"\xcc", b"\xcd")):
            text = text.lower()
        return b"".join(map(self.memo.__getitem__, text.split()))


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def closest(lengths: list[int], count, capacity: int) -> tuple[dict[int, int], int]:
    """Counts of lengths (ascending list; ``count(length)`` are there) whose sum is the closest up to ``capacity``."""
    reach, limit, tables = 1, (1 << capacity + 1) - 1, []
    for length in reversed(lengths[: bisect.bisect_right(lengths, capacity)]):
        left, take = min(count(length), capacity // length), 1
        while left and not reach >> capacity & 1:
            take = min(take, left)
            tables.append((length, take, reach))
            reach |= reach << length * take & limit
            left, take = left - take, take * 2
        if reach >> capacity & 1:
            break
    at = total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(tables):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used, total


class Pool:
    """Waiting pieces by length; a piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int):
        self.capacity, self.by, self.lengths, self.size, self.tokens = capacity, {}, [], 0, 0

    def add(self, piece: tuple) -> None:
        length = len(piece[2]) // 4
        if length not in self.by:
            self.by[length] = []
            bisect.insort(self.lengths, length)
        self.by[length].append(piece)
        self.size += 1
        self.tokens += length

    def take(self, length: int) -> tuple:
        waiting = self.by[length]
        piece = waiting.pop()
        if not waiting:
            del self.by[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))
        self.size -= 1
        self.tokens -= length
        return piece

    def window(self) -> list[tuple]:
        """The pieces of the next window."""
        pieces = [self.take(self.lengths[-1])]
        gap = self.capacity - len(pieces[0][2]) // 4
        used, total = closest(self.lengths, lambda n: len(self.by[n]), gap)
        for length, n in used.items():
            pieces += [self.take(length) for _ in range(n)]
        gap -= total
        if gap and self.size:  # every waiting piece of at most ``gap`` has been used
            doc_id, start, ids, n = self.take(self.lengths[bisect.bisect_right(self.lengths, gap)])
            pieces.append((doc_id, start, ids[: 4 * gap], n))
            self.add((doc_id, start + gap, ids[4 * gap :], n))
        return pieces


def _tail(pieces: list[tuple], capacity: int) -> Iterator[list[tuple]]:
    """Share out the last pieces over sequences of power-of-two lengths, longest first."""
    left = sum(len(p[2]) // 4 for p in pieces)
    waiting = list(reversed(pieces))
    while left:
        room = min(capacity, 1 << left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            doc_id, start, ids, n = waiting.pop()
            cut = min(room, len(ids) // 4)
            sequence.append((doc_id, start, ids[: 4 * cut], n))
            if 4 * cut < len(ids):
                waiting.append((doc_id, start + cut, ids[4 * cut :], n))
            room -= cut
        yield sequence


def sequences(documents: Iterator[tuple[int | None, bytes]], capacity: int = CAPACITY, most: int = POOL) -> Iterator[list[tuple]]:
    """Pack (doc_id, ids as 32-bit little-endian) into lists of pieces (doc_id, start, ids, doc_tokens)."""
    pool = Pool(capacity)
    for doc_id, ids in documents:
        n = len(ids) // 4
        for start in range(0, n - capacity + 1, capacity):
            yield [(doc_id, start, ids[4 * start : 4 * (start + capacity)], n)]
        if n % capacity:
            start = n - n % capacity
            pool.add((doc_id, start, ids[4 * start :], n))
        while pool.size > most and pool.tokens >= capacity:
            yield pool.window()
    rest: list[tuple] = []
    while pool.size:
        pieces = pool.window()
        if sum(len(p[2]) // 4 for p in pieces) == capacity:
            yield pieces
        else:
            rest += pieces
    yield from _tail(rest, capacity)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and then ``end``; null and empty texts are that id alone. Each
    row of ``docs`` is packed by itself, so repeated rows come twice; a null doc_id stays null. Other
    columns are not read. An empty table gives no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = word_ids(tokenizer_path).of, np.array([end], "<u4").tobytes()
        number = (TaskContext.get().partitionId() << 33) - 1
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        rows: list[tuple] = []
        held = 0

        def documents():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), (encode(x) + last for x in as_bytes(batch.column(1))), strict=True)

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for sequence in sequences(documents(), capacity, pool):
            number += 1
            offset = 0
            for doc_id, start, ids, n in sequence:
                rows.append((doc_id, start, len(ids) // 4, ids, n, number, offset))
                offset += len(ids) // 4
                held += len(ids)
            if held > _FLUSH:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
