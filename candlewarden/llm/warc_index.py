"""WARC archives of pages, and their capture index by external merge.

Archives are text files of WARC records: the writer ends each row with the two line ends that close a
record, so the files are WARC, compressed as a whole. Reading back, each archive gives one locally sorted run of captures
by (URL key, timestamp). Runs are cut at common boundaries into pieces that go to the task of their
range; there a loser tree merges the pieces, k ways, into one order. A piece is opened only when its
first key is due, so a task holds the pieces that overlap, not its range. Boundaries come from a bounded
sample and decide only how evenly the ranges are dealt.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewarden.llm.common import materialise, working_dir

RECORDS = 1000  # records in an archive at most
PIECE = 2000  # captures in a piece at most
SAMPLE = 4000  # about so many keys give the range boundaries
END = "\r\n\r\n"
START = "WARC/1.1\r\n"
# Fixed value: how a revisit says that its payload is that of the record it refers to.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CAPTURE = (
    "url_key string, ts string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, archive string, place bigint"
)


def base32(hex_digest: Column) -> Column:
    """Base32 of an even number of five-digit hexadecimal groups, as SHA-1 has eight."""
    letters = F.array(*[F.lit(c) for c in _BASE32])

    def four(group: int) -> list[Column]:
        number = F.conv(F.substring(hex_digest, 5 * group + 1, 5), 16, 10).cast("int")
        return [F.element_at(letters, F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1) for shift in (15, 10, 5, 0)]

    return F.concat(*[c for g in range(8) for c in four(g)])


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """One column ``value``: the WARC record of each page, without its closing line ends.

    Of the pages with equal payloads that with the largest page_id holds the payload; the others are
    revisits of it, without a body. Rows with that same page_id and payload all hold it; so do payloads
    whose page ids are all null. The page's id gives the time of capture, as the table has none.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"))
    # copies are counted before the shuffle; only payloads that occur on several pages are joined
    copies = (
        pages.select("page_id", F.sha1(payload.cast("binary")).alias("sha1"))
        .groupBy("sha1")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    copies = materialise(copies, "copies")  # its size is known then: a small one does not make Spark shuffle the pages
    rows = rows.join(copies, "sha1", "left")
    revisit = F.coalesce((F.col("holder").isNotNull()) & ~F.col("page_id").eqNullSafe(F.col("holder")), F.lit(False))
    seconds = F.coalesce(F.col("page_id"), F.lit(0)) % 1_000_000_000
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    name = F.concat(F.lit("page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        _line("WARC-Date", F.date_format(F.expr("timestamp_ntz'2020-01-01 00:00:00'") + F.make_dt_interval(secs=seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), name, F.lit(">"))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<page:"), F.col("holder").cast("string"), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _line("X-Payload-Length", F.octet_length("payload").cast("string")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, body).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the records of ``pages`` as WARC files of at most RECORDS records below ``path``, each compressed with gzip."""
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def url_key(url: str) -> str:
    """The URL with its host reversed by labels, lower case, without scheme, port and fragment."""
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url)
    if not m:
        return url
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


def read_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers, block, place in the file) of each record of an archive, by the lengths that the records state.

    The archive comes in the pieces between ``END + START``. A payload may hold that too, so a record is as many
    pieces as its length asks for; no more than one record is held at a time.
    """
    cut = (END + START).encode()
    at, whole = 0, b""
    for k, chunk in enumerate(chunks):
        whole = whole + cut + chunk if whole else (START.encode() + chunk if k else chunk)
        if not whole.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        stop = whole.find(END.encode()) + 2
        if stop < 2:
            raise ValueError(f"the record at {at} has no end of its headers")
        head = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(whole, whole.index(b"\r\n") + 2, stop)}
        start = stop + 2
        end = start + int(head["content-length"])
        if len(whole) < end:
            continue
        if whole[end:] not in (b"", END.encode()):  # the last record is followed by its line ends
            raise ValueError(f"the record at {at} does not end where it says")
        yield head, whole[start:end], at
        at += end + len(END)
        whole = b""
    if whole:
        raise ValueError(f"the record at {at} is cut short")


def _number(text: str | None) -> int | None:
    return None if text in (None, "<page:null>") else int(text[len("<page:") : -1])


def captures(chunks: Iterator[bytes], archive: str) -> list[tuple]:
    """The captures of an archive as CAPTURE rows, sorted by URL key, time and page.

    Digest and length of a response are taken from its block and must be what its header states.
    """
    rows = []
    for head, block, place in read_records(chunks):
        digest, length = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
        if head["warc-type"] == "response":
            found = base64.b32encode(hashlib.sha1(block).digest()).decode(), len(block)
            if found != (digest, length):
                raise ValueError(f"{archive}: the record at {place} is not what its header states")
        uri = head["warc-target-uri"]
        ts = re.sub(r"\D", "", head["warc-date"])
        rows.append(
            (url_key(uri), ts, _number(head["warc-record-id"]), uri, length, digest, head["warc-type"], _number(head.get("warc-refers-to")), archive, place)
        )
    rows.sort(key=order_key)
    return rows


def order_key(capture: tuple) -> tuple:
    return _flat(capture), -1 if capture[2] is None else capture[2], capture[8], capture[9]


class LoserTree:
    """Merges sorted runs, given as (first row, iterator over the others).

    Inner nodes keep the loser of their match, the overall winner stands at 0.
    """

    def __init__(self, runs: list[tuple[tuple | None, Iterator[tuple]]]):
        self.heads, self.runs = [head for head, _ in runs], [rest for _, rest in runs]
        self.tree = [-1] * max(1, len(runs))
        for k in range(len(runs)):
            self._play(k)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (order_key(x), a) < (order_key(y), b))

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node:
            if self.tree[node] < 0:  # the match waits for its other side
                self.tree[node] = winner
                return
            if self._before(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def head(self) -> tuple | None:
        return self.heads[self.tree[0]] if self.runs else None

    def pop(self) -> tuple:
        winner = self.tree[0]
        first, self.heads[winner] = self.heads[winner], next(self.runs[winner], None)
        self._play(winner)
        return first


def _pieces(rows: list[tuple], cuts: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """A sorted run, cut at the boundaries and into bounded pieces."""
    start = 0
    while start < len(rows):
        part = bisect.bisect_right(cuts, _flat(rows[start]))
        end = start + 1
        while end < len(rows) and end - start < PIECE and bisect.bisect_right(cuts, _flat(rows[end])) == part:
            end += 1
        yield part, rows[start:end]
        start = end


def _flat(row: tuple) -> str:
    return f"{row[0]}\x00{row[1]}"


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_SCHEMA = pa.schema(
    [
        ("url_key", pa.string()),
        ("ts", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("archive", pa.string()),
        ("place", pa.int64()),
    ]
)


def index(spark: SparkSession, path: str, ranges: int) -> DataFrame:
    """All captures of the archives below ``path``: CAPTURE columns and ``part``, ordered by URL key and time.

    The rows of a part are in order, and parts follow each other. Archives are read record by record, whatever
    their size; a compressed file is not split, so a task sees its pieces in order.
    """
    read = spark.read.option("lineSep", END + START).text(path)
    files = read.select(F.col("_metadata.file_name").alias("archive"), "value")

    def sorted_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (archive, chunk or b"")
            for batch in batches
            for archive, chunk in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)
        )
        for archive, chunks in itertools.groupby(rows, key=lambda row: row[0]):
            if found := captures((chunk for _, chunk in chunks), archive):
                yield _arrow(found, _SCHEMA)

    runs = materialise(files.mapInArrow(sorted_run, CAPTURE), "runs")
    share = max(1, runs.count() // SAMPLE)
    keys = runs.where(F.pmod(F.xxhash64("archive", "place"), F.lit(share)) == 0).select(F.concat_ws("\x00", "url_key", "ts").alias("k"))
    sampled = sorted(r["k"] for r in keys.collect())
    cuts = sorted({sampled[len(sampled) * k // ranges] for k in range(1, ranges)}) if sampled else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            run: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run and order_key(run[-1]) > order_key(row):  # the next archive's run begins
                    yield from emit(run)
                    run = []
                run.append(row)
            if run:
                yield from emit(run)

    def emit(run: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts, firsts, blobs = [], [], []
        for part, rows in _pieces(run, cuts):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _SCHEMA) as writer:
                writer.write_batch(_arrow(rows, _SCHEMA))
            parts.append(part)
            firsts.append(_flat(rows[0]))
            blobs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(firsts, pa.string()), pa.array(blobs, pa.binary())], ["part", "first", "piece"]
        )

    def opened(blob: bytes) -> Iterator[tuple]:
        with pa.ipc.open_stream(blob) as reader:
            for batch in reader:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, out = None, LoserTree([]), []
        schema = _SCHEMA.append(pa.field("part", pa.int32()))

        def drain(below: str | None) -> None:
            while (head := tree.head()) is not None and (below is None or _flat(head) < below):
                out.append((*tree.pop(), part))

        for batch in batches:
            for of, first, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                drain(first if of == part else None)
                part = of
                rows = opened(piece)
                waiting = [(h, r) for h, r in zip(tree.heads, tree.runs, strict=True) if h is not None]
                tree = LoserTree([*waiting, (next(rows), rows)])
                if len(out) >= 4 * PIECE:
                    yield _arrow(out, schema)
                    out.clear()
        drain(None)
        if out:
            yield _arrow(out, schema)

    pieces = runs.mapInArrow(cut, "part int, first string, piece binary")
    return (
        pieces.repartition(ranges, "part")
        .sortWithinPartitions("part", "first")
        .mapInArrow(merged, f"{CAPTURE}, part int")
    )


def archive_and_index(pages: DataFrame, ranges: int, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (below ``path``, or the shared folder), read them back, return the index.

    Null html is an empty payload, a null URL an empty one. An empty table gives an empty index. Other
    columns are not read.
    """
    spark = pages.sparkSession
    path = path or f"{working_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return index(spark, path, ranges)
