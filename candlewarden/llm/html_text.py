"""Main text of web pages: page structure, and a suffix array per host over what stands around the articles.

A page falls into blocks of text, and structure says where each stands: inside an article or main
element or around it, and whether its element or class marks it as a menu, advert, comments and so on.
Marked blocks are never main text, nor are article elements with a class or id of a comment, advert and
so on. Text inside main elements is main text. What stands around them, the host decides: the token streams
around the main elements of its pages (all text of pages without one) are concatenated, and a suffix array with
the common prefixes of neighbours finds the substrings of at least ``RUN`` tokens that distinct pages share.
Tokens that such a run covers go; the unique runs stay, on a page with a main element only if they are more words
than its text: then the elements were cards around the body. Runs never remove text inside a main element: a
sentence of an article may be in any number of footers, and articles share passages, so being repeated says
nothing there.

A host may hold any share of the pages: its pages are dealt into groups by the number of their tokens, counted
beforehand. The rules count the distinct pages of the whole host: copies (equal blocks in equal places) are one
page. Every group lists its runs with page counts, the counts are added up by run over the groups of the host,
and each group gets back which of its runs the host decided on; so the result does not depend on the groups.
Runs are told apart there by 64-bit hashes. No article text is moved for this: verdicts (bits per token) go back
to the pages, and only of pages that have something to decide.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewarden.functions.chunks import join_series_values
from candlewarden.llm.common import materialise

RUN = 8
GROUP = 100_000  # tokens of a group of a host

# where a block stands: around the main element, around it and marked, inside it, inside it as a heading
AROUND, MARKED_OUT, INSIDE, HEADING = range(4)

# Element names of HTML by their part in a page.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas select textarea".split())
RAW = frozenset("script style textarea title".split())
ASIDE = frozenset("nav aside footer form dialog menu button".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class, id or role that mark what is not main text.
MARKED = re.compile(
    r"(?:^|[\s_-])(?<!has-)(?<!with-)(?<!no-)(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|"
    r"footer|masthead|comments?|respond|replies|cookies?|consent|notice|notification|alert|popup|modal|"
    r"newsletter|subscribe|share|sharing|social|related|widget|login|signup|search|complementary|contentinfo)(?:$|[\s_-])",
    re.IGNORECASE,
)

# The names of an article element that is a card or comment. Whole names only: themes also put words of
# the page's topic or state into the class of its one article (category-social-media).
CARD = re.compile(rf"(?:{MARKED.pattern})|(?:div-)?comment-(?:body|content|card|item|\d+)|teaser|card", re.IGNORECASE)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, where it stands) for each block of a page, in page order; marked parts stand outside everywhere."""
    found: list[tuple[str, int]] = []
    text: list[str] = []
    # open elements: name, whether it is main, whether it is hidden or set aside
    stack: list[tuple[str, bool, int]] = []
    main = aside = hidden = heads = 0

    def end_block() -> None:
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if whole:
                found.append((whole, MARKED_OUT if aside else AROUND if not main else HEADING if heads else INSIDE))

    def close(depth: int) -> None:
        nonlocal main, aside, hidden, heads
        while len(stack) > depth:
            name, was_main, was = stack.pop()
            heads -= name in HEADINGS
            main -= was_main
            aside -= was == 1
            hidden -= was == 2

    at = 0
    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        upto = m.start() if m else size
        if upto > at and not hidden:
            text.append(page[at:upto])
        if not m:
            break
        at = max(m.end(), upto + 1)
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in VOID:
            if not hidden:
                if name in INLINE:
                    continue
                text.append(" ") if name == "br" else end_block()
            continue
        if name not in INLINE:
            end_block()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                close(depth)
            continue
        if name in RAW or name in HIDDEN and name in ("noscript", "iframe"):
            closing = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            at = closing.end() if closing else size
            continue
        if name == "p" or name == "li":  # their end tags may be left out
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name or stack[k][0] not in INLINE), None)
            if depth is not None and stack[depth][0] == name:
                close(depth)
        attributes = m[3] or ""
        marks = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes)) if attributes.strip() else ""
        was = 2 if name in HIDDEN or name == "head" else 0
        if not was and (
            name in ASIDE
            or (name == "header" and not main)
            or (name not in ("html", "body", *MAIN) and marks and MARKED.search(marks))
            or (name == "article" and any(map(CARD.fullmatch, marks.split())))
        ):
            was = 1
        if name == "body":  # a head whose end tag is left out
            close(next((k for k in range(len(stack)) if stack[k][0] == "head"), len(stack)))
        if not attributes.rstrip().endswith("/"):
            stack.append((name, name in MAIN, was))
            main += name in MAIN
            heads += name in HEADINGS
            aside += was == 1
            hidden += was == 2
    end_block()
    return found


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def suffix_array(codes: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes of ``codes`` in order, by doubling the compared length, at least up to ``depth`` (None: in full)."""
    n = len(codes)
    depth = n if depth is None else min(depth, n)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:] if step < n else second[: n - step]
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = new
        step *= 2
        if rank.max(initial=0) == n - 1 or step >= depth:
            return order


def common_prefixes(codes: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For neighbours in suffix order, the length of their common prefix, up to ``most``."""
    a, b = order[:-1], order[1:]
    length = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for k in range(most):
        x, y = a[open_] + k, b[open_] + k
        inside = (x < len(codes)) & (y < len(codes))
        open_, x, y = open_[inside], x[inside], y[inside]
        same = codes[x] == codes[y]
        open_ = open_[same]
        length[open_] += 1
    return length


class _Streams:
    """Token streams end to end, each followed by a sign of its own: no run crosses streams.

    ``pages`` tells the page of a stream (one each by default).
    """

    def __init__(self, streams: list, run: int = RUN, pages: list[int] | None = None):
        self.run, self.sizes = run, np.array([len(s) for s in streams], np.int64)
        owners = np.arange(len(streams)) if pages is None else np.array(pages, np.int64)
        ends = -np.arange(1, len(streams) + 1)
        self.codes = np.concatenate(
            [np.empty(0, np.int64), *(np.r_[np.asarray(s, np.int64), e] for s, e in zip(streams, ends, strict=True))]
        )
        self.page = np.repeat(owners, self.sizes + 1)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.n_pages = int(owners.max(initial=0)) + 1

    def fits(self) -> np.ndarray:
        """For each place, whether a whole run starts there."""
        return np.arange(len(self.codes)) + self.run <= np.repeat(self.starts[1:] - 1, self.sizes + 1)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, number of the run there) for all places where a whole run starts."""
        order = suffix_array(self.codes)
        # suffixes that share at least ``run`` tokens with their neighbours are one interval
        shared = common_prefixes(self.codes, order, int(self.sizes.max(initial=0)))
        group = np.concatenate([[0], np.cumsum(shared < self.run)])
        at = np.flatnonzero(self.fits()[order])
        return order[at], np.unique(group[at], return_inverse=True)[1]

    def counts(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """How many pages have each run."""
        pairs = np.unique(group * self.n_pages + self.page[at])
        return np.bincount(pairs // self.n_pages, minlength=int(group.max(initial=-1)) + 1)

    def covered(self, hit: np.ndarray) -> list[np.ndarray]:
        """For each stream, which tokens lie in a run that starts at one of the places ``hit``."""
        change = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, np.minimum(hit + self.run, len(self.codes)), -1)
        found = np.cumsum(change)[:-1] > 0
        return [found[a : a + n] for a, n in zip(self.starts, self.sizes, strict=False)]


def repeated(streams: list[list[int]], run: int = RUN, pages: list[int] | None = None) -> list[np.ndarray]:
    """For each stream of token numbers: which tokens lie in a run of ``run`` that another page has too."""
    own = _Streams(streams, run, pages)
    if not own.sizes.sum():
        return [np.zeros(n, bool) for n in own.sizes]
    at, group = own.runs()
    return own.covered(at[(own.counts(at, group) > 1)[group]])


EVIDENCE = "host string, content binary, tokens binary, layout binary, open boolean"
COUNTED = "host string, bucket bigint, part bigint, runs binary, pages binary"
DECIDED = "host string, part bigint, runs binary"
VERDICT = "content binary, gone binary"
PAGE = "page_id bigint, url string, content binary, text string, blocks string"
FOUND = "page_id bigint, url string, text string, n_boilerplate bigint"
_FACTOR = 0x9E3779B97F4A7C15  # odd; a run's hash is a polynomial in it over the hashes of its words


def _content(host: str, found: list[tuple[str, int]]) -> bytes:
    return hashlib.blake2b(json.dumps([host, found]).encode(), digest_size=16).digest()


def _is_open(found: list[tuple[str, int]]) -> bool:
    return any(stand == AROUND for _, stand in found)


def _hashed(words: list[str]) -> bytes:
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], "<u8").tobytes()


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed tokens of each page's streams around main elements, and their lengths."""
    for batch in batches:
        hosts = batch.column("host").to_pylist()
        rows: list[tuple] = []
        for host, page in zip(hosts, batch.column("html").to_pylist(), strict=True):
            found = blocks(page or "")
            streams: list[list[str]] = []
            outside = False
            for text, stand in found:
                if stand < INSIDE:
                    if not outside:
                        streams.append([])
                    streams[-1].extend(text.split())
                outside = stand < INSIDE
            layout = np.array([len(words) for words in streams], "<i4").tobytes()
            rows.append((_content(host, found), _hashed([w for words in streams for w in words]), layout, _is_open(found)))
        contents, tokens, layouts, is_open = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host"),
                *(pa.array(c, pa.binary()) for c in (contents, tokens, layouts)),
                pa.array(is_open, pa.bool_()),
            ],
            ["host", "content", "tokens", "layout", "open"],
        )


class _Group:
    """The streams of a group of a host's pages."""

    def __init__(self, table: pa.Table):
        self.layouts = [np.frombuffer(x, "<i4") for x in table["layout"].to_pylist()]
        self.hashes, codes = np.unique(np.frombuffer(b"".join(table["tokens"].to_pylist()), "<u8"), return_inverse=True)
        sizes = np.concatenate([np.empty(0, "<i4"), *self.layouts])
        owners = np.repeat(np.arange(len(self.layouts)), [len(x) for x in self.layouts])
        self.streams = _Streams(np.split(codes, np.cumsum(sizes)[:-1]) if len(sizes) else [], RUN, owners.tolist())

    def runs(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the runs at the places ``at``, the same in every group."""
        total = np.zeros(len(at), np.uint64)
        for k in range(RUN):
            total = total * np.uint64(_FACTOR) + self.hashes[self.streams.codes[at + k]]
        return total


def _counted(table: pa.Table) -> pa.Table:
    """All runs of one group with its page counts, packed by bucket of their hash."""
    group, rows = _Group(table), []
    host, part, parts = (table[c][0].as_py() for c in ("host", "part", "parts"))
    if group.streams.sizes.sum():
        at, run = group.streams.runs()
        if len(at):
            counts = group.streams.counts(at, run)
            runs = group.runs(at[np.unique(run, return_index=True)[1]])
            bucket = (runs % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((runs, bucket))
            cuts = np.searchsorted(bucket[order], np.arange(parts + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                chosen = order[cuts[k] : cuts[k + 1]]
                rows.append((host, k, part, runs[chosen].tobytes(), counts[chosen].astype("<u4").tobytes()))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["host", "bucket", "part", "runs", "pages"]
    return pa.table({c: pa.array([r[k] for r in rows], kinds[k]) for k, c in enumerate(names)})


def _add_up(table: pa.Table) -> pa.Table:
    """The runs of a bucket that the host has on more than one page; each group gets those that it has."""
    sizes = [len(x) // 8 for x in table["runs"].to_pylist()]
    runs, run = np.unique(np.frombuffer(b"".join(table["runs"].to_pylist()), "<u8"), return_inverse=True)
    pages = np.bincount(run, np.frombuffer(b"".join(table["pages"].to_pylist()), "<u4"), len(runs))
    found = [runs[x[pages[x] > 1]].tobytes() for x in np.split(run, np.cumsum(sizes)[:-1])]
    return pa.table({"host": table["host"], "part": table["part"], "runs": pa.array(found, pa.binary())})


def _verdicts(table: pa.Table, decided: pa.Table) -> pa.Table:
    """Which tokens around the main element go, as packed bits, for each page that has unmarked text there."""
    group, rows = _Group(table), []
    own = group.streams
    fits = np.flatnonzero(own.fits())
    known = np.frombuffer(b"".join(decided["runs"].to_pylist()), "<u8")
    covered = own.covered(fits[np.isin(group.runs(fits), known)])
    at = 0
    for content, layout, is_open in zip(table["content"].to_pylist(), group.layouts, table["open"].to_pylist(), strict=True):
        if is_open:
            rows.append((content, np.packbits(np.concatenate(covered[at : at + len(layout)])).tobytes()))
        at += len(layout)
    return pa.table({c: pa.array([r[k] for r in rows], pa.binary()) for k, c in enumerate(("content", "gone"))})


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text inside main elements; of pages with unmarked text around them also all blocks."""
    for batch in batches:
        rows: list[tuple] = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = blocks(page or "")
            inside = " ".join(text for text, stand in found if stand >= INSIDE)
            is_open = _is_open(found)
            rows.append((_content(host, found), inside, json.dumps(found) if is_open else None))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        new = [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.string(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *new], ["page_id", "url", "content", "text", "blocks"])


def _kept(found: list[list], gone: np.ndarray) -> tuple[str, int]:
    """Main text of a page with text around its main element, and how many of those words the host removed."""
    left: list[tuple[list[str], int]] = []  # words and where they stand
    n, at, weight = 0, 0, [0, 0]
    for text, stand in found:
        words = text.split()
        if stand < INSIDE:
            out = gone[at : at + len(words)].tolist()
            at += len(words)
            if stand == MARKED_OUT:
                continue
            n += sum(out)
            words = [word for word, is_gone in zip(words, out, strict=True) if not is_gone]
        left.append((words, stand))
        weight[stand >= INSIDE] += len(words)
    around = weight[0] > weight[1]
    return " ".join(word for words, stand in left if stand >= INSIDE or around for word in words), n


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = [], []
        for text, found, gone in zip(*(batch.column(c).to_pylist() for c in ("text", "blocks", "gone")), strict=True):
            n = 0
            if found is not None:
                text, n = _kept(json.loads(found), np.unpackbits(np.frombuffer(gone, np.uint8)).astype(bool))
            texts.append(text)
            removed.append(n)
        new = [pa.array(texts, pa.string()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *new], ["page_id", "url", "text", "n_boilerplate"])


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars, n_boilerplate (words that the host removed).

    Null html is an empty page; a null or odd URL belongs to the host "". Repeated rows and other copies on
    a host count as one page, and each gets its text. Other columns are not read. Pages are parsed twice, for
    the evidence and for the text, which is cheaper than moving them.
    """
    hosted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    # a page without text around its main element is no evidence and needs no verdict
    evidence = hosted.select("host", "html").mapInArrow(_evidence, EVIDENCE).where(F.octet_length("layout") > 0)
    evidence = materialise(evidence.dropDuplicates(["host", "content"]), "evidence")
    sizes = evidence.groupBy("host").agg((F.sum(F.octet_length("tokens")) / (8 * GROUP) + 1).cast("bigint").alias("parts"))
    # only hosts that need more than one group: few, whatever the number of hosts
    split = materialise(sizes.where("parts > 1"), "hosts")
    parts = evidence.join(split, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    dealt = parts.withColumn("part", F.pmod(F.xxhash64("content"), "parts"))
    counted = dealt.groupBy("host", "part").applyInArrow(_counted, COUNTED)
    decided = counted.groupBy("host", "bucket").applyInArrow(_add_up, DECIDED)
    verdicts = dealt.groupBy("host", "part").cogroup(decided.groupBy("host", "part")).applyInArrow(_verdicts, VERDICT)
    # the content's hash has the host in it
    read = hosted.mapInArrow(_read, PAGE)
    found = join_series_values(read, verdicts, ["content"], "page_id").mapInArrow(_assembled, FOUND)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_boilerplate")
