"""Registered text queries against SQL or brute force, over whole small tables."""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
from candlewarden.llm import oracles, packing, queries, syncmers

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


def result(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).toPandas()


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(oracles.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, duck, name):
    found = duck.execute(oracles.ORACLES[name])
    columns = sorted(d[0] for d in found.description)
    order = [columns.index(c) for c in columns]
    names = [d[0] for d in found.description]
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in found.fetchall()), key=repr)
    df = queries.QUERIES[name](spark, SF_DIR)
    actual = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert sorted(df.columns) == columns and order == list(range(len(columns)))
    assert actual == expected


def plain_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    label = list(range(len(ids)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    codes = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 2):
            a, b = find(i), find(i + 1 + int(j))
            label[max(a, b)] = min(a, b)
    least = defaultdict(lambda: 1 << 62)
    for i, d in enumerate(ids):
        least[find(i)] = min(least[find(i)], d)
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_components(spark, documents):
    found = result(spark, "op1_simhash").sort_values("doc_id")
    documents = documents.sort_values("doc_id")
    prints = [plain_simhash(t) for t in documents.text]
    assert found.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    expected = plain_components(documents.doc_id.tolist(), prints)
    assert found.component_id.tolist() == expected
    assert len(set(expected)) < len(expected)


def test_token_counts(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = {d: (len(t.encode()), len(model.encode(t))) for d, t in zip(documents.doc_id, documents.text, strict=True)}
    found = result(spark, "op2_token_counts")
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found.itertuples()} == expected
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found.itertuples())


def test_packing(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = result(spark, "op3_packing").sort_values(["doc_id", "start"])
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in zip(documents.doc_id, documents.text, strict=True)}
    end = Counter()
    for r in found.itertuples():
        assert r.start == end[r.doc_id] and r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        end[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert end == Counter({d: len(x) for d, x in ids.items()})
    for _, pieces in found.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]]
        total = int(pieces.length.sum())
        assert total == 2048 or total & (total - 1) == 0


@pytest.mark.parametrize("folder", sorted({SF_DIR, "/root/testdata/sf0.01", "/root/testdata/sf0.1"}))
def test_html_text(spark, folder):
    if not os.path.isdir(folder):
        pytest.skip("test tables absent")
    pages = pd.read_parquet(f"{folder}/pages.parquet")
    import html
    import re

    def plain(page):
        body = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>|<br>", body)
        return " ".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts) if x)

    found = queries.QUERIES["op4_html_text"](spark, folder).toPandas().set_index("page_id")
    for r in pages.itertuples():
        assert found.text[r.page_id] == plain(r.html)
        assert found.n_chars[r.page_id] == len(found.text[r.page_id])
        assert found.url[r.page_id] == r.url


@pytest.mark.parametrize(("name", "label"), [("op7_quality_nbsvm", "quality"), ("op8_toxicity_cnn", "toxic")])
def test_scores_of_held_out_documents(spark, name, label):
    found = result(spark, name)
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.itertuples())
    assert found.score.between(0, 1).all() and len(found) == len(pd.read_parquet(f"{SF_DIR}/documents.parquet"))
    known = found.merge(labels, on="doc_id")
    apart = known[known.held_out]
    base = max(apart[label].mean(), 1 - apart[label].mean())
    assert (apart.predicted == apart[label]).mean() >= base - 0.05
    pd.testing.assert_frame_equal(found.sort_values("doc_id", ignore_index=True), result(spark, name).sort_values("doc_id", ignore_index=True))


def test_warc_history_is_in_order(spark, tmp_path):
    from candlewarden.llm import warc_index

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = warc_index.archive_and_index(pages, 3, str(tmp_path / "warc")).collect()
    keys = [(warc_index._flat(r), r["page_id"]) for r in sorted(rows, key=lambda r: r["part"])]
    assert keys == sorted(keys) and len({r["part"] for r in rows}) == 3
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in rows:
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw[r["page_id"]].encode()).digest()).decode()


def plain_anchors(text):
    words = text.encode().split()
    chain = lambda *parts: __import__("functools").reduce(lambda seed, b: xxhash.xxh64_intdigest(b, seed), parts, 42)
    long = lambda x: (x & (1 << 64) - 1).to_bytes(8, "little")
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    if len(words) < syncmers.K:
        return [chain(b" ".join(words)) & 0x7FFFFFFF] if words else []
    inner = [signed(chain(a, b)) for a, b in zip(words, words[1:], strict=False)]
    n = syncmers.K - syncmers.S + 1
    chosen, every = [], []
    for i in range(len(inner) - n + 1):
        window = inner[i : i + n]
        # pairs of words that cover all of the k-mer's words
        every.append(chain(*(long(window[k]) for k in (0, 2, 4, n - 1))) & 0x7FFFFFFF)
        if min(window[0], window[-1]) == min(window):
            chosen.append(every[-1])
    return chosen or [min(every)]


def test_syncmers(spark, documents):
    rows = documents.sort_values("doc_id", ascending=False)
    texts = rows.text.tolist()
    found = result(spark, "op10_syncmers").set_index("doc_id")

    def like(a, b):
        a, b = set(a), set(b)
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

    for k, (doc_id, text) in enumerate(zip(rows.doc_id, texts, strict=True)):
        follower = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        r = found.loc[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == " ".join(map(str, plain_anchors(text)))
        assert r.edited_fingerprint == " ".join(map(str, plain_anchors(edited)))
        assert r.near_edited == pytest.approx(like(plain_anchors(text), plain_anchors(edited)))
        assert r.near_next == pytest.approx(like(plain_anchors(text), plain_anchors(follower)))


def test_packing_remembers_the_words_of_many_documents():
    """A task meets some 370,000 distinct words in 20 MB of text; the common ones must not be computed again and again."""
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    computed = []
    words.memo.compute = lambda word: computed.append(word) or b""
    text = b" ".join(b"w%d" % k for k in range(200_000))
    words.of(text + b" " + text)
    assert len(computed) == 200_000
