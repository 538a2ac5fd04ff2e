"""Token alignment against a plain loop over bytes."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from candlewarden.llm import alignment, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    return whole, model, alignment.Aligner(A, B)


def plain(text, libraries):
    """Ids of both sides, groups as text and links, by a walk over byte offsets."""
    whole, model, own = libraries
    a, b = (whole.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
    target = (" " + (text or "")).encode()
    spelled = lambda ids, side: b"".join(side.entries[i] for i in ids) == target
    if not text or not spelled(a, own.a) or not spelled(b, own.b):
        return [], [], "", []
    cover = []
    for ids, side in ((a, own.a), (b, own.b)):
        at, spans = 0, []
        for i in ids:
            spans.append((at, at + len(side.entries[i]), i))
            at += len(side.entries[i])
        cover.append(spans)
    ends = sorted({e for _, e, _ in cover[0]} & {e for _, e, _ in cover[1]})
    groups, start = [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for s, e, i in spans if s >= start and e <= end) for spans in cover))
        start = end
    links = [(i, j) for s, e, i in cover[0] for t, f, j in cover[1] if s < f and t < e] if len(a) < 3000 else None
    return a, b, ";".join(groups), links


def expected(texts, libraries):
    found = [plain(x, libraries) for x in texts]
    count = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [
        (
            len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(count[x] == best[x[0]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for a, b, groups, links in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
def test_query_on_the_whole_table(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    short = docs[docs.text.fillna("").str.len() < 9000]
    found = queries.QUERIES["op11_token_alignment"](spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(found) == len(docs)
    whole = libraries[0]
    assert all(found.n_a[r.doc_id] == len(whole.encode(" " + r.text, add_special_tokens=False).ids) for r in docs.itertuples() if r.text)
    if len(short) == len(docs):
        assert [tuple(found.loc[d, COLUMNS]) for d in docs.doc_id] == expected(docs.text, libraries)
    else:  # the plain walk is too slow for the longest texts; groups do not depend on other documents
        for r in short.itertuples():
            groups = plain(r.text, libraries)[2]
            assert found.groups_sha256[r.doc_id] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


EDGES = [
    None, "", " ", "  ", "a", "<|endoftext|> is text", "▁ is lost", "a\0b", "naïve façade 中文字 🙂🙂 é", "x" * 3000, "\n\n \t 1234567",
    "same text", "same text", "same", "<s> </s> <unk>", "it's we'll", "日本語のテキスト", "﷽" * 5,
]


@pytest.mark.parametrize("most", [0, 7, alignment.HEAD])
def test_odd_texts_and_every_size_of_the_head(spark, libraries, most):
    rows = [(k if k else None, x, "kept") for k, x in enumerate(EDGES)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, pair string").repartition(3)
    scored = alignment.with_pair_counts(alignment.align(docs, A, B), alignment.vocabulary_size(B), most)
    found = {r["doc_id"] or 0: r for r in scored.collect()}
    for k, row in enumerate(expected(EDGES, libraries)):
        r = found[k]
        digest = hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""
        assert (*(r[c] for c in COLUMNS[:-1]), digest) == row and r["pair"] == "kept"
    assert found[6]["n_a"] == 0 and found[5]["n_groups"] > 0


def test_empty_table_and_taken_names(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.with_pair_counts(alignment.align(empty, A, B), 10).count() == 0
    with pytest.raises(ValueError, match="groups"):
        alignment.align(spark.createDataFrame([], "doc_id bigint, text string, groups string"), A, B)


def test_pointer_jumping_finds_the_groups_of_random_tilings():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        ends = [np.r_[np.sort(rng.choice(np.arange(1, size), rng.integers(0, size), replace=False)), size] for _ in range(2)]
        starts = [np.r_[0, e[:-1]] for e in ends]
        common = sorted(set(ends[0]) & set(ends[1]))
        label = [np.searchsorted(common, e, "left") for e in ends]
        at_a, at_b = alignment.terminals(starts[0], ends[0], starts[1], ends[1])
        assert [common.index(ends[1][t]) for t in at_a] == label[0].tolist()
        assert [common.index(ends[1][t]) for t in at_b] == label[1].tolist()
