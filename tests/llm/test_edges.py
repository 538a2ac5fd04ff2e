"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; parts of the operators."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewarden.llm import (
    html_text,
    mixing,
    near_copies,
    packing,
    quality_nbsvm,
    quality_rules,
    simhash,
    syncmers,
    tokens,
    toxicity_cnn,
    warc_index,
)
from candlewarden.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, size int, word string"
LONG = "one two three four five six seven " * 30_000
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with every trouble at once; the last three columns have names that operators might use."""
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, "   \n\t", "en", None, 6),
        (None, "some words of a text", "en", "b", 20),
        (4, LONG, "en", "b", len(LONG)),
        (5, "same text " * 40, "de", "c", 400),
        (5, "same text " * 40, "de", "c", 400),
        (6, "same text " * 40, "de", "c", 400),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, None, None), (None, 1, 1), (4, 1, 0), (5, 0, 1), (5, 1, 0), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_simhash_edges(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 9 and simhash.near_duplicates(none).count() == 0
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in rows}
    assert by[(1, 0)] == by[(2, 0)] == by[(3, 0)] == by[(None, 0)] == 1
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    kept = near_copies.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "None"]
    assert near_copies.keep_one(none).count() == 0


def families(rng, size):
    """Dense families of codes and strangers."""
    codes = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(size):
            codes.add(centre ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randrange(4))}))
    return sorted(codes | {rng.getrandbits(64) for _ in range(size)})


def plain_labels(codes):
    label = np.arange(len(codes))
    array = np.array(codes, np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 2
    while True:
        new = np.where(near, label[None, :], len(codes)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("most", [8, 4096])
def test_gray_index_with_hot_keys(spark, monkeypatch, most):
    """A small bound makes whole families hot, so their keys are dealt again."""
    monkeypatch.setattr(simhash, "MOST", most)
    codes = families(random.Random(5), 90)
    frame = spark.createDataFrame([(k, simhash._signed(c)) for k, c in enumerate(codes)], "doc_id bigint, fp bigint")
    found = {r["fp"]: r["component_id"] for r in simhash.groups(frame).collect()}
    assert [found[simhash._signed(c)] for c in codes] == plain_labels(codes)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201)]
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert {found[i] for i in range(41)} == {0} and {found[k] for k in range(100, 160)} == {100} and found[201] == 200
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_token_edges(odd, none):
    rows = tokens.count_tokens(odd, PIECES).collect()
    assert [r["n_tokens"] for r in rows if r["text"] in (None, "")] == [0, 0, 0]
    assert [r["over_limit"] for r in rows if r["text"] == LONG] == [True]
    assert tokens.count_tokens(none, PIECES).count() == 0
    counter = tokens.PieceCounter(PIECES)
    texts = ["", " ", "  a", "a\n b", "▁x ▁ y", "\x00", "a\x00b", "</s> <s>", "é ё 😀 😀\n😀", "x\r\n\n \n y", "　全角 ", "  \n  "]
    assert [counter.count(t) for t in texts] == [len(x) for x in counter.model.encode(texts)]


def test_packing_edges(odd, none):
    rows = packing.pack(odd, WORDS).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2, 3)) == 3
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == rows[[r["doc_id"] for r in rows].index(4)]["doc_tokens"]
    assert packing.pack(none, WORDS).count() == 0
    words = packing.WordIds(WORDS)
    texts = ["A b", "a\x1cb", "x\x85y", "ΑΣ Σ", "İstanbul İ", "<|endoftext|> a<|endoftext|>b", "e ́x ,́", "don't 'S 's 5th ½", "ﬀ Ǆ ǅ ß"]
    for text in texts:
        assert np.frombuffer(words.of(text.encode()), "<u4").tolist() == words._encode(text), text


@pytest.mark.parametrize("seed", range(4))
def test_closest_sum_is_the_best_one(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 60): rng.randrange(1, 4) for _ in range(rng.randrange(1, 7))}
    capacity = rng.randrange(1, 150)
    used, total = packing.closest(sorted(counts), counts.get, capacity)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    assert total == max(s for s in sums if s <= capacity) == sum(k * n for k, n in used.items())
    assert all(n <= counts[k] for k, n in used.items())


def test_sequences_need_no_padding():
    rng = random.Random(1)
    docs = [(k, bytes(4 * rng.choice([1, 7, rng.randrange(1, 400)]))) for k in range(3000)]
    out = list(packing.sequences(iter(docs), 256, 50))
    sizes = [sum(len(p[2]) // 4 for p in s) for s in out]
    assert sum(sizes) == sum(len(x) // 4 for _, x in docs)
    assert all(s == 256 or s & (s - 1) == 0 for s in sizes) and sum(s != 256 for s in sizes) <= 8


PAGE = (
    "<html><head><title>t</title><script>var a='<p>x</p>'</script></head><body><header>Top</header><nav><a>Menu</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><article><header><h1>He&amp;ad</h1></header><p>One <b>bo</b>ld<br>line"
    "<p>Two &lt;b&gt;<div class=ad>Buy</div><form>Mail <input></form><section id='comments'><p>Nice!</section></article>"
    "<aside>Side</aside><footer>Foot</footer><!-- c > --></body></html>"
)


def test_html_blocks_and_edges(spark):
    shared = "<div>Subscribe for more of the same every day of the week</div>"
    bare = [f"<body>{shared}<div>{k} only tells this story in full &nbsp; here</div></body>" for k in range(2)]
    rows = [(1, "http://A.example/x", PAGE), (2, None, None), (3, "http://b.example/1", bare[0]), (4, "http://b.example/2", bare[1]), (4, "odd", "<p")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, host string")
    found = sorted((r["page_id"], r["text"]) for r in html_text.main_text(pages).collect())
    assert found == [
        (1, "He&ad One bold line Two <b>"),
        (2, ""),
        (3, "0 only tells this story in full here"),
        (4, ""),
        (4, "1 only tells this story in full here"),
    ]
    assert html_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeated_runs_against_brute_force(seed):
    rng = random.Random(seed)
    shared = [[rng.randrange(30) for _ in range(rng.randrange(4, 9))] for _ in range(3)]
    pages = []
    for _ in range(12):
        page = [rng.randrange(400) for _ in range(rng.randrange(0, 12))]
        for s in rng.sample(shared, rng.randrange(3)):
            page += s + [rng.randrange(400) for _ in range(rng.randrange(3))]
        pages.append(page)
    found = html_text.repeated(pages, 5)
    runs = [{tuple(p[i : i + 5]) for i in range(len(p) - 4)} for p in pages]
    for k, page in enumerate(pages):
        others = set().union(*(r for j, r in enumerate(runs) if j != k))
        expected = np.zeros(len(page), bool)
        for i in range(len(page) - 4):
            if tuple(page[i : i + 5]) in others:
                expected[i : i + 5] = True
        assert found[k].tolist() == expected.tolist()


def texts_of(spark, html):
    rows = [(k, f"http://h.example/{k}", h) for k, h in enumerate(html)]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    return [r["text"] for r in found.orderBy("page_id").collect()]


def test_text_inside_articles_stays(spark):
    """Sentences of articles that other pages have in footers and asides, or in the same place of their articles."""
    notice = "please read our terms before you write to the editors of this paper"
    passage = "a passage that two articles of this host share is part of both of them"
    heading = "eight or more words that also stand in every list of links"

    def page(body, around=""):
        return f"<body><aside>{around}</aside><article>{body}</article><footer>(c) host - {around}</footer></body>"

    html = [page(f"<h1>{heading}</h1><p>story {k}</p><p>{passage}</p><p>{notice}</p>", heading) for k in range(4)]
    html += [page(f"<p>short story {k}</p>", f"{notice} {passage}") for k in range(3)]
    kept = [f"{heading} story {k} {passage} {notice}" for k in range(4)] + [f"short story {k}" for k in range(3)]
    assert texts_of(spark, html) == kept


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_split_host_gives_what_one_group_gives(spark, monkeypatch):
    """Notices that two pages of a host share, and passages inside articles that frame others, with many tiny groups."""
    rng = random.Random(3)

    def own(n):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))

    rows = []
    for k in range(60):
        notice = f"notice {k // 2} that just two pages of this large host have in common"
        frame = f"frame {k // 6} that stands around the articles of some pages and inside one"
        body = f"<article><p>{own(9)}</p><p>{frame if k % 6 == 0 else own(8)}</p></article>" if k % 3 == 0 else f"<p>{own(12)}</p>"
        rows.append((k, f"http://big.example/{k}", f"<body><div>{notice}</div>{body}<div>{frame}</div></body>"))
    rows += [(100 + k, f"http://small.example/{k}", f"<body><p>{own(10)}</p></body>") for k in range(3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole = _rows(html_text.main_text(pages))
    monkeypatch.setattr(html_text, "GROUP", 60)
    split = _rows(html_text.main_text(pages))
    assert split == whole
    assert not any("notice" in r[2] for r in whole) and any(r[4] for r in whole)


@pytest.mark.parametrize("group", [html_text.GROUP, 20])
def test_copies_are_one_page(spark, monkeypatch, group):
    monkeypatch.setattr(html_text, "GROUP", group)
    story = "a story of more than eight words that is told on one page of this host"
    notice = "a notice of eight words or more that every page of this host has"
    page = f"<body><p>{story}</p><p>{notice}</p></body>"
    other = f"<body><p>another page that tells something else in its own nine words</p><p>{notice}</p></body>"
    rows = [(k, f"http://c.example/1?from={k}", page) for k in range(5)] + [(0, "http://c.example/1?from=0", page), (9, "http://c.example/2", other)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = _rows(html_text.main_text(pages).select("page_id", "url", "text"))
    other_text = "another page that tells something else in its own nine words"
    assert found == sorted([(i, u, story) for i, u, _ in rows[:6]] + [(9, "http://c.example/2", other_text)])


def test_a_body_around_cards_stays(spark):
    body = [" ".join(f"word{k}x{i}" for i in range(20)) for k in range(3)]  # the menu repeats, the bodies do not
    menu = "home news sport weather contact imprint and all the other pages here"
    comment = '<article class="comment">a comment of very many words that says nothing that is of any use to a reader of it</article>'
    pages = [
        f"<body><div>{menu}</div><div>{body[0]}</div><article>see also this</article></body>",  # a card that outweighs nothing
        f"<body><div>{menu}</div><div>{body[1]}</div>{comment}{comment}</body>",
        f"<body><div>{menu}</div><article class='post category-social-media'>{body[2]}</article>{comment}<div>just a few words</div></body>",
    ]
    assert texts_of(spark, pages) == [f"{body[0]} see also this", body[1], body[2]]


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_suffix_order_to_a_depth(depth):
    codes = np.random.default_rng(depth).integers(0, 3, 200)
    order = html_text.suffix_array(codes, depth)
    assert sorted(order.tolist()) == list(range(200))
    heads = [codes[i : i + depth].tolist() for i in order]
    assert heads == sorted(heads)


def test_word_ids_are_the_tokenizers():
    """Odd capitals, combining marks, the signs of added tokens and random runs, against the whole tokenizer."""
    ids = packing.WordIds(WORDS)
    rng = random.Random(5)
    signs = [chr(c) for c in range(33, 0x250) if not chr(c).isspace()] + ["\u0308", "\u0307", "\u0331", "\u212a", "\u1e9e"] * 8
    texts = ["T\u0308 J\u030c H\u0331 I\u0307 \u0130 \u212a", "<|ENDOFTEXT|> <|endoftext|> a", "ABC abc Abc's X<|Y", "", " \n"]
    for _ in range(1000):
        texts.append(" ".join("".join(rng.choice(signs[: rng.choice((94, len(signs)))]) for _ in range(rng.randrange(1, 9))) for _ in range(20)))
    for text in texts:
        assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_suffix_order():
    codes = np.array([3, 1, 3, 1, 3, 0, 1])
    order = html_text.suffix_array(codes).tolist()
    assert order == sorted(range(7), key=lambda i: codes[i:].tolist())


def test_quality_rule_edges(odd, none, labels):
    rows = quality_rules.judge(odd, labels).collect()
    assert {r["doc_id"]: r["base_failed"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5)} == dict.fromkeys((1, 2, 3, 4, 5), True)
    long = next(r for r in rows if r["doc_id"] == 4)
    assert (long["n_words"], long["n_repeat_words"]) == (210_000, 210_000)
    assert quality_rules.judge(none, labels).count() == 0
    assert quality_rules.judge(odd, labels.limit(0)).where("kept").count() == 0


def test_binomial_bound(spark):
    from math import comb

    for n in (10, 300, 900):
        level, risk = 0.01, 0.01
        allowed = spark.range(1).select(quality_rules.most_rejected(f"{n}L", f"{level}D", risk).alias("x")).first()["x"]
        total, x = 0.0, -1
        for j in range(n + 1):
            total += comb(n, j) * risk**j * (1 - risk) ** (n - j)
            if total > level:
                break
            x = j
        assert allowed == x


def test_cutoffs_reject_what_labels_allow(spark):
    good = [(k, " ".join(f"w{k}x{i}" for i in range(60)), "en") for k in range(2500)]
    bad = [(9000 + k, " ".join(f"w{k}y{i}###" for i in range(60)), "en") for k in range(50)]
    docs = spark.createDataFrame(good + bad + [(9999, " ".join(f"z{i}***" for i in range(60)), "fr")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(2500)], "doc_id bigint, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge_counts(docs, labels).collect()}
    assert all(kept[k] for k in range(2500)) and not any(kept[9000 + k] for k in range(50))
    assert kept[9999]  # no labels in its language, no cutoff


def test_mixing_edges(odd, none):
    rows = mixing.mix_counts(odd).collect()
    assert len(rows) == 9 and mixing.mix_counts(none).count() == 0
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in rows)
    total = {r["source_size"]: r["target"] for r in rows}
    assert sum(total.values()) <= sum(total) + 1e-6
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixing.mix(none).count() == 0
    assert sorted(map(repr, mixing.mix_counts(odd).collect())) == sorted(map(repr, rows))


def test_words_are_counted_without_a_list_of_them(spark, capsys):
    rng = random.Random(4)
    signs = " \t\n\v\f\r" + "ab$w\x00\x1c\x85\xa0\u2028é\U0001f600"
    texts = [None, "", " ", "\n\r", "w", " w", "w ", "w w\n", "$1 \\", "x " * 50_000 + " " * 50_000, " " * 50_000 + "x"]
    texts += ["".join(rng.choices(signs, k=rng.randrange(1, 30))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = rows.select("doc_id", mixing.n_words(F.col("text")).alias("n"))
    assert {r["doc_id"]: r["n"] for r in found.collect()} == {k: len((t or "").encode().split()) for k, t in enumerate(texts)}
    found.explain()  # regexp_count would make an array of all words of a text
    assert "regexp_extract_all" not in capsys.readouterr().out


def test_mixture_comes_near_its_targets(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 200)), f"s{min(rng.randrange(9), 4)}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix_counts(docs).toPandas()
    for _, own in found.groupby("source_size"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 100
    mixed = mixing.mix(docs).toPandas()
    assert mixed.text.str.split().str.len().sum() == found.taken.sum()


def test_long_documents_have_better_odds(spark):
    """The sample is not the documents of the smallest random numbers: odds grow with length, and rank decides."""
    rng = random.Random(8)
    rows = [(k, " ".join(["w"] * (4 if k % 2 else 300)), f"s{k % 3}") for k in range(6000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    sized = sized.withColumn("u", mixing.uniform(F.col("doc_id"), F.col("size")))
    found = mixing.mix_counts(docs).join(sized.select("doc_id", "source", "u"), "doc_id").toPandas()
    found["extra"] = found.taken // found["size"] - found.groupby("source").taken.transform("min") // found["size"]
    for _, own in found.groupby("source"):
        least = (own.taken // own["size"]).min()
        added = own.taken // own["size"] - least
        if not 0 < added.sum() < len(own):
            continue
        share = added.groupby(own["size"]).mean()
        # three bits against nine: the odds of long documents are about three times as good
        assert 1.5 * share[4] < share[300]
        assert own.u[added == 0].min() < own.u[added == 1].max()
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 150


def test_cells_are_cut_until_they_are_small(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k % 700, " ".join(["w"] * rng.randrange(0, 90)), [None, "a", "b"][k % 3]) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    whole = sorted(map(repr, mixing.mix_counts(docs).collect()))
    monkeypatch.setattr(mixing, "ORDERED", 0)
    assert sorted(map(repr, mixing.mix_counts(docs).collect())) == whole


def test_columns_of_any_name_pass_through_the_mix(spark):
    names = ["doc_id", "text", "source", "_size", "_source", "u", "size", "row", "_taken", "rank"]
    docs = spark.createDataFrame([(k, f"{k} words of text", "s", *range(7)) for k in range(40)], "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` int" for c in names[3:]))
    mixed = mixing.mix(docs)
    assert mixed.columns == names and all(r[3:] == (0, 1, 2, 3, 4, 5, 6) for r in map(tuple, mixed.collect()))


def test_names_that_are_taken_are_refused(spark, labels):
    """Operators that add columns never write over one of the input."""

    def with_column(name):
        return spark.createDataFrame([(1, "some text", "en", 0)], f"doc_id bigint, text string, lang string, `{name}` int")

    for name in ("n_bytes", "n_tokens", "over_limit"):
        with pytest.raises(ValueError, match=name):
            tokens.count_tokens(with_column(name), public_tokenizers.path("piece_bpe_32k.model"))
    for name in ("kept", "n_words", "base_failed"):
        with pytest.raises(ValueError, match=name):
            quality_rules.judge(with_column(name), labels)
    model = quality_nbsvm.train(with_column("x"), labels)
    for name in ("score", "predicted"):
        with pytest.raises(ValueError, match=name):
            quality_nbsvm.score(with_column(name), model)
    with pytest.raises(ValueError, match="_cw_content"):
        near_copies.keep_one(with_column("_cw_content"))


def test_archives_of_any_payload_are_read_by_record(spark, tmp_path):
    """Payloads that look like the border of records, and files of several records, compressed or not."""
    border = "\r\n\r\nWARC/1.1\r\n"
    payloads = ["", "plain", border, f"a{border}WARC-Type: response\r\n{border}", "\r\n\r\n", "ä" * 50 + border, "plain", None]
    pages = spark.createDataFrame([(k, f"http://h.example/{k}", p) for k, p in enumerate(payloads)], "page_id bigint, url string, html string")
    rows = {r["page_id"]: r for r in warc_index.archive_and_index(pages.coalesce(1), 2, str(tmp_path / "w")).collect()}
    assert {k: r["payload_bytes"] for k, r in rows.items()} == {k: len((p or "").encode()) for k, p in enumerate(payloads)}
    assert {k: r["refers_to"] for k, r in rows.items() if r["record_type"] == "revisit"} == {0: 7, 1: 6}
    import gzip

    (path,) = (tmp_path / "w").glob("*.gz")
    data = gzip.decompress(path.read_bytes())
    assert data.count(b"WARC-Profile: ") == 2
    assert all(data[r["place"] :].startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode()) for r in rows.values())


def test_classifier_edges(odd, none, labels):
    for module in (quality_nbsvm, toxicity_cnn):
        model = module.train(odd, labels)
        scores = [r["score"] for r in module.score(odd, model).collect()]
        assert len(scores) == 9 and all(0 <= s <= 1 for s in scores)
        empty = module.train(none, labels.limit(0))
        assert module.score(none, empty).count() == 0 and module.score(odd, empty).count() == 9


def test_convolution_tables_equal_direct_products():
    rng = np.random.default_rng(2)
    codes = [rng.integers(0, 50, n).astype(np.int32) for n in (0, 1, 2, 40, 300)]
    model = toxicity_cnn.fit([(c, int(k % 2), "en") for k, c in enumerate(codes)])
    model["words"] = model["words"].astype(np.float32)
    for c in codes:
        rows = toxicity_cnn._padded(toxicity_cnn.embedding_rows(model["known"], c))
        n, seen = len(rows) - 2, model["words"][rows]
        direct = np.concatenate([sum(seen[j : j + n] @ k[j] for j in range(len(k))).max(axis=0) for k in model["kernels"]])
        expected = np.maximum(direct + model["shift"], 0) @ model["out"] + model["bias"]
        assert toxicity_cnn.margin(model, toxicity_cnn._tables(model), c) == pytest.approx(expected, abs=1e-4)


def test_warc_edges(spark, tmp_path):
    rows = [(1, "http://a.example/", None), (2, None, ""), (3, "http://B.example:80/x?y#z", "a\r\n\r\nWARC/1.1\r\n\r\nb é"), (3, "x", "dup"), (9, "y", "dup"), (9, "y", "dup"), (None, "n", "null id")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, sha1 string")
    found = sorted(
        (r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc_index.archive_and_index(pages, 4, str(tmp_path / "w")).collect()
    )
    assert [f[:3] for f in found] == [
        (0, 7, "response"), (1, 0, "revisit"), (2, 0, "response"), (3, 3, "revisit"), (3, 21, "response"), (9, 3, "response"), (9, 3, "response")
    ]
    assert [f[3] for f in found] == [None, 2, None, 9, None, None, None]
    assert warc_index.archive_and_index(pages.limit(0), 4, str(tmp_path / "e")).count() == 0


def test_loser_tree_merges():
    rng = random.Random(4)
    for k in (1, 2, 3, 5, 8):
        runs = [sorted((f"u{rng.randrange(5)}", f"{rng.randrange(9)}", i, "", 0, "", "", None, f"a{r}", i) for i in range(rng.randrange(1, 9))) for r in range(k)]
        runs = [sorted(r, key=warc_index.order_key) for r in runs]
        tree = warc_index.LoserTree([(r[0], iter(r[1:])) for r in runs])
        out = []
        while tree.head() is not None:
            out.append(tree.pop())
        assert out == sorted((x for r in runs for x in r), key=warc_index.order_key)


def test_syncmer_edges(odd, none, spark):
    rows = syncmers.fingerprints(odd, 4).collect()
    assert len(rows) == 9 and syncmers.fingerprints(none, 4).count() == 0
    prints = {r["fingerprint"] for r in rows if r["n_chars"] == 400}
    assert len(prints) == 1 and {r["near_next"] for r in rows if r["doc_id"] == 6} == {1.0}
    one = syncmers.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string"), 4).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 7


def test_pipeline_stages_on_a_small_corpus(spark, tmp_path):
    """Each stage against plain Python over what the one before it kept."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80))
    rows = [(k, text(), "en", f"s{k % 3}", 0) for k in range(60)]
    rows += [(100 + k, rows[k][1], "en", "s0", 0) for k in range(10)] + [(200, "too short", "en", "s1", 0), (201, None, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept, sf_dir = docs, str(tmp_path)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, kept, sf_dir)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        seen.append(sorted(r["doc_id"] for r in kept.collect()))
    assert seen[0] == [*range(60), *range(100, 110)]
    assert seen[1] == seen[0]  # all labels are clean
    assert seen[2] == list(range(60))
    counts = {d: seen[3].count(d) for d in range(60)}
    assert all(n <= 3 for n in counts.values())
    words = {s: sum(80 * counts[d] for d in range(60) if d % 3 == s) for s in range(3)}
    total = 60 * 80  # weights 5, 2, 1 of equal sources
    assert all(abs(words[s] - total * w / 8) <= 40 for s, w in enumerate((5, 2, 1)))
    pieces = corpus_pipeline.STAGES[4][1](spark, kept, sf_dir).toPandas()
    assert pieces.groupby("doc_id").length.sum().to_dict() == {
        d: n * int(pieces[pieces.doc_id == d].doc_tokens.iloc[0]) for d, n in counts.items() if n
    }


def test_only_texts_without_words_have_no_anchor(spark):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in range(1, 14) for _ in range(20)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["", " \n", *texts])], "doc_id bigint, text string")
    anchors = [r["anchors"] for r in syncmers.with_anchors(docs, "text", "anchors").orderBy("doc_id").collect()]
    assert anchors[:2] == [[], []] and all(anchors[2:])
    assert len({tuple(a) for a in anchors[2:]}) == len(texts)


def test_an_anchor_depends_on_every_word_of_its_kmer(spark):
    rows = []
    for k in range(30):
        words = [f"w{k}x{j}" for j in range(syncmers.K)]
        rows += [(k, " ".join(words))] + [(k, " ".join([*words[:j], "other", *words[j + 1 :]])) for j in range(syncmers.K)]
    docs = spark.createDataFrame(rows, "k int, text string")
    found = {(r["k"], *r["anchors"]) for r in syncmers.with_anchors(docs, "text", "anchors").collect()}
    assert len(found) == len(rows)
