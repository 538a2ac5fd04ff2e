"""The trie of rebuilt conversations against nested dictionaries."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from candlewarden.llm import prefix_trie, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, k1 int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, ())
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1].encode() if node else b"") + sum(saved[k] for k in kids)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(kids), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found_in(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
def test_query_on_the_whole_table(spark):
    rows = pd.read_parquet(f"{SF_DIR}/conversations.parquet")[["conv_id", "turn", "role", "text"]].itertuples(index=False)
    df = queries.QUERIES["op13_prefix_trie"](spark, SF_DIR)
    assert df.columns == COLUMNS and {t for c, t in df.dtypes if c != "ends_sha256"} == {"bigint"}
    assert found_in(df) == plain([tuple(r) for r in rows])


def random_rows(seed):
    """Few distinct turns, so that prefixes are shared; one conversation with a third of the rows; all odd cases."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-12, 60), 45, replace=False).tolist():
        n = int(rng.integers(1, 12))
        rows += [(c, t, ["user", "bot", None][rng.integers(3)], ["hi", "ho", "ä" * 3, "", None][rng.integers(5)]) for t in range(n)]
    rows += [(20, t, "user", f"turn {t % 3}") for t in range(150)]
    rows += [(25, t, "user", f"turn {t % 3}") for t in range(90)]
    rows += [(3, None, "user", "no number"), (3, None, "bot", "no number"), (4, 1, "user", "twice"), (4, 1, "user", "twice"), (None, 1, "user", "x")]
    return rows


@pytest.mark.parametrize(("seed", "band", "bucket"), [(1, 16, 4096), (2, 2, 4), (3, 4, 4096)])
def test_shared_prefixes_and_long_conversations(spark, monkeypatch, seed, band, bucket):
    monkeypatch.setattr(prefix_trie, "BUCKET", bucket)
    monkeypatch.setattr(prefix_trie.subtree_totals, "__defaults__", (band,))
    rows = random_rows(seed)
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(5)
    assert found_in(prefix_trie.prefix_trie(df)) == plain(rows)


def test_hot_keys_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT", 3)
    rows = random_rows(4)
    assert found_in(prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA))) == plain(rows)


def test_turnless_and_empty(spark):
    lone = [(7, 0, "user", "only turn")]  # its family's head is absent and it has fewer turns than it leaves out
    assert zlib.crc32(b"7") % 9 > 0
    assert found_in(prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", 7) for r in lone], SCHEMA))) == plain(lone)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
