"""Exact search against all inner products."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewarden.llm import oracles, pivot_search, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id bigint, embedding array<double>, row string, cell int"


def plain(rows, every, k=10):
    """All inner products, sorted."""
    known = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(known):
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for b2, (j, v) in enumerate(known) if b2 != at)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def found_in(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
def test_query_on_the_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    df = queries.QUERIES["op12_pivot_search"](spark, SF_DIR)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert found_in(df) == sorted(con.execute(oracles.PIVOT_SEARCH).fetchall())


@pytest.mark.parametrize(("block", "pivots"), [(8, 3), (4096, 16)])
def test_clusters_copies_and_ties(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(pivot_search, "BLOCK", block)
    monkeypatch.setattr(pivot_search, "PIVOTS", pivots)
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 3, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.2, 6)).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, -1.0, 0.5]) for i in range(120)]  # one vector many times
    rows += [rows[0], rows[3], (7, [9.0] * 6)]  # repeated rows, and a repeated id
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    assert found_in(pivot_search.top_k(df, F.col("vec_id") % 10 == 0, 5)) == plain(rows, 10, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (None, [5.0, 5.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []), (6, [3.0]), (-100, [-1.0, -1.0])]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert found_in(pivot_search.top_k(df, F.col("vec_id") % 100 == 0)) == plain(rows, 100)
    big = [(0, [1e9, 1e9]), (1, [1e9, -3.0]), (2, [1e300, 1.0]), (3, [2.0, 1.0])]
    found = found_in(pivot_search.top_k(spark.createDataFrame([(*r, None, None) for r in big], SCHEMA), F.col("vec_id") == 0))
    whole = [[int(np.floor(1024 * x)) for x in v] for _, v in big]
    exact = {j: min((1 << 63) - 1, sum(a * b for a, b in zip(whole[0], whole[j], strict=True))) for j in (1, 2, 3)}
    assert [(j, s) for *_, j, s in found] == sorted(exact.items(), key=lambda x: (-x[1], x[0]))
    for few in ([], [(0, [1.0])], [(0, None)]):
        df = spark.createDataFrame([(*r, None, None) for r in few], SCHEMA)
        assert pivot_search.top_k(df, F.col("vec_id") % 100 == 0).collect() == []


def test_bounds_hold_and_stop_the_search():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 2000, (20, 16))
    x = np.floor(np.repeat(centres, 100, 0) + rng.normal(0, 100, (2000, 16)))
    pivots = pivot_search.choose_pivots(x)
    far = pivot_search.distances(x, pivots)
    bounds = pivot_search.upper_bounds(x[:50], far[:50], (x * x).sum(1), far)
    exact = x[:50] @ x.T
    assert (bounds >= exact).all()
    evaluated = 0
    for j in range(50):
        places, found, n = pivot_search.best_of_block(x[j], bounds[j], x, np.arange(2000), None, 10)
        assert found.tolist() == np.sort(exact[j])[::-1][:10].tolist() and len(places) == 10
        evaluated += n
    assert evaluated < 0.5 * 50 * 2000
