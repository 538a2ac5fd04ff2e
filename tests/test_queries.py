"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from candlewarden.plans import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: [(v is None, str(v) if isinstance(v, (str, bool)) or v is None else "", v if not isinstance(v, (str, bool)) and v is not None else 0) for v in r])


def test_every_query_has_a_counterpart():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    found = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    types = {d[0]: str(d[1]) for d in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    expected = _sorted(found.fetchall(), columns)
    actual = _sorted([tuple(r) for r in df.collect()], df.columns)
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["cross_tf_compare", "cross_tf_no_overlap"])
def test_all_pairs_are_compared(spark, name):
    found = {r["pair"] for r in contract.queries()[name](spark, SF_DIR).select("pair").distinct().collect()}
    assert found == {"M15->M30", "M30->H1", "M15->H1"}
