"""Chunked operations against the plain forms, quantiles against numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewarden.functions import chunks
from candlewarden.functions.quantiles import BUCKET, exact_quantiles
from candlewarden.functions.session import job_folder, materialise, release, working_dir
from candlewarden.functions.times import EPOCH, floor_to, micros_between, order_key
from candlewarden.operators import parse, sketches
from candlewarden.schema import SERIES


@pytest.fixture(scope="module")
def sparse(spark):
    """Three series over several years with many empty months and a few crowded ones."""
    rng = np.random.default_rng(5)
    frames = []
    for symbol in "ABC":
        hours = np.unique(np.concatenate([rng.integers(0, 30_000, 150), np.arange(9_000, 9_050)]))
        frames.append(
            pd.DataFrame(
                {
                    "symbol": symbol,
                    "timeframe": "H1",
                    "ts": (pd.Timestamp("2020-01-01") + pd.to_timedelta(hours, unit="h")).astype("datetime64[us]"),
                    "x": rng.normal(100, 5, len(hours)),
                }
            )
        )
    pdf = pd.concat(frames, ignore_index=True)
    pdf["line_no"] = pdf.groupby("symbol").cumcount() * 37_000 + 2
    return spark.createDataFrame(pdf, "symbol string, timeframe string, ts timestamp_ntz, x double, line_no bigint")


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("order", ["ts", "line_no"])
def test_previous_row(sparse, order):
    w = Window.partitionBy(*SERIES).orderBy(order)
    plain = sparse.select("*", F.lag("ts").over(w).alias("p"), F.lag("x").over(w).alias("q"))
    got = chunks.with_previous(sparse, SERIES, order, {"p": "ts", "q": "x"})
    same(got, plain)
    tops = sparse.groupBy(*SERIES).agg(F.max("x").alias("top"))
    given = chunks.with_previous(sparse, SERIES, order, {"p": "ts", "q": "x"}, tops)
    same(given, plain.join(tops, SERIES).select(*given.columns))


@pytest.mark.parametrize(("before", "after"), [(4, 0), (0, 3), (2, 2)])
def test_halo_frames(sparse, before, after):
    w = Window.partitionBy(*SERIES).orderBy("ts").rowsBetween(-before, after)
    plain = sparse.select(*SERIES, "ts", F.avg("x").over(w).alias("v"))
    rows = chunks.with_halo(sparse, SERIES, "ts", before, after)
    inside = chunks.halo_window(SERIES, "ts").rowsBetween(-before, after)
    got = rows.withColumn("v", F.avg("x").over(inside)).where(~F.col(chunks.HALO)).select(*SERIES, "ts", "v")
    same(got, plain)


def test_running_totals_and_positions(sparse):
    w = Window.partitionBy(*SERIES).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    plain = sparse.select(*SERIES, "ts", F.sum("x").over(w).alias("s"), F.count("x").over(w).alias("n"))
    got = chunks.with_running(sparse, SERIES, "ts", "x", "total", "seen")
    joined = got.join(plain, [*SERIES, "ts"])
    assert joined.where("abs(total - s) > 1e-9 OR seen <> n").count() == 0
    placed = chunks.with_position(sparse, SERIES, "ts", "pos").join(plain, [*SERIES, "ts"])
    assert placed.where("pos <> n").count() == 0


def test_series_values_reach_every_row(sparse):
    values = sparse.groupBy(*SERIES).agg(F.max("x").alias("top"))
    joined = chunks.join_series_values(sparse, values, SERIES, "ts")
    same(joined, sparse.join(values, SERIES).select(*joined.columns))
    listed = values.where("symbol <> 'B'")
    same(chunks.of_series(sparse, listed, SERIES, "ts"), sparse.where("symbol <> 'B'"))


numbers = st.one_of(
    st.floats(-1e6, 1e6), st.floats(allow_nan=False, allow_infinity=False), st.integers(-3, 3).map(float)
)


@settings(max_examples=6, deadline=None)
@given(st.lists(numbers, min_size=1, max_size=80))
def test_quantiles_are_exact(spark, values):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "k string, v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["k"], {"v": "v"}, {"v": probs}).collect()}
    ordered = sorted(values)
    for p in probs:
        at = p * (len(values) - 1)
        lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        expected = lo if lo == hi or at == np.floor(at) else lo + (hi - lo) * (at - np.floor(at))
        assert got[p] == expected or np.isclose(got[p], expected, rtol=1e-12, atol=0)


def test_value_buckets_keep_the_order(spark):
    values = [-np.inf, -1e308, -5.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.01, 7.5, 1e300, np.inf]
    rows = spark.createDataFrame([(v,) for v in values], "value double").selectExpr("value", f"{BUCKET} AS b").collect()
    by_value = [r["b"] for r in sorted(rows, key=lambda r: r["value"])]
    assert by_value == sorted(by_value)
    assert by_value[values.index(0.0) - 1] < 0 < by_value[values.index(0.0) + 1]


def test_one_value_holding_most_rows(spark):
    df = spark.range(10_000).selectExpr("'k' AS k", "CASE WHEN id % 3 = 0 THEN 7D ELSE double(id) END AS v")
    got = exact_quantiles(df, ["k"], {"v": "v"}, {"v": [0.1, 0.5]}).orderBy("prob").collect()
    expected = df.toPandas()["v"].quantile([0.1, 0.5]).tolist()
    assert [r["value"] for r in got] == pytest.approx(expected, abs=1e-9)


def test_time_helpers_ignore_the_session_zone(spark):
    # 02:30 on this day does not exist in the session zone of the tests
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:37:00.25' AS b, TIMESTAMP_NTZ'2024-03-10 01:00:00' AS a")
    row = df.select(
        micros_between("a", "b").alias("us"),
        floor_to("b", 15).alias("f"),
        order_key("b", "5").alias("k"),
        micros_between(EPOCH, "b").alias("e"),
    ).first()
    assert row["us"] == (97 * 60 * 1_000_000) + 250_000
    assert row["f"] == pd.Timestamp("2024-03-10 02:30:00")
    assert int(row["k"]) == row["e"] * 2 * 10**19 + 5


dates = st.tuples(st.integers(1600, 2300), st.integers(0, 14), st.integers(0, 33), st.integers(0, 25), st.integers(0, 61), st.integers(0, 61), st.booleans())


@settings(max_examples=5, deadline=None)
@given(st.lists(dates, min_size=60, max_size=200))
def test_timestamps_parse_like_pandas(spark, parts):
    rows = []
    for i, (y, mo, d, h, mi, s, padded) in enumerate(parts):
        date = f"{y}.{mo:02d}.{d:02d}" if padded else f"{y}.{mo}.{d}"
        time = f"{h:02d}:{mi:02d}:{s:02d}" if padded else f"{h}:{mi}:{s}"
        rows.append((i, date, time))
    rows += [(-1, None, "01:00:00"), (-2, "2024.01.01", None), (-3, "2024.01.01", "01:00:00 "), (-4, "2024-01-01", "01:00:00"), (-5, "2024.01. 5", "1:2:3")]
    pdf = pd.DataFrame(rows, columns=["i", "date", "time"])
    expected = pd.to_datetime(pdf["date"].fillna("") + " " + pdf["time"].fillna(""), format="%Y.%m.%d %H:%M:%S", errors="coerce")
    df = spark.createDataFrame(rows, "i int, date string, time string")
    got = {r["i"]: r["ts"] for r in parse.with_ts(df).collect()}
    for i, ts in zip(pdf["i"], expected):
        assert (got[i] is None) == pd.isna(ts) and (pd.isna(ts) or got[i] == ts)


def exists(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def test_a_job_deletes_its_own_tables_only(spark):
    outside = materialise(spark.range(10).toDF("id"), "outside")
    with pytest.raises(KeyError), job_folder(spark) as own:
        assert materialise(spark.range(3).toDF("id"), "inside").count() == 3 and exists(spark, own)
        raise KeyError
    assert not exists(spark, own) and outside.count() == 10
    release(spark)
    assert not exists(spark, working_dir(spark))


def test_counts_beyond_the_integers_are_marked(spark):
    texts = ["inf", "1e300", "9223372036854775808", "1.5", "1e5", "9223372036854775807", "-3.0", "x", ""]
    rows = [("f", i, f"2024.01.01\t01:00:00\t1\t2\t0\t1\t{t}\t0\t1") for i, t in enumerate(texts, 2)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, value string")
    got = [(r["tick_volume"], r["fractional_count"]) for r in parse.typed_rows(df).orderBy("line_no").collect()]
    whole = [(100000, False), (9223372036854775807, False), (-3, False), (None, False), (None, False)]
    assert got == [(None, True)] * 4 + whole


def test_sketches_merge_and_keep_their_error(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(3, 2, 5000), -rng.lognormal(1, 1, 500), [0.0] * 40, [np.nan, np.inf]])
    rows = pd.DataFrame({"symbol": "X", "timeframe": "H1", "x": values, "part": rng.integers(0, 3, len(values))})
    df = spark.createDataFrame(rows)
    whole = sketches.sketch(df, {"x": "x"})
    parts = sketches.merge([sketches.sketch(df.where(f"part = {k}"), {"x": "x"}) for k in range(3)])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    probs = [0.0, 0.01, 0.09, 0.5, 0.9, 0.999, 1.0]
    known = np.sort(values[np.isfinite(values)])
    for r in sketches.quantiles(parts, probs).collect():
        exact = known[max(1, int(np.ceil(r["prob"] * len(known)))) - 1]
        assert r["n"] == len(known)
        assert abs(r["estimate"]) - 1e-6 <= abs(exact) <= abs(r["farthest"]) + 1e-6
        assert abs(exact - r["estimate"]) <= sketches.error() * abs(r["estimate"]) + 2e-6


def test_a_key_with_nine_tenths_of_the_rows_is_split(spark, monkeypatch):
    """Values are looked up alike on every way, and no task gets the rows of the hot key."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(20000).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' WHEN id % 100 = 99 THEN NULL ELSE string(id) END AS symbol", "'H1' AS timeframe", "id AS ts")
        values = rows.where("symbol IS NOT NULL").select("symbol", "timeframe").distinct().withColumn("v", F.length("symbol"))
        expected = sorted((r["ts"], r["v"]) for r in rows.join(F.broadcast(values), ["symbol", "timeframe"], "left").collect())
        assert sorted((r["ts"], r["v"]) for r in chunks.join_series_values(rows, values, ["symbol", "timeframe"], "ts").collect()) == expected
        monkeypatch.setattr(chunks, "SMALL", 10)
        marks = chunks.hot_salts(rows, ["symbol", "timeframe"]).collect()
        assert [(r["symbol"], r["_salts"]) for r in marks] == [("hot", 182)]
        joined = chunks.join_series_values(rows, values, ["symbol", "timeframe"], "ts")
        assert sorted((r["ts"], r["v"]) for r in joined.collect()) == expected
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.25 * 20000
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
