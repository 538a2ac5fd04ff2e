"""Features against pandas, and the look-ahead test on causal and leaking ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewarden.operators import causality, features
from candlewarden.schema import SERIES


@pytest.fixture(scope="module")
def long_h1():
    """Enough bars to cross several months, some of them nearly empty."""
    rng = np.random.default_rng(3)
    grid = pd.date_range("2024-01-01", periods=24 * 200, freq="1h")
    keep = rng.random(len(grid)) < np.where(grid.month == 3, 0.004, 0.3)
    grid = grid[keep]
    close = (100 + rng.normal(0, 1, len(grid)).cumsum()).round(2)
    frame = pd.DataFrame({"symbol": "X", "timeframe": "H1", "ts": grid.astype("datetime64[us]"), "open": close})
    frame[["high", "low", "close"]] = np.stack([close, close, close], axis=1)
    return frame.assign(tick_volume=1, volume=0, spread=1)


PANDAS = {
    "rolling": (features.rolling_mean(5), lambda s: s.rolling(5).mean()),
    "pct": (features.pct_change(), lambda s: s.pct_change()),
    "ewm": (features.ewm_mean(10), lambda s: s.ewm(span=10, adjust=False).mean()),
    "expanding": (features.expanding_mean(), lambda s: s.expanding().mean()),
    "centred": (features.centred_mean(5), lambda s: s.rolling(5, center=True).mean()),
    "ahead": (features.ahead(1), lambda s: s.shift(-1)),
    "label": (features.future_label(3), lambda s: (s.shift(-3) > s).astype(float)),
    "zscore": (features.zscore(), lambda s: (s - s.mean()) / s.std()),
}


@pytest.mark.parametrize("name", PANDAS)
def test_feature_equals_pandas(to_bars, long_h1, name):
    feature, reference = PANDAS[name]
    got = feature(to_bars(long_h1), SERIES).orderBy("ts").toPandas()["value"].astype(float)
    np.testing.assert_allclose(got, reference(long_h1["close"]), rtol=1e-9, atol=1e-9)


def test_columns_and_backward_features_are_causal(to_bars, h1):
    bars = to_bars(h1)
    for column in ("open", "spread"):
        causality.assert_causal(bars, features.column_value(column))
    for name in ("rolling", "pct"):
        assert causality.is_causal(bars, PANDAS[name][0]), name
    for name in ("ewm", "expanding"):
        assert causality.is_causal(bars, PANDAS[name][0], atol=1e-9), name


LEAKING = {
    "short": features.known_ahead(2),
    **{name: PANDAS[name][0] for name in ("rolling", "pct", "ewm", "expanding", "centred", "ahead", "label")},
}


@pytest.mark.parametrize("name", LEAKING)
def test_short_ways_find_what_whole_prefixes_show(to_bars, long_h1, name):
    """What a feature says of itself saves work only: the verdicts equal those of the plain function."""
    feature, positions = LEAKING[name], [1, 2, 3, 5, 40, 41, 300, len(long_h1) - 1, len(long_h1)]
    bars = to_bars(pd.concat([long_h1, long_h1.head(60).assign(symbol="Y")]))
    short, whole = (
        causality.compare_prefixes(bars, f, positions, atol=1e-9).drop("prefix_value", "full_value").orderBy("symbol", "cut").toPandas()
        for f in (feature, lambda df, keys: feature(df, keys))
    )
    pd.testing.assert_frame_equal(short, whole)


def test_a_state_that_knows_the_future_is_caught(to_bars, h1):
    """A mean that carries a state, but whose trace was made from the next value."""

    def trace(bars, keys):
        return features.ahead(1)(bars, keys).select(*keys, "ts", F.col("value").alias("x"), "value", F.col("value").alias("_mean"))

    honest = features.ewm_mean(10)
    leaking = features.Stepped(trace, honest.states, honest.step)
    found = causality.compare_prefixes(to_bars(h1), leaking, [5, 50]).orderBy("cut").collect()
    assert all(r["differing"] > 0 and r["first_bad_ts"] <= r["cut_ts"] for r in found)


def test_many_cuts_take_few_rows(to_bars, long_h1, monkeypatch):
    bars, sizes = to_bars(long_h1), {}
    real = causality.materialise
    monkeypatch.setattr(causality, "materialise", lambda df, name: (sizes.setdefault(name, []).append(df.count()), real(df, name))[1])
    n = len(long_h1)
    for k in (5, 1000):
        found = causality.compare_prefixes(bars, features.rolling_mean(5), range(n - k, n)).collect()
        assert len(found) == k and all(r["compared"] == r["cut"] and r["differing"] == 0 for r in found)
    assert sizes["slices"] == [5 * 5, 1000 * 5] and sizes["numbered"] == [n, n]


def test_lookahead_is_caught(to_bars, h1):
    bars = to_bars(h1)
    with pytest.raises(AssertionError, match="lookahead"):
        causality.assert_causal(bars, PANDAS["ahead"][0])
    for name in ("centred", "zscore", "label"):
        assert not causality.is_causal(bars, PANDAS[name][0]), name


def test_length_change_and_missing_values(to_bars, h1):
    bars = to_bars(h1)

    def without_last(df, keys):
        last = df.groupBy(*keys).agg(F.max("ts").alias("_end"))
        return features.column_value("close")(df, keys).join(last, keys).where("ts < _end").drop("_end")

    def nothing(df, keys):
        return df.select(*keys, "ts", F.lit(float("nan")).alias("value"))

    with pytest.raises(AssertionError, match="length"):
        causality.assert_causal(bars, without_last)
    assert causality.is_causal(bars, nothing)


def test_cut_positions(to_bars, h1):
    n = len(h1)
    found = causality.cuts_of(to_bars(h1)).orderBy("cut").collect()
    assert [r["cut"] for r in found] == sorted({max(1, k) for k in (n // 7, n // 3, n // 2, 3 * n // 4, n - 1)})
    assert [r["cut_ts"] for r in found] == [h1["ts"].iloc[r["cut"] - 1] for r in found]
    chosen = causality.cuts_of(to_bars(h1), [0, 5, n, n + 1]).orderBy("cut").collect()
    assert [r["cut"] for r in chosen] == [5, n]
    one = causality.cuts_of(to_bars(h1.head(1))).collect()
    assert [r["cut"] for r in one] == [1]


def test_available_at(to_bars, h1, m15):
    rows = features.available_at(to_bars(pd.concat([h1.head(1), m15.head(1)]))).collect()
    assert {r["timeframe"]: (r["available_at"] - r["ts"]).seconds for r in rows} == {"H1": 3600, "M15": 900}
