"""Indicator hand values and invariants (FIXTURES.md section 2 and 3)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import series_df
from tickwise.operators import indicators as ind
from tickwise.operators.recurrence import Ewm, span_alpha
from tickwise.operators.series import home_only


def _collect(df, col):
    return [r[col] for r in df.orderBy("timestamp").select(col).collect()]


def test_lag_returns_hand_values(spark):
    d = ind.add_lag_returns(ind.layout(series_df(spark, [100, 110, 121]), halo=10), [1, 5])
    out = home_only(d)
    r1 = _collect(out, "return_1d")
    assert r1[0] is None and r1[1] == pytest.approx(0.10) and r1[2] == pytest.approx(0.10)
    assert _collect(out, "return_5d") == [None, None, None]


def test_sma50_of_1_to_100(spark):
    d = ind.add_sma(ind.layout(series_df(spark, range(1, 101)), halo=199), 50, "sma_50")
    v = _collect(home_only(d), "sma_50")
    assert all(x is None for x in v[:49]) and v[49] == pytest.approx(25.5)


def test_bollinger_flat_and_ordered(spark):
    out = home_only(ind.add_bollinger(ind.layout(series_df(spark, [100.0] * 30), halo=19)))
    up, lo = _collect(out, "bollinger_upper"), _collect(out, "bollinger_lower")
    assert up[-1] - lo[-1] < 0.01
    rng = np.random.default_rng(42)
    walk = 100 + np.cumsum(rng.normal(0, 1, 200))
    out = home_only(ind.add_bollinger(ind.layout(series_df(spark, walk), halo=19)))
    for u, lw in zip(_collect(out, "bollinger_upper"), _collect(out, "bollinger_lower")):
        assert (u is None) == (lw is None) and (u is None or u >= lw)


def test_volatility_flat_and_short(spark):
    v = _collect(home_only(ind.add_volatility(ind.layout(series_df(spark, [100.0] * 50), halo=20))),
                 "volatility_20d")
    assert all(x is None for x in v[:20]) and all(x == 0.0 for x in v[20:])
    v = _collect(home_only(ind.add_volatility(ind.layout(series_df(spark, [100.0] * 10), halo=20))),
                 "volatility_20d")
    assert all(x is None for x in v)


def _rsi(spark, closes):
    return _collect(home_only(ind.add_rsi(ind.layout(series_df(spark, closes), halo=1))),
                    "rsi_14")


def test_rsi_trends_and_bounds(spark):
    up = _rsi(spark, range(100, 200))
    down = _rsi(spark, range(200, 100, -1))
    assert up[-1] > 95 and down[-1] < 5
    rng = np.random.default_rng(42)
    walk = 100 + np.cumsum(rng.normal(0, 1, 300))
    assert all(0 <= x <= 100 for x in _rsi(spark, walk))


def test_rsi_flat_warmup_and_short(spark):
    assert _rsi(spark, [100.0] * 30) == [100.0] * 30
    v = _rsi(spark, list(range(1, 26)))
    assert v[:13] == [100.0] * 13 and v[13] is not None
    assert all(x is None for x in _rsi(spark, range(1, 15)))


def test_macd_matches_pandas(spark):
    rng = np.random.default_rng(42)
    walk = 100 + np.cumsum(rng.normal(0, 1, 400))
    out = home_only(ind.add_macd(ind.layout(series_df(spark, walk), halo=0)))
    s = pd.Series(walk)
    macd = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    sig = macd.ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(_collect(out, "macd"), macd, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(_collect(out, "macd_signal"), sig, rtol=1e-9, atol=1e-9)
    short = home_only(ind.add_macd(ind.layout(series_df(spark, range(1, 20)), halo=0)))
    assert all(x is None for x in _collect(short, "macd"))


@pytest.mark.parametrize("block_rows", [128, 256])
def test_ewm_block_scan_across_many_blocks(spark, block_rows):
    """States are carried over many blocks; values must equal the sequential recurrence."""
    rng = np.random.default_rng(7)
    walk = np.abs(100 + np.cumsum(rng.normal(0, 1, 3000))) + 1
    d = ind.layout(series_df(spark, walk), halo=0, block_rows=block_rows)
    d = ind.add_ewm(d, [Ewm("e12", "close", span_alpha(12)), Ewm("e26", "close", span_alpha(26))],
                    block_rows=block_rows)
    out = home_only(d)
    s = pd.Series(walk)
    np.testing.assert_allclose(_collect(out, "e12"), s.ewm(span=12, adjust=False).mean(), rtol=1e-11)
    np.testing.assert_allclose(_collect(out, "e26"), s.ewm(span=26, adjust=False).mean(), rtol=1e-11)


def test_feature_table_many_tickers_one_hot(spark):
    """One ticker with most rows and several small ones: per-ticker results equal
    the single-ticker computation (blocks never mix tickers)."""
    rng = np.random.default_rng(3)
    frames = [series_df(spark, 100 + np.cumsum(rng.normal(0, 1, 2500)), "HOT")]
    frames += [series_df(spark, 50 + np.cumsum(rng.normal(0, 0.5, 300)), f"S{i}") for i in range(3)]
    allb = frames[0]
    for f in frames[1:]:
        allb = allb.unionByName(f)
    feats = ind.technical_features(allb, block_rows=512)
    solo = ind.technical_features(frames[1], block_rows=512)
    a = feats.filter(F.col("ticker") == "S0").orderBy("timestamp").select("rsi_14", "macd", "sma_200").collect()
    b = solo.orderBy("timestamp").select("rsi_14", "macd", "sma_200").collect()
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or u == pytest.approx(v, rel=1e-9, abs=1e-9)
    assert feats.filter(F.col("ticker") == "HOT").count() == 2500


def test_rsi_of_a_suspended_stock_keeps_its_ratio(spark):
    """Flat closes after movement: both means decay alike, far below any cut-off."""
    rng = np.random.default_rng(42)
    walk = np.concatenate([100 + np.cumsum(rng.normal(0, 1, 300)), np.zeros(2500)])
    walk[300:] = walk[299]
    delta = pd.Series(walk).diff().fillna(0)
    g, lo = (x.ewm(alpha=1 / 14, adjust=False).mean() for x in (delta.clip(lower=0), (-delta).clip(lower=0)))
    want = (100 - 100 / (1 + g / lo)).to_numpy()
    got = _rsi(spark, walk)
    np.testing.assert_allclose(got[13:], want[13:], rtol=1e-7)


@pytest.mark.parametrize("period", [2, 3, 21, 200])
def test_rsi_of_any_period(spark, period):
    walk = np.abs(100 + np.cumsum(np.random.default_rng(1).normal(0, 1, 1500))) + 1
    out = _collect(home_only(ind.add_rsi(ind.layout(series_df(spark, walk), halo=1, block_rows=256), period, block_rows=256)), f"rsi_{period}")
    delta = pd.Series(walk).diff().fillna(0)
    g, lo = (x.ewm(alpha=1 / period, adjust=False).mean() for x in (delta.clip(lower=0), (-delta).clip(lower=0)))
    np.testing.assert_allclose(out[period:], (100 - 100 / (1 + g / lo))[period:], rtol=1e-8)


def test_macd_with_equal_decays_and_long_spans(spark):
    walk = np.abs(100 + np.cumsum(np.random.default_rng(2).normal(0, 1, 3000))) + 1
    s = pd.Series(walk)
    for fast, slow, signal in ((5, 35, 5), (1, 1000, 700)):
        out = home_only(ind.add_macd(ind.layout(series_df(spark, walk), halo=0, block_rows=256), fast, slow, signal, block_rows=256))
        macd = s.ewm(span=fast, adjust=False).mean() - s.ewm(span=slow, adjust=False).mean()
        np.testing.assert_allclose(_collect(out, "macd")[slow:], macd[slow:], rtol=1e-8, atol=1e-9)
        np.testing.assert_allclose(_collect(out, "macd_signal")[slow:], macd.ewm(span=signal, adjust=False).mean()[slow:], rtol=1e-8, atol=1e-9)
