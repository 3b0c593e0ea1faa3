"""Property tests: distributed operators equal brute force on random inputs."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import series_df
from tickwise.operators.series import halo_blocks, home_only, number_rows

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def sliding_model(secs, limit, window):
    """From the definition: a hit is rejected if ``limit`` accepted ones lie in the window before it."""
    rejected = []
    for i, t in enumerate(secs):
        inside = sum(not r and t - s <= window for s, r in zip(secs[:i], rejected))
        rejected.append(inside >= limit)
    return rejected


def fixed_model(secs, limit, window):
    """Windows open at the first hit that no earlier window covers."""
    opened, out = [], []
    for t in secs:
        if not opened or t >= opened[-1] + window:
            opened.append(t)
        out.append(sum(opened[-1] <= s <= t for s in secs[:len(out)]) + 1 > limit)
    return out


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400)), min_size=1, max_size=60),
       st.integers(1, 3), st.integers(10, 120))
def test_limiters_equal_per_key_loop(spark, hits, max_requests, window):
    from tickwise.operators.requestlog import fixed_window_limit, sliding_log_limit
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), f"c{k}", "/p", 200, i) for i, (k, s) in enumerate(hits)]
    log = spark.createDataFrame(rows, "ts timestamp, client string, path string, status int, seq long")
    pdf = pd.DataFrame(rows, columns=["ts", "client", "path", "status", "seq"])
    for spark_fn, ref_fn in ((sliding_log_limit, sliding_model), (fixed_window_limit, fixed_model)):
        got = {r["seq"]: r["rejected"] for r in spark_fn(log, max_requests, window).collect()}
        want = {}
        for _, g in pdf.groupby("client"):
            g = g.sort_values(["ts", "seq"])
            secs = (g["ts"] - base).dt.total_seconds().to_numpy()
            want.update(dict(zip(g["seq"], ref_fn(secs, max_requests, window))))
        assert got == want


@SETTINGS
@given(st.integers(30, 2500), st.floats(0.005, 1.0), st.sampled_from([64, 256, 1024]),
       st.integers(0, 1000))
def test_ewm_equals_sequential(spark, n, alpha, block_rows, seed):
    from tickwise.operators import indicators as ind
    from tickwise.operators.recurrence import Ewm
    from tickwise.operators.series import home_only
    x = np.abs(50 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))) + 1
    d = ind.layout(series_df(spark, x), halo=0, block_rows=block_rows)
    out = home_only(ind.add_ewm(d, [Ewm("y", "close", alpha)], block_rows=block_rows))
    got = [r["y"] for r in out.orderBy("timestamp").select("y").collect()]
    np.testing.assert_allclose(got, pd.Series(x).ewm(alpha=alpha, adjust=False).mean(), rtol=1e-10)


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=300),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_equal_numpy(spark, values, probs):
    from tickwise.functions.stats import exact_quantiles
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = {r["p"]: r["quantile"] for r in exact_quantiles(df, "x", probs).collect()}
    for p in probs:
        assert abs(got[float(p)] - np.percentile(values, p * 100)) <= 1e-9 * (1 + abs(np.percentile(values, p * 100)))


@pytest.mark.parametrize("n,fan,seed", [(20, 2, 0), (137, 3, 1), (400, 5, 2)])
def test_prefix_scan_over_many_levels(spark, n, fan, seed):
    """E6 and the MACD signal with tiny groups, so that several levels are needed; too few raise an error."""
    from tickwise.operators.recurrence import Chain, Ewm, ewm_pass
    x = np.random.default_rng(seed).normal(size=n) + 10
    d = halo_blocks(number_rows(series_df(spark, x)), 0, 4)
    specs, chains = [Ewm("f", "close", 2 / 13), Ewm("s", "close", 0.9)], [Chain("g", "f", "s", 0.2)]
    levels = 1
    while 4 * fan ** levels < n:
        levels += 1
    got = home_only(ewm_pass(d, specs, "ticker", 4, chains, fan, levels)).toPandas().sort_values("rn")
    c = pd.Series(x)
    f, s = c.ewm(alpha=2 / 13, adjust=False).mean(), c.ewm(alpha=0.9, adjust=False).mean()
    np.testing.assert_allclose(got["f"], f, rtol=1e-10)
    np.testing.assert_allclose(got["s"], s, rtol=1e-10)
    np.testing.assert_allclose(got["g"][1:], (f - s).ewm(alpha=0.2, adjust=False).mean()[1:], rtol=1e-8, atol=1e-10)
    if levels > 1:
        with pytest.raises(Exception, match="more levels"):
            ewm_pass(d, specs, "ticker", 4, chains, fan, levels - 1).toPandas()


@pytest.mark.parametrize("n,kinds,seed", [(1, 1, 0), (40, 3, 1), (900, 900, 2), (700, 40, 3)])
def test_auc_equals_pairs(spark, n, kinds, seed):
    """D13 against counting pairs, ties as a half; groups with one class give 0.5, null groups are a group."""
    from tickwise.operators.metrics import roc_auc
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], n), "y_prob": rng.integers(0, kinds, n) / kinds, "y_true": rng.integers(0, 2, n)})
    got = {r.g: r.roc_auc for r in roc_auc(spark.createDataFrame(pdf, "g string, y_prob double, y_true int"), ["g"]).collect()}
    for g, part in pdf.groupby("g", dropna=False):
        a, b = part[part.y_true == 1].y_prob.to_numpy()[:, None], part[part.y_true == 0].y_prob.to_numpy()[None, :]
        want = 0.5 if a.size == 0 or b.size == 0 else ((a > b) + 0.5 * (a == b)).mean()
        assert abs(got[None if g is None or g != g else g] - want) < 1e-9
