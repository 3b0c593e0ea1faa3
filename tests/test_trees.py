"""Trees of all folds, parameter search, saved preparation and models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.operators import refit, trees

COLS = ["a", "b", "c"]


def fold(seed=5, n=273, noise=0.3):
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, 3)), 2)
    y = (X[:, 0] + X[:, 1] ** 2 - 0.7 + noise * rng.normal(size=n) > 0).astype(int)
    return pd.DataFrame(X, columns=COLS).assign(ticker="T", fold=0, split=np.where(np.arange(n) < 252, "train", "test"), rn=np.arange(n), target=y)


@pytest.fixture(scope="module")
def prepared(spark):
    parts = [fold(seed).assign(ticker=t, fold=f) for seed, (t, f) in enumerate([("A", 0), ("A", 1), ("B", 0)])]
    one_class = fold(9).assign(ticker="C", target=1)
    only_train = fold(10).assign(ticker="D", split="train")
    return spark.createDataFrame(pd.concat([*parts, one_class, only_train], ignore_index=True))


def test_one_split_by_hand():
    """Labels 0 0 1 1 1 0 over values 1..6: the cut after the second row leaves 0 0 | 1 1 1 0."""
    codes = np.arange(6)[:, None]
    y = np.array([0, 0, 1, 1, 1, 0.0])
    one = np.ones(6)
    got = trees.grow(codes, np.arange(6), np.zeros(6, int), y, one, one, depth=1)
    assert got.leaf.tolist() == [0, 0, 0.75, 0.75, 0.75, 0.75]
    assert got.nodes[["node", "feature", "cut"]].values.tolist() == [[1, 0, 1], [2, -1, -1], [3, -1, -1]]
    two = trees.grow(codes, np.arange(6), np.zeros(6, int), y, one, one, depth=2)
    assert two.leaf.tolist() == [0, 0, 1, 1, 1, 0]
    assert trees.grow(codes, np.arange(6), np.zeros(6, int), y, one, one, depth=2, least_rows=4).leaf.tolist() == [0.5] * 6
    # rows without weight follow the splits
    weight = np.array([1, 1, 1, 1, 0, 0.0])
    assert trees.grow(codes, np.arange(6), np.zeros(6, int), y * weight, weight, weight, depth=1).leaf.tolist() == [0, 0, 1, 1, 1, 1]


def test_bins_keep_the_order_of_values():
    X = np.array([[1.0, 5], [2, 5], [2, 5], [9, 5]])
    cuts = trees.cut_points(X)
    assert cuts[0].tolist() == [1.5, 5.5] and cuts[1].tolist() == []
    assert trees.binned(X, cuts).tolist() == [[0, 0], [1, 0], [1, 0], [2, 0]]
    many = np.random.default_rng(0).normal(size=(1000, 1))
    cuts = trees.cut_points(many, 16)
    size = np.bincount(trees.binned(many, cuts)[:, 0])
    assert len(size) == 16 and size.min() > 50 and size.max() < 75


def test_bootstrap_weights_are_poisson():
    w = trees.bootstrap(1, np.arange(20000), np.zeros(20000, int))
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert (trees.bootstrap(1, np.arange(100), np.ones(100, int)) != w[:100]).any()


def brute_boost(X, y, train, rounds, depth, rate, penalty=1.0, least=1.0):
    """Second-order boosting by trying every cut of every node, recursively."""
    cuts = trees.cut_points(X[train])
    margin = np.zeros(len(y))

    def node(rows, g, h, level):
        own = rows & train
        G, H = g[own].sum(), h[own].sum()
        tried = []
        if level < depth and own.sum() >= 2 and H >= 2 * least:
            for f, cs in enumerate(cuts):
                for c in cs:
                    left = X[:, f] <= c
                    a, b = own & left, own & ~left
                    if not a.any() or not b.any() or min(h[a].sum(), h[b].sum()) < least:
                        continue
                    tried.append((g[a].sum() ** 2 / (h[a].sum() + penalty) + g[b].sum() ** 2 / (h[b].sum() + penalty) - G * G / (H + penalty), left))
        best = max((t[0] for t in tried), default=0)
        found = next((left for gain, left in tried if gain >= best - 1e-9 * (1 + best)), None) if best > 1e-9 else None
        if found is None:
            return np.where(rows, G / (H + penalty), 0.0)
        return node(rows & found, g, h, level + 1) + node(rows & ~found, g, h, level + 1)

    losses = []
    for _ in range(rounds):
        p = trees.sigmoid(margin)
        margin = margin + rate * node(np.ones(len(y), bool), y - p, p * (1 - p), 0)
        losses.append(np.logaddexp(0, np.where(y[train] == 1, -margin[train], margin[train])).mean())
    return margin, losses


def test_boosting_equals_brute_force():
    d = fold(3, n=80).assign(split=["train"] * 60 + ["test"] * 20)
    X, y, train = d[COLS].to_numpy(), d.target.to_numpy(float), (d.split == "train").to_numpy()
    codes = trees.binned(X, trees.cut_points(X[train]))
    p = trees.Boosted(rounds=8, depth=3, rate=0.3)
    margins = [trees.boost(codes, y, train, np.arange(80), [p], 0, k)[0] for k in range(1, 9)]
    want, losses = brute_boost(X, y, train, 8, 3, 0.3)
    assert np.allclose(margins[-1], want)
    own = [np.logaddexp(0, np.where(y[train] == 1, -m[train], m[train])).mean() for m in margins]
    assert np.allclose(own, losses) and all(a > b for a, b in zip(own, own[1:]))     # the loss falls each round


def test_models_grown_together_are_those_grown_alone():
    d = fold(4)
    X, y, train = d[COLS].to_numpy(), d.target.to_numpy(float), (d.split == "train").to_numpy()
    codes = trees.binned(X, trees.cut_points(X[train]))
    models = trees.draws(6)
    models = [trees.replace(m, rounds=5 + k) for k, m in enumerate(models)]
    both = trees.boost(codes, y, train, np.arange(len(y)), models, 0, 20)
    for k, m in enumerate(models):
        assert np.allclose(both[k], trees.boost(codes, y, train, np.arange(len(y)), [m], 0, 20)[0])
    half = trees.boost(codes, y, train, np.arange(len(y)), models, 0, 4)
    assert np.allclose(both, trees.boost(codes, y, train, np.arange(len(y)), models, 4, 20, half))      # resumed


def test_search_scores_rows_that_were_not_fitted():
    d = fold(6)
    X, y, train = d[COLS].to_numpy(), d.target.to_numpy(float).copy(), (d.split == "train").to_numpy()
    codes = trees.binned(X, trees.cut_points(X[train]))
    models = trees.draws(9)
    k, f1 = trees._tuned(codes, y, train, np.arange(len(y)), models, 0.2)
    place = np.arange(len(y))
    fit, tail = train & (place < 202), train & (place >= 202)
    alone = trees.boost(codes, y, fit, np.arange(len(y)), [models[k]], 0, models[k].rounds)[0]
    assert f1 == pytest.approx(float(trees.f1_score(y[tail], alone[tail] > 0)))
    other = y.copy()
    other[tail] = 1 - other[tail]           # labels of the tail are not learnt
    assert np.allclose(alone, trees.boost(codes, other, fit, np.arange(len(y)), [models[k]], 0, models[k].rounds)[0])
    assert trees.f1_score(np.array([1, 1, 0, 0]), np.array([True, False, True, False])) == 0.5
    assert trees.f1_score(np.array([0, 0]), np.array([False, False])) == 0


@pytest.mark.parametrize("make,model", [(lambda d: trees.forest_predictions(d, COLS), "random_forest"),
                                        (lambda d: trees.boosted_predictions(d, COLS), "xgboost"),
                                        (lambda d: trees.tuned_predictions(d, COLS, models=trees.draws(5)), "xgboost")])
def test_all_folds_in_one_job(spark, prepared, make, model):
    rows = make(prepared).toPandas()
    assert set(zip(rows.ticker, rows.fold)) == {("A", 0), ("A", 1), ("B", 0), ("C", 0)} and set(rows.model) == {model}
    assert rows.groupby(["ticker", "fold"]).size().eq(21).all() and rows.y_prob.between(0, 1).all()
    some = rows[rows.ticker != "C"]
    constant = max(some.y_true.mean(), 1 - some.y_true.mean())
    assert (some.y_true == some.y_pred).mean() > constant + 0.05
    assert (rows[rows.ticker == "C"].y_pred == 1).all()
    again = make(prepared.repartition(3, "rn")).toPandas()        # equal wherever and in whatever order rows come
    key = ["ticker", "fold", "rn"]
    pd.testing.assert_frame_equal(rows.sort_values(key).reset_index(drop=True), again.sort_values(key).reset_index(drop=True))
    assert make(prepared.limit(0)).count() == 0


def test_search_returns_a_row_per_fold(spark, prepared):
    models = trees.draws(4)
    rows = trees.search(prepared, COLS, models=models).collect()
    assert len(rows) == 4
    for r in rows:
        assert models[r.best_draw].rounds == r.rounds and models[r.best_draw].depth == r.depth and 0 <= r.best_f1 <= 1


# --- saved preparation and models

def raw_rows(spark, n=300):
    rng = np.random.default_rng(1)
    parts = []
    for t, shift in (("A", 0), ("B", 5)):
        X = rng.normal(size=(n, 3)) * [1, 10, 0] + [shift, 0, 2]
        d = pd.DataFrame(X, columns=COLS).assign(ticker=t, timestamp=pd.date_range("2020-01-01", periods=n),
                                                 target=(X[:, 0] - shift + 0.2 * rng.normal(size=n) > 0).astype(int))
        d.loc[3, "a"], d.loc[4, "a"], d.loc[5, "b"], d.loc[6, "b"] = np.nan, np.inf, 1e9, -np.inf
        parts.append(d)
    return pd.concat(parts, ignore_index=True)


def test_saved_preparation_by_hand(spark):
    pdf = raw_rows(spark)
    saved = refit.fit_preparation(spark.createDataFrame(pdf), COLS)
    got = {r.ticker: {f.feature: f for f in r.features} for r in saved.collect()}
    for t, part in pdf.groupby("ticker"):
        for c in COLS:
            x = part[c].replace([np.inf, -np.inf], np.nan)
            x = x.fillna(x.median())
            q1, q3 = x.quantile(0.25), x.quantile(0.75)
            x = x.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
            f = got[t][c]
            assert np.allclose([f.least, f.most, f.mean, f.scale], [x.min(), x.max(), x.mean(), x.std(ddof=0) or 1.0])
    serving = spark.createDataFrame([("A", 1e9, None, 2.0), ("B", float("-inf"), 0.0, 7.0), ("Z", 0.0, 0.0, 0.0)],
                                    "ticker string, b double, a double, c double")
    out = {r.ticker: r for r in refit.apply_preparation(serving, saved).collect()}
    a, b = got["A"], got["B"]
    assert set(out) == {"A", "B"}
    assert out["A"].b == pytest.approx((a["b"].most - a["b"].mean) / a["b"].scale)
    assert out["A"].a == pytest.approx((a["a"].median - a["a"].mean) / a["a"].scale)
    assert out["B"].b == pytest.approx((b["b"].median - b["b"].mean) / b["b"].scale)
    assert out["B"].c == 0.0 and out["A"].c == 0.0        # a constant feature


@pytest.mark.parametrize("model", ["logistic_regression", "random_forest", "xgboost"])
def test_prediction_uses_the_saved_order_and_numbers(spark, tmp_path, model):
    """Serving columns in another order, with values on the raw scale: the model gets what it was fitted on."""
    pdf = raw_rows(spark)
    train = spark.createDataFrame(pdf)
    refit.refit(train.unionByName(train.limit(40)), COLS, model, str(tmp_path / "m"))       # repeated rows count once
    preparation, parameters = refit.load(spark, str(tmp_path / "m"))
    rows = train.select("target", "c", "timestamp", "b", "ticker", "a")
    got = refit.predict(rows, preparation, parameters, "v1").toPandas()
    assert list(got.columns) == ["ticker", "timestamp", "predicted_direction", "confidence", "model_version", "model_name"]
    both = got.merge(pdf, on=["ticker", "timestamp"])
    assert len(both) == 600 and ((both.predicted_direction == "UP") == (both.target == 1)).mean() > 0.9
    assert both.confidence.between(0.5, 1).all() and set(both.model_name) == {model}
    # node by node as in training
    fitted = refit.apply_preparation(train, preparation).toPandas()
    part = fitted[fitted.ticker == "A"].sort_values("timestamp")
    X, y = part[COLS].to_numpy(float), part.target.to_numpy(float)
    prob = refit.probabilities(refit.apply_preparation(rows, preparation), parameters, COLS).toPandas()
    mine = prob[prob.ticker == "A"].sort_values("timestamp").y_prob.to_numpy()
    if model == "logistic_regression":
        from tickwise.operators.models import fit_logistic
        beta = fit_logistic(X, y)
        assert np.allclose(mine, trees.sigmoid(beta[0] + X @ beta[1:]))
    else:
        codes, every, number = trees.binned(X, trees.cut_points(X)), np.ones(len(y), bool), np.arange(len(y))
        p = trees.Boosted()
        want = (trees.forest(codes, y, every, number)[0] if model == "random_forest"
                else trees.sigmoid(trees.boost(codes, y, every, number, [p], 0, p.rounds)[0]))
        assert np.allclose(mine, want)


def test_each_ticker_gets_its_chosen_model(spark, tmp_path):
    train = spark.createDataFrame(raw_rows(spark))
    chosen = spark.createDataFrame([("A", "xgboost"), ("B", "logistic_regression")], "ticker string, model string")
    refit.refit(train, COLS, chosen, str(tmp_path / "m"))
    preparation, parameters = refit.load(spark, str(tmp_path / "m"))
    assert {tuple(r) for r in parameters.select("ticker", "model").distinct().collect()} == {("A", "xgboost"), ("B", "logistic_regression")}
    got = refit.predict(train, preparation, parameters, "v").groupBy("ticker").agg(F.min("model_name"), F.max("model_name")).collect()
    assert {tuple(r) for r in got} == {("A", "xgboost", "xgboost"), ("B", "logistic_regression", "logistic_regression")}
    with pytest.raises(ValueError):
        refit._fitted(np.zeros((2, 1)), np.array([0.0, 1]), np.arange(2), ["a"], "unknown")
    with pytest.raises(Exception):      # a model is never overwritten
        refit.refit(train, COLS, chosen, str(tmp_path / "m"))
