"""Models (J8-J15) and the registry (J14) on small prepared frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(5)
    n = 273
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (a + 0.3 * rng.normal(size=n) > 0).astype(int)
    pdf = pd.DataFrame({"ticker": "T", "fold": 0, "split": ["train"] * 252 + ["test"] * 21,
                        "rn": np.arange(n), "a": a, "b": b, "target": y})
    return spark.createDataFrame(pdf)


def test_logistic_per_fold(spark, prepared):
    from tickwise.operators.models import fold_metrics, logistic_fold_predictions
    preds = logistic_fold_predictions(prepared, COLS)
    assert preds.count() == 21
    m = fold_metrics(preds).collect()[0]
    assert m["accuracy"] > 0.7 and 0 <= m["roc_auc"] <= 1


def test_select_best_tie_goes_to_model_order(spark):
    from tickwise.operators.models import select_best
    rows = [("T", "xgboost", 0.5, 0.5, 0.5, 0.6, 0.5), ("T", "logistic_regression", 0.5, 0.5, 0.5, 0.6, 0.5),
            ("T", "random_forest", 0.5, 0.5, 0.5, 0.4, 0.5)]
    df = spark.createDataFrame(rows, "ticker string, model string, accuracy double, precision double, "
                                     "recall double, f1 double, roc_auc double")
    assert {r["best_model"] for r in select_best(df, ["ticker"]).collect()} == {"logistic_regression"}


def test_refit_save_load_predict(spark, prepared, tmp_path):
    from pyspark.ml import PipelineModel
    from tickwise.operators.models import refit
    refit(prepared, COLS, "logistic_regression", str(tmp_path / "m"))
    model = PipelineModel.load(str(tmp_path / "m"))
    out = model.transform(prepared.withColumn("target", F.col("target").cast("double")))
    assert out.filter(F.col("prediction") == F.col("target")).count() > 200


def test_registry_promote_and_auto_promote(spark, tmp_path):
    from tickwise.operators.registry import ModelRegistry
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    v1 = reg.register("logistic_regression", {"f1": 0.50}, "/m1", ticker="A", version="v1")
    assert reg.active().count() == 0
    assert reg.auto_promote_if_better(v1, 0.50)          # no active model -> promote
    v2 = reg.register("xgboost", {"f1": 0.505}, "/m2", ticker="A", version="v2")
    assert not reg.auto_promote_if_better(v2, 0.505)     # gain 0.005 <= 0.01
    v3 = reg.register("random_forest", {"f1": 0.52}, "/m3", ticker="A", version="v3")
    assert reg.auto_promote_if_better(v3, 0.52)
    assert [r["version"] for r in reg.active().collect()] == ["v3"]
    assert reg.table().filter("is_active").count() == 1
    assert not reg.promote("missing")
    assert reg.list_models().count() == 3


def test_concurrent_writers_lose_no_change(spark, tmp_path):
    """Eight writers register at once, then two promote at once: every row is there and one is active."""
    from concurrent.futures import ThreadPoolExecutor
    from tickwise.operators.registry import ModelRegistry
    make = lambda: ModelRegistry(spark, str(tmp_path / "reg"))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: make().register("m", {"f1": k / 10}, "/m", ticker=f"T{k}", version=f"v{k}"), range(8)))
    assert {r.version for r in make().table().collect()} == {f"v{k}" for k in range(8)}
    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(lambda v: make().promote(v), ["v1", "v2"])) == [True, True]
    assert make().table().filter("is_active").count() == 1 and make().table().count() == 8
    with ThreadPoolExecutor(4) as pool:      # each decides on the snapshot that it replaces
        list(pool.map(lambda k: make().auto_promote_if_better(f"v{k}", k / 10), [3, 5, 7, 6]))
    assert [r.version for r in make().active().collect()] == ["v7"]


def test_refused_record_is_tried_again(spark, tmp_path, monkeypatch):
    from tickwise.operators import registry
    reg, other = (registry.ModelRegistry(spark, str(tmp_path / "reg")) for _ in range(2))
    put, calls = registry.commits.put_if_absent, []

    def first_beaten(*a):
        calls.append(a)
        if len(calls) == 1:
            put(a[0], a[1], {"data": _one(other)})
        return put(*a)

    def _one(r):
        r.spark.createDataFrame([("m", "theirs", "", 0.0, 0.0, 0.0, 0.0, None, False, "")], registry.SCHEMA).write.parquet(f"{r.base}/data/x")
        return "x"

    monkeypatch.setattr(registry.commits, "put_if_absent", first_beaten)
    reg.register("m", {}, "/m", version="mine")
    assert {r.version for r in reg.table().collect()} == {"theirs", "mine"} and len(calls) == 2


@pytest.mark.parametrize("broken", ["ingest", "register"])
def test_daily_job_goes_on_after_a_failure(spark, tmp_path, monkeypatch, broken):
    """The job fails inside a step (after its writes); the same run resumed gives what an undisturbed one gives."""
    from tickwise.plans import daily
    n = 500
    rng = np.random.default_rng(2)
    close = 100 * np.exp(np.cumsum(0.01 * rng.normal(size=n)))
    days = pd.date_range("2020-01-01", periods=n)
    pdf = pd.DataFrame({"ticker": "T", "timestamp": days, "open": close, "high": close, "low": close, "close": close, "volume": 10})
    new = spark.createDataFrame(pdf, "ticker string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint")
    now = days[-1].to_pydatetime()
    step, at = daily.DailyRun.step, {}

    def failing(self, name, work):
        def broken_work(folder):
            out = work(folder)
            if name == broken and "failed" not in at:
                at["failed"] = True
                raise ZeroDivisionError
            at[name] = at.get(name, 0) + 1
            return out
        return step(self, name, broken_work)

    monkeypatch.setattr(daily.DailyRun, "step", failing)
    args = dict(base=str(tmp_path), now=now, min_rows=100, run="day1")
    with pytest.raises(ZeroDivisionError):
        daily.run_daily(spark, new, **args)
    got = {r.step: r.value for r in daily.run_daily(spark, new, **args).collect()}
    assert got["inserted_rows"] == n and got["feature_rows"] == n - 199 and got["folds"] == (n - 199 - 20 - 1 - 273) // 21 + 1
    assert got["promoted"] == 1.0 and 0 <= got["best_f1"] <= 1
    assert all(at[s] == 1 for s in daily.STEPS)      # finished steps are not run again
    job = daily.DailyRun(spark, str(tmp_path), "day1")
    assert job.prices().count() == n
    again = {r.step: r.value for r in daily.run_daily(spark, new, **{**args, "run": "day2"}).collect()}
    assert again["inserted_rows"] == 0 and job.prices().count() == n and again["promoted"] == 0.0
