"""Direction models: J8, J12 and the Spark ML form of J13.

* J8 logistic regression (L2, C = 1, intercept unpenalised) is fitted for
  every (ticker, fold) group in parallel with ``applyInPandas``: each group
  is the fold's 273 prepared rows, solved by Newton steps on the 12x12
  normal equations (numpy inside the task; Spark partitions the folds).
* J9-J11 (forest, boosted trees, search) are in ``trees``.
* J12 averages fold metrics per model and picks the best by mean F1 (first
  model in the fixed order wins a tie).
* J13 for each ticker, with the preparation saved beside the model, is in ``refit``. ``refit`` here fits
  one model over rows of any number (Spark ML) and saves a ``PipelineModel``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import trees
from tickwise.operators.metrics import confusion_metrics, roc_auc
from tickwise.session import materialize

# Fixed values from the reference: model order and hyper-parameters.
MODEL_ORDER = ["logistic_regression", "random_forest", "xgboost"]
LOGISTIC_C = 1.0
LOGISTIC_MAX_ITER = 1000


def fit_logistic(X: np.ndarray, y: np.ndarray, C: float = LOGISTIC_C,
                 max_iter: int = LOGISTIC_MAX_ITER, tol: float = 1e-10) -> np.ndarray:
    """Minimise 0.5 |w|^2 + C * sum(log-loss); returns [intercept, w...]."""
    Xb = np.hstack([np.ones((X.shape[0], 1)), X])
    beta = np.zeros(Xb.shape[1])
    reg = np.eye(Xb.shape[1]) / C
    reg[0, 0] = 0.0
    for _ in range(max_iter):
        z = np.clip(Xb @ beta, -35, 35)
        p = 1.0 / (1.0 + np.exp(-z))
        grad = Xb.T @ (p - y) + reg @ beta
        hess = (Xb * (p * (1 - p))[:, None]).T @ Xb + reg
        step = np.linalg.solve(hess + 1e-12 * np.eye(len(beta)), grad)
        beta -= step
        if np.max(np.abs(step)) < tol:
            break
    return beta


def logistic_fold_predictions(prepared: DataFrame, cols: list[str],
                              group=("ticker", "fold")) -> DataFrame:
    """J8 on every group: fit on train rows, predict the test rows.

    Rows (group..., rn, y_true, y_pred, y_prob, model).
    """
    group = list(group)
    out_schema = ", ".join([f"{g} {t}" for g, t in prepared.select(*group).dtypes]
                           + ["rn long", "y_true int", "y_pred int", "y_prob double", "model string"])

    def fit_predict(pdf: pd.DataFrame) -> pd.DataFrame:
        train = pdf[pdf["split"] == "train"]
        test = pdf[pdf["split"] == "test"].sort_values("rn")
        if train.empty or test.empty:
            return pd.DataFrame(columns=group + ["rn", "y_true", "y_pred", "y_prob", "model"])
        y = train["target"].to_numpy(dtype=float)
        if y.min() == y.max():      # one class: constant prediction
            prob = np.full(len(test), float(y[0]))
        else:
            beta = fit_logistic(train[cols].to_numpy(dtype=float), y)
            z = np.clip(beta[0] + test[cols].to_numpy(dtype=float) @ beta[1:], -35, 35)
            prob = 1.0 / (1.0 + np.exp(-z))
        res = test[group + ["rn"]].copy()
        res["y_true"] = test["target"].astype("int32").to_numpy()
        res["y_pred"] = (prob > 0.5).astype("int32")
        res["y_prob"] = prob
        res["model"] = "logistic_regression"
        return res

    src = prepared.select(*group, "split", "rn", "target", *cols)
    return trees.spread(src, group).groupBy(*group).applyInPandas(fit_predict, out_schema)


def fold_metrics(preds: DataFrame, group=("ticker", "fold", "model")) -> DataFrame:
    """D12 + D13 per (ticker, fold, model). The predictions are written once: both metrics read them, and models
    are not fitted twice."""
    group = list(group)
    preds = materialize(preds)
    return confusion_metrics(preds, group).join(roc_auc(preds, group), group)


def _assembler_pipeline(cols: list[str], classifier):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    # scaler with centring; Spark's sample std differs from the population std by
    # sqrt(n/(n-1)): no matter to tree splits, and see ``logistic_penalty``.
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_raw"),
                            StandardScaler(inputCol="_raw", outputCol="features", withMean=True,
                                           withStd=True),
                            classifier])


def logistic_penalty(n: int, C: float = LOGISTIC_C) -> float:
    """``regParam`` that makes Spark minimise 0.5 |w|^2 + C * sum(log-loss) over ``n`` rows.

    Spark minimises the mean loss, hence 1 / (C n); the factor (n-1)/n is the squared
    ratio of population to sample std, as |w| is meant for the former's scale.
    """
    return (n - 1) / (C * n * n) if n > 1 else 1.0 / C


def make_classifier(name: str, params: dict | None = None):
    from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                           RandomForestClassifier)
    params = params or {}
    if name == "random_forest":
        d = trees.Forest()
        return RandomForestClassifier(labelCol="target", featuresCol="features", **{
            "numTrees": d.trees, "maxDepth": d.depth, "minInstancesPerNode": d.least_rows, "seed": d.seed, **params})
    if name == "xgboost":
        d = trees.Boosted()
        return GBTClassifier(labelCol="target", featuresCol="features", **{
            "maxIter": d.rounds, "maxDepth": d.depth, "stepSize": d.rate, "seed": d.seed, **params})
    if name == "logistic_regression":
        return LogisticRegression(labelCol="target", featuresCol="features",
                                  maxIter=LOGISTIC_MAX_ITER, elasticNetParam=0.0,
                                  standardization=False, **params)
    raise ValueError(name)


def all_fold_predictions(prepared: DataFrame, cols: list[str], group=("ticker", "fold")) -> DataFrame:
    """Test predictions of the three models for every group."""
    return (logistic_fold_predictions(prepared, cols, group)
            .unionByName(trees.forest_predictions(prepared, cols, group))
            .unionByName(trees.boosted_predictions(prepared, cols, group)))


def select_best(metrics: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Mean fold metrics per model; best = highest mean F1, ties by model order."""
    group = list(group or [])
    means = metrics.groupBy(*group, "model").agg(
        *[F.avg(m).alias(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")],
        F.count(F.lit(1)).alias("folds"))
    known = F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("model"))
    order = F.when(known == 0, F.lit(len(MODEL_ORDER) + 1)).otherwise(known)   # others come last
    from pyspark.sql import Window
    score = F.struct(F.col("f1"), (-order).alias("_t"), F.col("model"))
    # one row per (group, model): the window spans at most three rows
    return means.withColumn("best_model", F.max_by(F.col("model"), score).over(
        Window.partitionBy(*group)))


def refit(train: DataFrame, cols: list[str], model: str, path: str | None = None):
    """Fit the chosen model on all rows; optionally save the PipelineModel."""
    t = train.withColumn("target", F.col("target").cast("double"))
    params = {"regParam": logistic_penalty(t.count())} if model == "logistic_regression" else None
    fitted = _assembler_pipeline(cols, make_classifier(model, params)).fit(t)
    if path:
        fitted.write().overwrite().save(path)
    return fitted
