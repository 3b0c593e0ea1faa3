"""The chosen model refitted for every ticker, saved with its preparation, and applied.

The preparation (J2-J6) is fitted on all rows of a ticker and kept as numbers: for each feature, in the
order the model was fitted with, the median for missing values, the bounds of the capped training values, their
mean and scale. Training rows and serving rows go through the same ``apply_preparation``, so a
model never sees rows prepared in another way. Infinite values count as missing here (the folds' fill from
neighbouring rows needs a series, which a single serving row is not).

Models are fitted where a ticker's rows are, all tickers in one job. A group must hold a bounded series:
a century of daily bars is 25,000 rows; more than ``MAX_ROWS`` is refused (``models.refit`` fits one model over any
number of rows). The parameters are one table, a row for each coefficient or tree node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import trees
from tickwise.operators.models import fit_logistic

MAX_ROWS = 200_000
_PARAMS = "model string, tree int, node bigint, feature string, threshold double, value double"


def _clean(c: str) -> Column:
    """The value, or null where it is not finite."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def fit_preparation(train: DataFrame, cols: list[str], group=("ticker",), iqr: float = 1.5) -> DataFrame:
    """(group..., features): one row for each group; an array of (feature, median, least, most, mean, scale) structs."""
    group = list(group)
    rows = train.select(*group, *[_clean(c).alias(c) for c in cols])
    median = rows.groupBy(*group).agg(*[F.coalesce(F.percentile(c, 0.5), F.lit(0.0)).alias(f"_m_{c}") for c in cols])
    filled = rows.join(median, group).select(*group, *[F.coalesce(c, f"_m_{c}").alias(c) for c in cols])
    fences = filled.groupBy(*group).agg(*[F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias(f"_q_{c}") for c in cols])

    def capped(c):
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        return F.least(F.greatest(F.col(c), q1 - iqr * (q3 - q1)), q3 + iqr * (q3 - q1)).alias(c)

    kept = filled.join(fences, group).select(*group, *[capped(c) for c in cols])
    stats = kept.groupBy(*group).agg(*[x for c in cols for x in (
        F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"), F.avg(c).alias(f"_mean_{c}"), F.stddev_pop(c).alias(f"_sd_{c}"))])
    one = lambda c: F.struct(
        F.lit(c).alias("feature"), F.col(f"_m_{c}").alias("median"), F.col(f"_lo_{c}").alias("least"), F.col(f"_hi_{c}").alias("most"),
        F.col(f"_mean_{c}").alias("mean"), F.when(F.col(f"_sd_{c}") == 0, 1.0).otherwise(F.col(f"_sd_{c}")).alias("scale"))
    return stats.join(median, group).select(*group, F.array(*[one(c) for c in cols]).alias("features"))


def apply_preparation(rows: DataFrame, saved: DataFrame, group=("ticker",)) -> DataFrame:
    """``rows`` of the saved groups with their features filled, bounded and scaled by the saved numbers.

    Features are found by the saved names; any column order of ``rows`` will do, a missing column is an error.
    """
    group = list(group)
    names = saved.select(F.col("features.feature").alias("f")).limit(1).collect()
    if not names:
        return rows.limit(0)
    cols = list(names[0]["f"])
    at = {c: F.col("features")[i] for i, c in enumerate(cols)}
    out = {c: (F.least(F.greatest(F.coalesce(_clean(c), s["median"]), s["least"]), s["most"]) - s["mean"]) / s["scale"]
           for c, s in at.items()}
    return rows.join(saved, group).withColumns(out).drop("features")


def _nodes(nodes: pd.DataFrame, cols, cuts, scale: float = 1.0) -> pd.DataFrame:
    inner = nodes.feature >= 0
    where = [cuts[f][c] if f >= 0 else np.nan for f, c in zip(nodes.feature, nodes.cut)]
    return pd.DataFrame({"tree": nodes.tree, "node": nodes.node, "feature": [cols[f] if f >= 0 else None for f in nodes.feature],
                         "threshold": where, "value": np.where(inner, np.nan, nodes.value * scale)})


def _fitted(X: np.ndarray, y: np.ndarray, number: np.ndarray, cols: list[str], model: str) -> pd.DataFrame:
    """Parameters of one model."""
    if model == "logistic_regression":
        if y.min() == y.max():      # one class: an intercept far on its side
            beta = np.concatenate([[35.0 if y[0] else -35.0], np.zeros(len(cols))])
        else:
            beta = fit_logistic(X, y)
        return pd.DataFrame({"tree": -1, "node": 0, "feature": ["", *cols], "threshold": np.nan, "value": beta})
    cuts = trees.cut_points(X)
    codes, everyone = trees.binned(X, cuts), np.ones(len(y), bool)
    if model == "random_forest":
        _, nodes = trees.forest(codes, y, everyone, number)
        return _nodes(nodes, cols, cuts)
    if model == "xgboost":
        p, kept = trees.Boosted(), []
        trees.boost(codes, y, everyone, number, [p], 0, p.rounds, keep=kept)
        return pd.concat([_nodes(n.assign(tree=t), cols, cuts, p.rate) for _, t, n in kept], ignore_index=True)
    raise ValueError(f"unknown model {model!r}")


def fit_models(prepared: DataFrame, cols: list[str], chosen: DataFrame | str, group=("ticker",), ts: str = "timestamp") -> DataFrame:
    """(group..., model, tree, node, feature, threshold, value): parameters of each group's model.

    ``chosen``: one model name, or a table (group..., model) as J12 gives it.
    """
    group = list(group)
    rows = prepared.select(*group, ts, "target", *cols)
    rows = rows.withColumn("model", F.lit(chosen)) if isinstance(chosen, str) else rows.join(chosen.select(*group, "model"), group)
    schema = ", ".join([f"`{g}` {t}" for g, t in rows.select(*group).dtypes] + [_PARAMS])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > MAX_ROWS:
            raise ValueError(f"a group has {len(pdf)} rows, more than {MAX_ROWS}: fit it with models.refit")
        pdf = pdf.sort_values(ts, kind="stable")
        out = _fitted(pdf[cols].to_numpy(float), pdf["target"].to_numpy(float), np.arange(len(pdf)), cols, pdf["model"].iloc[0])
        return out.assign(model=pdf["model"].iloc[0], **{g: pdf[g].iloc[0] for g in group})[
            [*group, "model", "tree", "node", "feature", "threshold", "value"]]

    return trees.spread(rows, [*group, "model"]).groupBy(*group, "model").applyInPandas(run, schema)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/preparation"), spark.read.parquet(f"{path}/parameters")


def _probability(X: np.ndarray, cols: list[str], params: pd.DataFrame) -> np.ndarray:
    """Probability of label 1 of prepared rows."""
    model = params["model"].iloc[0]
    at = {c: i for i, c in enumerate(cols)}
    if model == "logistic_regression":
        z = np.zeros(len(X))
        for f, v in zip(params["feature"], params["value"]):
            z += v if not f else v * X[:, at[f]]
        return trees.sigmoid(z)
    total = np.zeros(len(X))
    for _, tree in params.groupby("tree", sort=True):
        inner = tree["feature"].notna().to_numpy()
        key = tree["node"].to_numpy()
        order = np.argsort(key)
        key, inner = key[order], inner[order]
        feature = np.array([at[f] if ok else -1 for f, ok in zip(tree["feature"].to_numpy()[order], inner)])
        threshold, value = tree["threshold"].to_numpy()[order], tree["value"].to_numpy()[order]
        node = np.ones(len(X), np.int64)
        place = np.searchsorted(key, node)
        while inner[place].any():
            go = inner[place]
            over = X[np.arange(len(X)), np.maximum(feature[place], 0)] > threshold[place]
            node = np.where(go, 2 * node + over, node)
            place = np.searchsorted(key, node)
        total += value[place]
    return trees.sigmoid(total) if model == "xgboost" else total / params["tree"].nunique()


def probabilities(prepared: DataFrame, parameters: DataFrame, cols: list[str], group=("ticker",), ts: str = "timestamp") -> DataFrame:
    """(group..., ts, model, y_prob, y_pred) of prepared rows under the parameters of their group."""
    group = list(group)
    rows = prepared.select(*group, ts, *cols)
    types = dict(rows.dtypes)
    schema = ", ".join([f"`{g}` {types[g]}" for g in group] + [f"`{ts}` {types[ts]}", "model string, y_prob double, y_pred int"])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = [*group, ts, "model", "y_prob", "y_pred"]
        if left.empty or right.empty:
            return pd.DataFrame(columns=names)
        prob = _probability(left[cols].to_numpy(float), cols, right)
        return left[[*group, ts]].assign(model=right["model"].iloc[0], y_prob=prob, y_pred=(prob > 0.5).astype("int32"))[names]

    return rows.groupBy(*group).cogroup(parameters.groupBy(*group)).applyInPandas(run, schema)


def predict(features: DataFrame, preparation: DataFrame, parameters: DataFrame, version: str, group=("ticker",),
            ts: str = "timestamp") -> DataFrame:
    """Features -> saved preparation -> saved model; UP/DOWN, confidence = the larger class probability (4 places)."""
    group = list(group)
    names = preparation.select(F.col("features.feature").alias("f")).limit(1).collect()
    cols = list(names[0]["f"]) if names else []
    prob = probabilities(apply_preparation(features, preparation, group), parameters, cols, group, ts)
    return prob.select(*group, ts, F.when(F.col("y_pred") == 1, "UP").otherwise("DOWN").alias("predicted_direction"),
                       F.round(F.greatest("y_prob", 1 - F.col("y_prob")), 4).alias("confidence"),
                       F.lit(version).alias("model_version"), F.col("model").alias("model_name"))


def refit(train: DataFrame, cols: list[str], chosen: DataFrame | str, path: str, group=("ticker",), ts: str = "timestamp") -> None:
    """Preparation and model of every group on all its rows (repeated rows once), saved under ``path``."""
    rows = train.select(*group, ts, "target", *cols).dropDuplicates()
    preparation = fit_preparation(rows, cols, group)
    preparation.write.mode("errorifexists").parquet(f"{path}/preparation")
    saved = train.sparkSession.read.parquet(f"{path}/preparation")      # the numbers as serving will read them
    fit_models(apply_preparation(rows, saved, group), cols, chosen, group, ts).write.mode("errorifexists").parquet(f"{path}/parameters")
