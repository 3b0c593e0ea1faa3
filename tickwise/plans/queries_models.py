"""Registered queries: models of all folds (J9-J12), refit with saved preparation (J13, J15), prediction with reuse (K6),
backtest of a fitted model (J18), imputation strategies (J2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise.operators import backtest as bt
from tickwise.operators import folds as fo
from tickwise.operators import indicators as ind
from tickwise.operators import models, prep, refit, scoring, trees
from tickwise.operators.series import number_rows
from tickwise.plans.catalog import FEATURES_CTE, register
from tickwise.plans.queries_ml import _F11, _RULE, TRAIN_NUM, _gaps_sql, _prep_sql, _prepared, _train, _with_gaps
from tickwise.session import checkpoint_dir, materialize
from tickwise.sources.tables import bars

_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _rounded_metrics(m, *names):
    return m.select(*names, *[F.round(c, 6).alias(c) for c in _METRICS])


@register("J9_forest_fold_metrics")
def j9_forest_fold_metrics(spark, sf_dir):
    """A forest of 100 trees for every (ticker, fold); D12/D13 on its test rows."""
    preds = trees.forest_predictions(_prepared(spark, sf_dir), _F11)
    return _rounded_metrics(models.fold_metrics(preds), "ticker", "fold", "model")


@register("J10_boosted_fold_metrics")
def j10_boosted_fold_metrics(spark, sf_dir):
    """100 rounds of boosted trees for every (ticker, fold); D12/D13 on its test rows."""
    preds = trees.boosted_predictions(_prepared(spark, sf_dir), _F11)
    return _rounded_metrics(models.fold_metrics(preds), "ticker", "fold", "model")


@register("J11_parameter_search")
def j11_parameter_search(spark, sf_dir):
    """50 draws for every (ticker, fold) by successive halving, scored on the last fifth of its training rows."""
    found = trees.search(_prepared(spark, sf_dir), _F11)
    return found.select("ticker", "fold", "best_draw", "rounds", "depth", *[F.round(c, 6).alias(c) for c in (
        "best_f1", "rate", "rows", "features", "least_weight", "least_gain")])


def _all_metrics(spark, sf_dir):
    """Fold metrics of the three models and the rule."""
    preds = models.all_fold_predictions(_prepared(spark, sf_dir), _F11)
    test = fo.assign_folds(_train(spark, sf_dir)).filter(F.col("split") == "test")
    rule = bt.rule_scorer(test).select("ticker", "fold", "rn", F.col("target").alias("y_true"), "y_pred", "y_prob",
                                       F.lit("rule_macd").alias("model"))
    return models.fold_metrics(preds.unionByName(rule))


@register("J12_model_selection")
def j12_model_selection(spark, sf_dir):
    """Logistic regression, forest, boosted trees and the rule over all folds; mean metrics per
    (ticker, model) and the best model by mean F1."""
    best = models.select_best(_all_metrics(spark, sf_dir), ["ticker"])
    return _rounded_metrics(best, "ticker", "model", "folds", "best_model")


# rules that stand for models: their metrics, means and choice can be told in SQL
_RULES = {"logistic_regression": "macd > macd_signal", "random_forest": "rsi_14 < 50", "xgboost": "return_1d > 0", "other": "sma_50 > sma_200"}


@register("J12_F7_selection_of_rules", f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
f AS (SELECT *, unnest(generate_series(CAST(greatest(0, ceil((rn - 272) / 21.0)) AS BIGINT),
                                       CAST(least(floor(rn / 21.0), floor((n - 273) / 21.0)) AS BIGINT))) AS fold
      FROM tn WHERE n >= 273),
t AS ({" UNION ALL ".join(f"SELECT ticker, fold, '{m}' AS model, {i} AS place, target AS y, CAST({r} AS INTEGER) AS p FROM f WHERE rn - fold * 21 >= 252" for i, (m, r) in enumerate(_RULES.items()))}),
c AS (SELECT ticker, fold, model, place, avg(CAST(y = p AS INTEGER)) AS accuracy, count(*) FILTER (WHERE p = 1 AND y = 1) AS tp,
             count(*) FILTER (WHERE p = 1) AS pp, count(*) FILTER (WHERE y = 1) AS yy FROM t GROUP BY 1, 2, 3, 4),
m AS (SELECT ticker, model, place, count(*) AS folds, avg(accuracy) AS accuracy, avg(coalesce(tp / nullif(pp, 0), 0)) AS precision,
             avg(coalesce(tp / nullif(yy, 0), 0)) AS recall, avg(CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (pp + yy) END) AS f1
      FROM c GROUP BY 1, 2, 3),
b AS (SELECT ticker, model AS best_model FROM (SELECT ticker, model, row_number() OVER (PARTITION BY ticker ORDER BY round(f1, 10) DESC, place) AS k FROM m) WHERE k = 1)
SELECT m.ticker, model, folds, best_model, round(accuracy, 8) AS accuracy, round(precision, 8) AS precision, round(recall, 8) AS recall,
       round(f1, 8) AS f1 FROM m JOIN b ON m.ticker = b.ticker
""")
def j12_selection_of_rules(spark, sf_dir):
    """J12 and F7 on four rules in the models' places: fold metrics, their means, the best one and the order of ties."""
    test = fo.assign_folds(_train(spark, sf_dir)).filter(F.col("split") == "test")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(r).cast("int").alias("y_pred")) for m, r in _RULES.items()])
    scored = test.select("ticker", "fold", F.col("target").alias("y_true"), F.explode(rules).alias("r")).select("ticker", "fold", "y_true", "r.*")
    from tickwise.operators.metrics import confusion_metrics
    m = confusion_metrics(scored, ["ticker", "fold", "model"]).withColumn("roc_auc", F.lit(0.5))
    best = models.select_best(m.withColumn("f1", F.round("f1", 12)), ["ticker"])
    return best.select("ticker", "model", "folds", "best_model", *[F.round(c, 8).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def _latest(spark, sf_dir):
    b = bars(spark, sf_dir)
    return scoring.latest_feature_rows(b, ind.technical_features(b, keep_warmup=False, checkpoint=False))


_LATEST_CTE = """l0 AS (SELECT ticker, timestamp, close, rn, n FROM s WHERE rn >= n - 30),
l1 AS (SELECT *, close / nullif(lag(close, 1) OVER w, 0) - 1 AS r1, close / nullif(lag(close, 3) OVER w, 0) - 1 AS r3,
              close / nullif(lag(close, 5) OVER w, 0) - 1 AS r5, ln(close / nullif(lag(close, 1) OVER w, 0)) AS lr
       FROM l0 WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)),
l2 AS (SELECT *, CASE WHEN count(lr) OVER w20 >= 20 THEN stddev_samp(lr) OVER w20 * sqrt(252) END AS vol
       FROM l1 WINDOW w20 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
lf AS (SELECT l2.ticker, l2.timestamp, l2.close, i.rsi_14, i.macd, i.macd_signal, i.bollinger_upper, i.bollinger_lower, i.sma_50, i.sma_200,
              coalesce(r1, 0) AS return_1d, coalesce(r3, 0) AS return_3d, coalesce(r5, 0) AS return_5d, coalesce(vol, 0) AS volatility_20d
       FROM l2 JOIN ind i ON l2.ticker = i.ticker AND l2.timestamp = i.timestamp WHERE l2.rn = l2.n - 1)"""


def _saved_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in _F11)
    cap = ", ".join(f"least(greatest({c}, q1_{c} - 1.5 * (q3_{c} - q1_{c})), q3_{c} + 1.5 * (q3_{c} - q1_{c})) AS {c}" for c in _F11)
    st = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS m_{c}, stddev_pop({c}) AS sd_{c}" for c in _F11)
    out = ", ".join(f"round((least(greatest({c}, lo_{c}), hi_{c}) - m_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END, 6) AS {c}" for c in _F11)
    return f"""
WITH RECURSIVE {FEATURES_CTE}, {_LATEST_CTE},
q AS (SELECT ticker, {q} FROM train GROUP BY 1),
k AS (SELECT train.ticker, {cap} FROM train JOIN q ON train.ticker = q.ticker),
st AS (SELECT ticker, {st} FROM k GROUP BY 1)
SELECT lf.ticker, lf.timestamp, {out} FROM lf JOIN st ON lf.ticker = st.ticker"""


@register("J13_J15_prepared_latest", _saved_sql())
def j13_prepared_latest(spark, sf_dir):
    """The preparation fitted on all training rows of a ticker, saved, read again and applied to its latest row."""
    path = f"{checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    refit.fit_preparation(_train(spark, sf_dir), _F11).write.parquet(path)
    out = refit.apply_preparation(_latest(spark, sf_dir), spark.read.parquet(path))
    return out.select("ticker", "timestamp", *[F.round(c, 6).alias(c) for c in _F11])


@register("J15_K6_predict_latest")
def j15_predict_latest(spark, sf_dir):
    """Every ticker's best model refitted on all its rows, saved with its preparation, read again
    and applied to the latest rows."""
    best = models.select_best(_all_metrics(spark, sf_dir).filter(F.col("model") != "rule_macd"), ["ticker"])
    chosen = materialize(best.filter(F.col("model") == F.col("best_model")).select("ticker", "model"))
    path = f"{checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    refit.refit(_train(spark, sf_dir), _F11, chosen, path)
    return refit.predict(_latest(spark, sf_dir), *refit.load(spark, path), version="v1")


@register("K6_prediction_reuse", f"""
WITH RECURSIVE {FEATURES_CTE}, {_LATEST_CTE},
stored AS (SELECT ticker, timestamp, max(timestamp) OVER () AS top, row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) AS k FROM ind),
reused AS (SELECT ticker, timestamp FROM stored WHERE k = 1 AND timestamp > top - INTERVAL 30 minute),
p AS (SELECT ticker, timestamp {_RULE} FROM lf)
SELECT p.ticker, p.timestamp, CASE WHEN r.ticker IS NOT NULL THEN 'STORED' WHEN y_pred = 1 THEN 'UP' ELSE 'DOWN' END AS predicted_direction,
       CASE WHEN r.ticker IS NOT NULL THEN 0.5 ELSE round(greatest(y_prob, 1 - y_prob), 4) END AS confidence,
       CASE WHEN r.ticker IS NOT NULL THEN 'old' ELSE 'new' END AS model_version, r.ticker IS NOT NULL AS reused
FROM p LEFT JOIN reused r ON p.ticker = r.ticker
""")
def k6_prediction_reuse(spark, sf_dir):
    """K6 with reuse: stored predictions (one per feature row, stamped with the bar's time) younger than an hour at 30
    minutes after the last bar are returned as stored; the rule scores the other tickers."""
    b = bars(spark, sf_dir)
    feats = ind.technical_features(b, keep_warmup=False)
    stored = feats.select("ticker", "timestamp", F.col("timestamp").cast("timestamp").alias("predicted_at"), F.lit("STORED").alias("predicted_direction"),
                          F.lit(0.5).alias("confidence"), F.lit("old").alias("model_version"), F.lit("rule_macd").alias("model_name"))

    def scorer(rows):
        return bt.rule_scorer(rows).select(
            "ticker", "timestamp", F.when(F.col("y_pred") == 1, "UP").otherwise("DOWN").alias("predicted_direction"),
            F.round(F.greatest("y_prob", 1 - F.col("y_prob")), 4).alias("confidence"), F.lit("new").alias("model_version"), F.lit("rule_macd").alias("model_name"))

    now = b.agg(F.max("timestamp").alias("t")).scalar() + F.expr("INTERVAL 30 MINUTES")
    out = scoring.predict_or_reuse(scoring.latest_feature_rows(b, feats), stored, now, scorer)
    return out.drop("model_name")


@register("J18_backtest_boosted")
def j18_backtest_boosted(spark, sf_dir):
    """J18 of a fitted model: boosted trees and their preparation fitted on each ticker's rows before the tail, applied to the tail."""
    frame = _train(spark, sf_dir)
    numbered = number_rows(frame)
    earlier = numbered.filter(F.col("rn") < F.col("n") - fo.BACKTEST_DAYS)
    preparation = materialize(refit.fit_preparation(earlier, _F11))
    parameters = materialize(refit.fit_models(refit.apply_preparation(earlier, preparation), _F11, "xgboost"))

    def scorer(tail):
        prob = refit.probabilities(refit.apply_preparation(tail, preparation), parameters, _F11)
        return tail.join(prob.drop("model"), ["ticker", "timestamp"])

    return bt.backtest(frame, scorer)


_STRATEGY_SQL = _gaps_sql()


def _impute_sql(strategy: str) -> str:
    """Rows after J3 and J2 by their definitions, from the steps g0 to g3 of the folds with gaps."""
    upto = _STRATEGY_SQL[:_STRATEGY_SQL.index("g4 AS")].rstrip().rstrip(",")
    head = _prep_sql(False)
    base = head[:head.index("g5 AS")]
    null, every = "return_1d", "PARTITION BY ticker, fold"
    fill = {"median": f"quantile_cont(CASE WHEN split = 'train' THEN {null} END, 0.5) OVER ({every})",
            "mean": f"avg(CASE WHEN split = 'train' THEN {null} END) OVER ({every})", "zero": "0.0", "drop": "NULL"}[strategy]
    keep = f"WHERE {null} IS NOT NULL" if strategy == "drop" else ""
    return f"""{base}{upto},
h AS (SELECT ticker, fold, split, rn, {null} AS before, coalesce({null}, {fill}) AS {null} FROM g3),
d AS (SELECT ticker, fold, split, count(*) FILTER (WHERE before IS NULL) AS touched FROM h GROUP BY 1, 2, 3),
k AS (SELECT ticker, fold, split, count(*) AS n_rows, round(sum({null}), 6) AS total FROM h {keep} GROUP BY 1, 2, 3)
SELECT k.ticker, k.fold, k.split, n_rows, touched, total FROM k JOIN d ON k.ticker = d.ticker AND k.fold = d.fold AND k.split = d.split"""


def _impute_query(strategy: str):
    def run(spark, sf_dir):
        group = ["ticker", "fold"]
        rows = _with_gaps(fo.assign_folds(_train(spark, sf_dir)))
        filled = prep.fix_infinite(rows.select(*group, "split", "rn", *_F11), _F11, group)
        out = prep.impute(filled, _F11, group, strategy)
        touched = prep.imputed_counts(filled, _F11, group + ["split"], strategy)
        kept = out.groupBy(*group, "split").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("return_1d"), 6).alias("total"))
        return kept.join(touched.withColumnRenamed("imputed", "touched"), group + ["split"])
    run.__doc__ = f"J2 with strategy {strategy!r} on folds with nulls: rows left, values filled or rows dropped, sum of the column."
    return run


for _s in ("median", "mean", "zero", "drop"):
    register(f"J2_impute_{_s}", _impute_sql(_s))(_impute_query(_s))
