"""Registered queries: risk, metrics, folds, preparation, backtest, models (K4, D8-D14, E9-E15, J)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwise.operators import backtest as bt
from tickwise.operators import folds as fo
from tickwise.operators import metrics as me
from tickwise.operators import risk
from tickwise.operators.training import training_frame
from tickwise.plans.catalog import BARS_CTE, FEATURES_CTE, ORACLES, SERIES_CTE, register
from tickwise.sources.tables import bars, table


def portfolio_requests(spark, sf_dir):
    """Stand-in request table: one portfolio per nation, weights = order share per
    priority rounded to 2 places (so some portfolios miss the sum-to-1 rule)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cnt = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
           .groupBy(F.col("n_name").alias("portfolio_id"), F.col("o_orderpriority").alias("t"))
           .agg(F.count(F.lit(1)).alias("c")))
    tot = F.sum("c").over(Window.partitionBy("portfolio_id"))
    # share rounded half-up to 2 places in exact integer arithmetic
    w = cnt.withColumn("w", F.floor((200 * F.col("c") + tot) / (2 * tot)) / 100.0)
    agg = w.groupBy("portfolio_id").agg(F.sort_array(F.collect_list(F.struct("t", "w"))).alias("l"))
    return agg.select("portfolio_id", F.array_join(F.col("l.t"), ",").alias("tickers"),
                      F.array_join(F.transform("l.w", lambda x: x.cast("string")), ",").alias("weights"))


REQUESTS_CTE = """p0 AS (SELECT n_name AS portfolio_id, o_orderpriority AS t, count(*) AS c
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
p1 AS (SELECT portfolio_id, t, floor((200 * c + sum(c) OVER (PARTITION BY portfolio_id))
                                   / (2 * sum(c) OVER (PARTITION BY portfolio_id))) / 100.0 AS w FROM p0),
req AS (SELECT portfolio_id, string_agg(t, ',' ORDER BY t) AS tickers,
               string_agg(CAST(w AS VARCHAR), ',' ORDER BY t) AS weights FROM p1 GROUP BY 1),
pos AS (SELECT portfolio_id, i - 1 AS pos, upper(trim(string_split(tickers, ',')[i])) AS ticker,
               TRY_CAST(trim(string_split(weights, ',')[i]) AS DOUBLE) AS weight,
               len(string_split(tickers, ',')) AS nt, len(string_split(weights, ',')) AS nw
        FROM req, LATERAL generate_series(1, least(len(string_split(tickers, ',')), len(string_split(weights, ',')))) g(i)),
ws AS (SELECT portfolio_id, len(string_split(tickers, ',')) AS nt, len(string_split(weights, ',')) AS nw,
              list_reduce(list_transform(string_split(weights, ','), lambda x: TRY_CAST(trim(x) AS DOUBLE)),
                          lambda a, b: a + b) AS weight_sum FROM req),
chk AS (SELECT portfolio_id, weight_sum,
          CASE WHEN nt <> nw THEN 'Number of tickers must match weights'
               WHEN abs(weight_sum - 1.0) > 0.01 THEN 'Weights must sum to 1.0' END AS error
        FROM ws)"""

RETURNS_CTE = SERIES_CTE + """,
rr AS (SELECT ticker, rn, n, close / lag(close) OVER (PARTITION BY ticker ORDER BY timestamp) - 1 AS r FROM s),
rets AS (SELECT ticker, CAST(rn - (n - least(n - 1, 252)) AS INTEGER) AS pos, r FROM rr
         WHERE rn >= n - least(n - 1, 252) AND rn >= 1)"""


@register("E15_recent_returns", f"""
WITH {RETURNS_CTE}
SELECT ticker, pos, round(r, 10) AS r FROM rets
""")
def e15_recent_returns(spark, sf_dir):
    return risk.recent_returns(bars(spark, sf_dir)).select("ticker", "pos", F.round("r", 10).alias("r"))


@register("D8_D9_ticker_risk", f"""
WITH {RETURNS_CTE}
SELECT ticker, count(*) AS n_returns, round(stddev_pop(r) * sqrt(252), 6) AS annual_volatility,
       round(quantile_cont(r, 0.05), 8) AS var_95, round(quantile_cont(r, 0.01), 8) AS var_99,
       round(avg(r) * 252, 6) AS expected_return
FROM rets GROUP BY ticker
""")
def d8_d9_ticker_risk(spark, sf_dir):
    r = risk.recent_returns(bars(spark, sf_dir))
    return r.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_returns"),
        F.round(F.stddev_pop("r") * risk.SQRT_252, 6).alias("annual_volatility"),
        F.round(F.percentile("r", 0.05), 8).alias("var_95"),
        F.round(F.percentile("r", 0.01), 8).alias("var_99"),
        F.round(F.avg("r") * 252, 6).alias("expected_return"))


@register("D10_D11_D23_ticker_performance", f"""
WITH {RETURNS_CTE},
c AS (SELECT ticker, pos, r, product(1 + r) OVER w AS equity FROM rets
      WINDOW w AS (PARTITION BY ticker ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT *, (equity - max(equity) OVER w) / max(equity) OVER w AS drawdown FROM c
      WINDOW w AS (PARTITION BY ticker ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT ticker, round(coalesce(avg(r) / nullif(stddev_pop(r), 0) * sqrt(252), 0), 6) AS sharpe_ratio,
       round(product(1 + r) - 1, 6) AS total_return, round(min(drawdown), 6) AS max_drawdown
FROM d GROUP BY ticker
""")
def d10_d11_d23(spark, sf_dir):
    r = risk.recent_returns(bars(spark, sf_dir))
    c = risk.drawdown_curve(r, ["ticker"], "pos")
    return c.groupBy("ticker").agg(F.round(risk.sharpe(F.col("r")), 6).alias("sharpe_ratio"),
                                   F.round(risk.total_return(F.col("r")), 6).alias("total_return"),
                                   F.round(F.min("drawdown"), 6).alias("max_drawdown"))


@register("E9_drawdown_curve", f"""
WITH {RETURNS_CTE},
c AS (SELECT ticker, pos, product(1 + r) OVER w AS equity FROM rets
      WINDOW w AS (PARTITION BY ticker ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT ticker, pos, round(equity, 8) AS equity,
       round((equity - max(equity) OVER w) / max(equity) OVER w, 8) AS drawdown
FROM c WINDOW w AS (PARTITION BY ticker ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def e9_drawdown_curve(spark, sf_dir):
    c = risk.drawdown_curve(risk.recent_returns(bars(spark, sf_dir)), ["ticker"], "pos")
    return c.select("ticker", "pos", F.round("equity", 8).alias("equity"),
                    F.round("drawdown", 8).alias("drawdown"))


@register("B7_portfolio_positions", f"""
WITH {REQUESTS_CTE}
SELECT pos.portfolio_id, CAST(pos AS INTEGER) AS pos, ticker, weight, CAST(nt AS INTEGER) AS n_tickers,
       CAST(nw AS INTEGER) AS n_weights, chk.weight_sum, chk.error
FROM pos JOIN chk ON pos.portfolio_id = chk.portfolio_id
""")
def b7_portfolio_positions(spark, sf_dir):
    p = risk.parse_portfolios(portfolio_requests(spark, sf_dir))
    return p.select("portfolio_id", "pos", "ticker", "weight", "n_tickers", "n_weights",
                    "weight_sum", "error")


@register("K4_portfolio_risk", f"""
WITH {RETURNS_CTE}, {REQUESTS_CTE},
tk AS (SELECT ticker, count(*) AS n_returns FROM rets GROUP BY 1),
err AS (SELECT c.portfolio_id,
          coalesce(c.error, max(CASE WHEN tk.ticker IS NULL THEN 'No price data for ticker ' || pos.ticker END)) AS error
        FROM chk c JOIN pos ON c.portfolio_id = pos.portfolio_id LEFT JOIN tk ON pos.ticker = tk.ticker
        GROUP BY c.portfolio_id, c.error),
ml AS (SELECT pos.portfolio_id, min(tk.n_returns) AS len FROM pos JOIN tk ON pos.ticker = tk.ticker
       JOIN err ON err.portfolio_id = pos.portfolio_id WHERE err.error IS NULL GROUP BY 1),
pr AS (SELECT pos.portfolio_id, rets.pos, sum(pos.weight * rets.r) AS r
       FROM pos JOIN ml ON pos.portfolio_id = ml.portfolio_id JOIN rets ON rets.ticker = pos.ticker
       WHERE rets.pos < ml.len GROUP BY 1, 2),
cu AS (SELECT portfolio_id, pos, r, product(1 + r) OVER w AS equity FROM pr
       WINDOW w AS (PARTITION BY portfolio_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
dd AS (SELECT *, (equity - max(equity) OVER w) / max(equity) OVER w AS drawdown FROM cu
       WINDOW w AS (PARTITION BY portfolio_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT portfolio_id, round(quantile_cont(r, 0.05), 6) AS var_95, round(quantile_cont(r, 0.01), 6) AS var_99,
             round(avg(r) * 252, 4) AS expected_return, round(min(drawdown), 4) AS max_drawdown,
             round(stddev_pop(r) * sqrt(252), 4) AS annual_volatility FROM dd GROUP BY 1)
SELECT err.portfolio_id, err.error, m.var_95, m.var_99, m.expected_return, m.max_drawdown, m.annual_volatility
FROM err LEFT JOIN m ON err.portfolio_id = m.portfolio_id
""")
def k4_portfolio_risk(spark, sf_dir):
    port, _ = risk.portfolio_risk(bars(spark, sf_dir), portfolio_requests(spark, sf_dir))
    return port


def _k4_by_date_sql() -> str:
    sql = ORACLES["K4_portfolio_risk"]
    sql = sql.replace("SELECT ticker, rn, n, close / lag", "SELECT ticker, timestamp, rn, n, close / lag")
    sql = sql.replace("AS pos, r FROM rr", "AS pos, timestamp, r FROM rr")
    a, b = sql.index("ml AS (SELECT"), sql.index("cu AS (SELECT")
    return sql[:a] + """held AS (SELECT portfolio_id, count(*) AS k FROM pos GROUP BY 1),
pr AS (SELECT pos.portfolio_id, rets.timestamp AS pos, sum(pos.weight * rets.r) AS r
       FROM pos JOIN err ON err.portfolio_id = pos.portfolio_id JOIN held ON held.portfolio_id = pos.portfolio_id
       JOIN rets ON rets.ticker = pos.ticker WHERE err.error IS NULL
       GROUP BY pos.portfolio_id, rets.timestamp, held.k HAVING count(*) = held.k),
""" + sql[b:]


@register("K4_portfolio_risk_by_date", _k4_by_date_sql())
def k4_portfolio_risk_by_date(spark, sf_dir):
    """K4 with returns aligned on common dates."""
    port, _ = risk.portfolio_risk(bars(spark, sf_dir), portfolio_requests(spark, sf_dir), by="date")
    return port


@register("K4_individual_risk", f"""
WITH {RETURNS_CTE}, {REQUESTS_CTE},
tk AS (SELECT ticker, stddev_pop(r) * sqrt(252) AS v, quantile_cont(r, 0.05) AS q, avg(r) * 252 AS e FROM rets GROUP BY 1),
bad AS (SELECT DISTINCT pos.portfolio_id FROM pos LEFT JOIN tk ON pos.ticker = tk.ticker WHERE tk.ticker IS NULL)
SELECT pos.portfolio_id, CAST(pos.pos AS INTEGER) AS pos, pos.ticker, pos.weight, round(tk.v, 4) AS annual_volatility,
       round(tk.q, 6) AS var_95, round(tk.e, 4) AS expected_return
FROM pos JOIN chk ON pos.portfolio_id = chk.portfolio_id JOIN tk ON pos.ticker = tk.ticker
WHERE chk.error IS NULL AND pos.portfolio_id NOT IN (SELECT portfolio_id FROM bad)
""")
def k4_individual_risk(spark, sf_dir):
    _, ind = risk.portfolio_risk(bars(spark, sf_dir), portfolio_requests(spark, sf_dir))
    return ind


# ---------------------------------------------------------------- folds and backtest
def _train(spark, sf_dir):
    return training_frame(bars(spark, sf_dir))


TRAIN_NUM = """tn AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY timestamp) - 1 AS rn,
                     count(*) OVER (PARTITION BY ticker) AS n FROM train)"""


@register("E13_walk_forward_folds", f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
f AS (SELECT ticker, timestamp, rn, n, unnest(generate_series(
        CAST(greatest(0, ceil((rn - 272) / 21.0)) AS BIGINT), CAST(least(floor(rn / 21.0), floor((n - 273) / 21.0)) AS BIGINT))) AS fold
      FROM tn WHERE n >= 273)
SELECT ticker, timestamp, CAST(fold AS INTEGER) AS fold, CASE WHEN rn - fold * 21 < 252 THEN 'train' ELSE 'test' END AS split
FROM f
""")
def e13_walk_forward_folds(spark, sf_dir):
    return fo.assign_folds(_train(spark, sf_dir)).select("ticker", "timestamp", "fold", "split")


@register("E14_holdout_tail", f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM}
SELECT ticker, count(*) AS rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts
FROM tn WHERE rn >= n - 126 GROUP BY ticker
""")
def e14_holdout_tail(spark, sf_dir):
    t = fo.holdout_tail(_train(spark, sf_dir))
    return t.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_ts"),
                                   F.max("timestamp").alias("last_ts"))


_RULE = """, 1.0 / (1.0 + exp(-((macd - macd_signal) / close * 100.0))) AS y_prob,
         CAST(1.0 / (1.0 + exp(-((macd - macd_signal) / close * 100.0))) > 0.5 AS INTEGER) AS y_pred"""


@register("D12_fold_metrics_rule", f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
f AS (SELECT *, unnest(generate_series(CAST(greatest(0, ceil((rn - 272) / 21.0)) AS BIGINT),
                                       CAST(least(floor(rn / 21.0), floor((n - 273) / 21.0)) AS BIGINT))) AS fold
      FROM tn WHERE n >= 273),
t AS (SELECT ticker, fold, target AS y_true {_RULE} FROM f WHERE rn - fold * 21 >= 252),
g AS (SELECT ticker, CAST(fold AS INTEGER) AS fold,
        count(*) FILTER (WHERE y_pred = 1 AND y_true = 1) AS tp, count(*) FILTER (WHERE y_pred = 1 AND y_true = 0) AS fp,
        count(*) FILTER (WHERE y_pred = 0 AND y_true = 1) AS fn, count(*) FILTER (WHERE y_pred = 0 AND y_true = 0) AS tn,
        count(*) AS n FROM t GROUP BY 1, 2)
SELECT ticker, fold, tp, fp, fn, tn, n, round((tp + tn) / n, 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * coalesce(tp / nullif(tp + fp, 0), 0) * coalesce(tp / nullif(tp + fn, 0), 0)
             / nullif(coalesce(tp / nullif(tp + fp, 0), 0) + coalesce(tp / nullif(tp + fn, 0), 0), 0), 0), 6) AS f1
FROM g
""")
def d12_fold_metrics_rule(spark, sf_dir):
    f = fo.assign_folds(_train(spark, sf_dir)).filter(F.col("split") == "test")
    scored = bt.rule_scorer(f).withColumnRenamed("target", "y_true")
    m = me.confusion_metrics(scored, ["ticker", "fold"])
    return m.select("ticker", "fold", "tp", "fp", "fn", "tn", "n",
                    *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("D13_roc_auc_rule", f"""
WITH RECURSIVE {FEATURES_CTE},
t AS (SELECT ticker, target AS y_true {_RULE} FROM train),
rk AS (SELECT ticker, y_true, rank() OVER (PARTITION BY ticker ORDER BY y_prob)
              + (count(*) OVER (PARTITION BY ticker, y_prob) - 1) / 2.0 AS ar FROM t),
g AS (SELECT ticker, sum(ar) FILTER (WHERE y_true = 1) AS rs, count(*) FILTER (WHERE y_true = 1) AS n1,
             count(*) FILTER (WHERE y_true = 0) AS n0 FROM rk GROUP BY 1)
SELECT ticker, round(CASE WHEN n1 = 0 OR n0 = 0 THEN 0.5 ELSE (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0) END, 8) AS roc_auc
FROM g
""")
def d13_roc_auc_rule(spark, sf_dir):
    s = bt.rule_scorer(_train(spark, sf_dir)).withColumnRenamed("target", "y_true")
    return me.roc_auc(s, ["ticker"]).select("ticker", F.round("roc_auc", 8).alias("roc_auc"))


@register("D13_roc_auc_one_group", """
WITH t AS (SELECT l_extendedprice + l_linenumber AS p, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem),
rk AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS ar FROM t),
g AS (SELECT sum(ar) FILTER (WHERE y = 1) AS rs, count(*) FILTER (WHERE y = 1) AS n1, count(*) FILTER (WHERE y = 0) AS n0 FROM rk)
SELECT 'all' AS grp, round((rs - n1 * (n1 + 1) / 2.0) / (CAST(n1 AS DOUBLE) * n0), 8) AS roc_auc FROM g
""")
def d13_roc_auc_one_group(spark, sf_dir):
    """D13 with one group that holds all rows: return flag R told from the line's price."""
    s = table(spark, sf_dir, "lineitem").select(
        F.lit("all").alias("grp"), (F.col("l_extendedprice") + F.col("l_linenumber")).alias("y_prob"), (F.col("l_returnflag") == "R").cast("int").alias("y_true"))
    return me.roc_auc(s, ["grp"]).select("grp", F.round("roc_auc", 8).alias("roc_auc"))


_FIVE = ("accuracy", "precision", "recall", "f1", "roc_auc")


@register("D14_mean_fold_metrics_rule", f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
f AS (SELECT *, unnest(generate_series(CAST(greatest(0, ceil((rn - 272) / 21.0)) AS BIGINT),
                                       CAST(least(floor(rn / 21.0), floor((n - 273) / 21.0)) AS BIGINT))) AS fold
      FROM tn WHERE n >= 273),
t AS (SELECT ticker, fold, target AS y_true {_RULE} FROM f WHERE rn - fold * 21 >= 252),
c AS (SELECT ticker, fold, count(*) FILTER (WHERE y_pred = 1 AND y_true = 1) AS tp, count(*) FILTER (WHERE y_pred = 1 AND y_true = 0) AS fp,
             count(*) FILTER (WHERE y_pred = 0 AND y_true = 1) AS fn, avg(CAST(y_pred = y_true AS INTEGER)) AS accuracy,
             count(*) FILTER (WHERE y_true = 1) AS n1, count(*) FILTER (WHERE y_true = 0) AS n0 FROM t GROUP BY 1, 2),
rk AS (SELECT ticker, fold, y_true, rank() OVER (PARTITION BY ticker, fold ORDER BY y_prob)
              + (count(*) OVER (PARTITION BY ticker, fold, y_prob) - 1) / 2.0 AS ar FROM t),
rs AS (SELECT ticker, fold, sum(ar) FILTER (WHERE y_true = 1) AS rs FROM rk GROUP BY 1, 2),
m AS (SELECT c.ticker, c.fold, accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
             CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
             CASE WHEN n1 = 0 OR n0 = 0 THEN 0.5 ELSE (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0) END AS roc_auc
      FROM c JOIN rs ON c.ticker = rs.ticker AND c.fold = rs.fold)
SELECT ticker, count(*) AS n_items, {", ".join(f"round(avg({x}), 8) AS avg_{x}" for x in _FIVE)}
FROM m WHERE f1 > 0 GROUP BY 1
""")
def d14_mean_fold_metrics_rule(spark, sf_dir):
    """All five metrics over the folds that succeeded (here: those with a hit)."""
    f = fo.assign_folds(_train(spark, sf_dir)).filter(F.col("split") == "test")
    scored = bt.rule_scorer(f).withColumnRenamed("target", "y_true")
    group = ["ticker", "fold"]
    m = me.confusion_metrics(scored, group).join(me.roc_auc(scored, group), group)
    m = m.withColumn("status", F.when(F.col("f1") > 0, "success").otherwise("no_hit"))
    mean = me.mean_metrics(m, ["ticker"], list(_FIVE), status_col="status")
    return mean.select("ticker", "n_items", *[F.round(f"avg_{x}", 8).alias(f"avg_{x}") for x in _FIVE])


_BT_SQL = f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
t AS (SELECT ticker, rn, close, target AS y_true {_RULE} FROM tn WHERE rn >= n - 126 AND n >= 378),
st AS (SELECT *, lead(close) OVER (PARTITION BY ticker ORDER BY rn) / close - 1 AS r FROM t),
s2 AS (SELECT *, r * y_pred AS s FROM st WHERE r IS NOT NULL),
cu AS (SELECT *, product(1 + s) OVER w AS equity FROM s2
       WINDOW w AS (PARTITION BY ticker ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
dd AS (SELECT *, (equity - max(equity) OVER w) / max(equity) OVER w AS drawdown FROM cu
       WINDOW w AS (PARTITION BY ticker ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
perf AS (SELECT ticker, coalesce(avg(s) / nullif(stddev_pop(s), 0) * sqrt(252), 0) AS sharpe_ratio,
                coalesce(min(drawdown), 0) AS max_drawdown, product(1 + s) - 1 AS strategy_total_return,
                coalesce(avg(r) / nullif(stddev_pop(r), 0) * sqrt(252), 0) AS buyhold_sharpe,
                product(1 + r) - 1 AS buyhold_total_return FROM dd GROUP BY 1),
g AS (SELECT ticker, count(*) FILTER (WHERE y_pred = 1 AND y_true = 1) AS tp,
             count(*) FILTER (WHERE y_pred = 1 AND y_true = 0) AS fp,
             count(*) FILTER (WHERE y_pred = 0 AND y_true = 1) AS fn,
             count(*) FILTER (WHERE y_pred = 0 AND y_true = 0) AS tn, count(*) AS n FROM t GROUP BY 1),
m AS (SELECT ticker, (tp + tn) / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS p,
             coalesce(tp / nullif(tp + fn, 0), 0) AS rc FROM g),
res AS (SELECT m.ticker, 'success' AS status, 126 AS backtest_days, round(accuracy, 4) AS accuracy,
          round(p, 4) AS precision, round(rc, 4) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 4) AS f1,
          round(accuracy, 4) AS win_rate, round(sharpe_ratio, 4) AS sharpe_ratio, round(max_drawdown, 4) AS max_drawdown,
          round(strategy_total_return, 4) AS strategy_total_return, round(buyhold_total_return, 4) AS buyhold_total_return,
          round(buyhold_sharpe, 4) AS buyhold_sharpe,
          round(strategy_total_return - buyhold_total_return, 4) AS outperformance, CAST(NULL AS BIGINT) AS rows
        FROM m JOIN perf ON m.ticker = perf.ticker
        UNION ALL
        SELECT ticker, 'insufficient_data', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               max(n) FROM tn GROUP BY ticker HAVING max(n) < 378)"""


@register("J18_backtest_rule", _BT_SQL + "\nSELECT * FROM res")
def j18_backtest_rule(spark, sf_dir):
    return bt.backtest(_train(spark, sf_dir))


@register("J19_backtest_summary_rule", _BT_SQL + """
SELECT count(*) AS tickers_tested, round(avg(accuracy), 4) AS avg_accuracy, round(avg(f1), 4) AS avg_f1,
       round(avg(sharpe_ratio), 4) AS avg_sharpe FROM res WHERE status = 'success'
""")
def j19_backtest_summary_rule(spark, sf_dir):
    return bt.backtest_summary(bt.backtest(_train(spark, sf_dir)))


# ---------------------------------------------------------------- J7 preparation
from tickwise.operators import indicators as _ind  # noqa: E402
from tickwise.operators import prep as _prep  # noqa: E402

_F11 = _ind.FEATURE_COLUMNS


# gaps put into the folds: nulls, infinite values, repeated train rows
_NULLED, _BLOWN = "return_1d", "volatility_20d"


def _gaps_sql() -> str:
    """Steps J3, J2 and G3 between the fold rows (s1) and the outlier cap, from their definitions."""
    head = "ticker, fold, split, rn, timestamp, target"
    others = ", ".join(c for c in _F11 if c not in (_NULLED, _BLOWN))
    same = "PARTITION BY ticker, fold, split ORDER BY rn"
    return f"""
g0 AS (SELECT {head}, {others}, CASE WHEN rn % 17 = 3 THEN NULL ELSE {_NULLED} END AS {_NULLED},
              CASE WHEN rn % 29 = 5 THEN CAST('inf' AS DOUBLE) ELSE {_BLOWN} END AS {_BLOWN} FROM s1),
g1 AS (SELECT * FROM g0 UNION ALL SELECT * FROM g0 WHERE split = 'train' AND rn % 41 = 7),
g2 AS (SELECT {head}, {others}, {_NULLED}, CAST(isinf({_BLOWN}) AS INTEGER) AS was_inf,
              CASE WHEN isinf({_BLOWN}) THEN NULL ELSE {_BLOWN} END AS b FROM g1),
g3 AS (SELECT {head}, {others}, {_NULLED}, was_inf,
              coalesce(b, last_value(b IGNORE NULLS) OVER ({same} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       first_value(b IGNORE NULLS) OVER ({same} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {_BLOWN} FROM g2),
g4 AS (SELECT {head}, {others}, {_BLOWN}, was_inf, CAST({_NULLED} IS NULL AS INTEGER) AS was_null,
              coalesce({_NULLED}, quantile_cont(CASE WHEN split = 'train' THEN {_NULLED} END, 0.5) OVER (PARTITION BY ticker, fold)) AS {_NULLED}
       FROM g3),
g5 AS (SELECT ticker, fold, split, timestamp, target, {", ".join(_F11)}, min(rn) AS rn, count(*) - 1 AS copies,
              min(was_inf + was_null) AS filled
       FROM g4 GROUP BY ticker, fold, split, timestamp, target, {", ".join(_F11)}, CASE WHEN split <> 'train' THEN rn END),"""


def _prep_sql(gaps: bool = False) -> str:
    w = "OVER (PARTITION BY ticker, fold)"
    cap = ", ".join(
        f"""CASE WHEN split = 'train' THEN least(greatest({c}, q1_{c} - 1.5 * (q3_{c} - q1_{c})), q3_{c} + 1.5 * (q3_{c} - q1_{c})) ELSE {c} END AS {c},
        CAST(split = 'train' AND ({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c})) AS INTEGER) AS k_{c}"""
        for c in _F11)
    qs = ", ".join(f"quantile_cont(CASE WHEN split = 'train' THEN {c} END, 0.25) {w} AS q1_{c}, "
                   f"quantile_cont(CASE WHEN split = 'train' THEN {c} END, 0.75) {w} AS q3_{c}" for c in _F11)
    clip = ", ".join(f"CASE WHEN split = 'train' THEN {c} ELSE least(greatest({c}, min(CASE WHEN split = 'train' THEN {c} END) {w}), "
                     f"max(CASE WHEN split = 'train' THEN {c} END) {w}) END AS {c}" for c in _F11)
    scale = ", ".join(f"round(({c} - avg(CASE WHEN split = 'train' THEN {c} END) {w}) / "
                      f"CASE WHEN stddev_pop(CASE WHEN split = 'train' THEN {c} END) {w} = 0 THEN 1 "
                      f"ELSE stddev_pop(CASE WHEN split = 'train' THEN {c} END) {w} END, 6) AS {c}" for c in _F11)
    cols = ", ".join(_F11)
    kcols = " + ".join(f"k_{c}" for c in _F11)
    return f"""
WITH RECURSIVE {FEATURES_CTE}, {TRAIN_NUM},
f AS (SELECT *, unnest(generate_series(CAST(greatest(0, ceil((rn - 272) / 21.0)) AS BIGINT),
                                       CAST(least(floor(rn / 21.0), floor((n - 273) / 21.0)) AS BIGINT))) AS fold
      FROM tn WHERE n >= 273),
s1 AS (SELECT ticker, CAST(fold AS INTEGER) AS fold, CASE WHEN rn - fold * 21 < 252 THEN 'train' ELSE 'test' END AS split,
              rn, timestamp, target, {cols} FROM f),{_gaps_sql() if gaps else "g5 AS (SELECT *, 0 AS copies, 0 AS filled FROM s1),"}
s2 AS (SELECT *, {qs} FROM g5),
s3 AS (SELECT ticker, fold, split, rn, timestamp, target, copies, filled, {cap} FROM s2),
s4 AS (SELECT ticker, fold, split, rn, timestamp, target, copies, filled, ({kcols}) AS capped, {clip} FROM s3),
s5 AS (SELECT ticker, fold, split, timestamp, target, copies, filled, capped, {scale} FROM s4)"""


@register("J7_prepared_folds", _prep_sql() + f"""
SELECT ticker, fold, split, timestamp, target, {', '.join(_F11)} FROM s5
""")
def j7_prepared_folds(spark, sf_dir):
    folds = fo.assign_folds(_train(spark, sf_dir))
    out, _ = _prep.prepare_folds(folds, _F11)
    return out.select("ticker", "fold", "split", "timestamp", "target",
                      *[F.round(c, 6).alias(c) for c in _F11])


_PREP_COUNTS = """
SELECT ticker, fold, sum(CASE WHEN split = 'train' THEN filled ELSE 0 END)::BIGINT AS imputed_values_train,
       sum(CASE WHEN split = 'test' THEN filled ELSE 0 END)::BIGINT AS imputed_values_test,
       sum(capped)::BIGINT AS outliers_capped, count(*) FILTER (WHERE split = 'train') AS train_rows,
       count(*) FILTER (WHERE split = 'test') AS test_rows, sum(copies)::BIGINT AS duplicates_removed
FROM s5 GROUP BY 1, 2
"""


@register("J7_prep_counts", _prep_sql() + _PREP_COUNTS)
def j7_prep_counts(spark, sf_dir):
    folds = fo.assign_folds(_train(spark, sf_dir))
    _, counts = _prep.prepare_folds(folds, _F11)
    return counts.select("ticker", "fold", F.col("imputed_values_train").cast("long"),
                         F.col("imputed_values_test").cast("long"),
                         F.col("outliers_capped").cast("long"), "train_rows", "test_rows",
                         F.col("duplicates_removed").cast("long"))


# ---------------------------------------------------------------- J8/J12 models
from tickwise.operators import models as _models  # noqa: E402
from tickwise.operators import scoring as _scoring  # noqa: E402
from tickwise.session import materialize  # noqa: E402


def _prepared(spark, sf_dir):
    folds = fo.assign_folds(_train(spark, sf_dir))
    out, _ = _prep.prepare_folds(folds, _F11)
    return materialize(out)


def _with_gaps(folds):
    """Fold rows with holes: nulls, infinite values and repeated train rows at fixed positions."""
    rn = F.col("rn")
    d = folds.withColumns({_NULLED: F.when(rn % 17 == 3, F.lit(None)).otherwise(F.col(_NULLED)),
                           _BLOWN: F.when(rn % 29 == 5, F.lit(float("inf"))).otherwise(F.col(_BLOWN))})
    return d.unionByName(d.filter((F.col("split") == "train") & (rn % 41 == 7)))


_Z_FENCE = {c: (f"avg(CASE WHEN split = 'train' THEN {c} END) OVER w", f"stddev_samp(CASE WHEN split = 'train' THEN {c} END) OVER w") for c in _F11}
_Z_SUM = " + ".join(f"CAST(split = 'train' AND abs({c} - {m}) > 3 * {sd} AND {sd} > 0 AS INTEGER)" for c, (m, sd) in _Z_FENCE.items())


@register("J4_zscore_caps", _prep_sql() + f""",
z AS (SELECT ticker, fold, {_Z_SUM} AS capped FROM s1 WINDOW w AS (PARTITION BY ticker, fold))
SELECT ticker, fold, sum(capped)::BIGINT AS outliers_capped FROM z GROUP BY 1, 2
""")
def j4_zscore_caps(spark, sf_dir):
    """J4 with z-score fences: values capped in each fold's training rows."""
    _, counts = _prep.prepare_folds(fo.assign_folds(_train(spark, sf_dir)), _F11, cap_method="zscore")
    return counts.select("ticker", "fold", F.col("outliers_capped").cast("long").alias("outliers_capped"))


@register("J7_prepared_folds_gaps", _prep_sql(True) + f"""
SELECT ticker, fold, split, timestamp, target, {", ".join(_F11)} FROM s5
""")
def j7_prepared_folds_gaps(spark, sf_dir):
    """J2, J3, E11, G3 and J4-J6 on folds that hold nulls, infinite values and repeated rows."""
    out, _ = _prep.prepare_folds(_with_gaps(fo.assign_folds(_train(spark, sf_dir))), _F11)
    return out.select("ticker", "fold", "split", "timestamp", "target", *[F.round(c, 6).alias(c) for c in _F11])


@register("J7_prep_counts_gaps", _prep_sql(True) + _PREP_COUNTS)
def j7_prep_counts_gaps(spark, sf_dir):
    """Counts of the same preparation."""
    _, counts = _prep.prepare_folds(_with_gaps(fo.assign_folds(_train(spark, sf_dir))), _F11)
    return counts.select("ticker", "fold", *[F.col(c).cast("long").alias(c) for c in (
        "imputed_values_train", "imputed_values_test", "outliers_capped", "train_rows", "test_rows", "duplicates_removed")])


@register("J8_logistic_fold_metrics")
def j8_logistic_fold_metrics(spark, sf_dir):
    """J8 fitted on every (ticker, fold) in parallel; D12/D13 on each test split."""
    preds = _models.logistic_fold_predictions(_prepared(spark, sf_dir), _F11)
    m = _models.fold_metrics(preds)
    return m.select("ticker", "fold", "model", *[F.round(c, 6).alias(c) for c in
                                                 ("accuracy", "precision", "recall", "f1", "roc_auc")])


@register("E12_latest_features", f"""
WITH RECURSIVE {FEATURES_CTE},
t AS (SELECT ticker, timestamp, close, rn, n FROM s WHERE rn >= n - 30),
l AS (SELECT *, close / nullif(lag(close, 1) OVER w, 0) - 1 AS r1, close / nullif(lag(close, 3) OVER w, 0) - 1 AS r3,
             close / nullif(lag(close, 5) OVER w, 0) - 1 AS r5, ln(close / nullif(lag(close, 1) OVER w, 0)) AS lr
      FROM t WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)),
v AS (SELECT *, CASE WHEN count(lr) OVER w20 >= 20 THEN stddev_samp(lr) OVER w20 * sqrt(252) END AS vol
      FROM l WINDOW w20 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT v.ticker, v.timestamp, round(v.close, 4) AS close, round(i.rsi_14, 4) AS rsi_14, round(i.macd, 4) AS macd,
       round(i.macd_signal, 4) AS macd_signal, round(i.bollinger_upper, 4) AS bollinger_upper,
       round(i.bollinger_lower, 4) AS bollinger_lower, round(i.sma_50, 6) AS sma_50, round(i.sma_200, 6) AS sma_200,
       round(coalesce(r1, 0), 8) AS return_1d, round(coalesce(r3, 0), 8) AS return_3d, round(coalesce(r5, 0), 8) AS return_5d,
       round(coalesce(vol, 0), 8) AS volatility_20d
FROM v JOIN ind i ON v.ticker = i.ticker AND v.timestamp = i.timestamp WHERE v.rn = v.n - 1
""")
def e12_latest_features(spark, sf_dir):
    from tickwise.plans.queries_quality import rounded
    b = bars(spark, sf_dir)
    lf = _scoring.latest_feature_rows(b, _ind.technical_features(b, keep_warmup=False, checkpoint=False))
    return rounded(lf, ["ticker", "timestamp", "close"] + _F11)


@register("J17_backfill_actuals_rule", f"""
WITH RECURSIVE {FEATURES_CTE},
p AS (SELECT ticker, timestamp, CASE WHEN macd > macd_signal THEN 'UP' ELSE 'DOWN' END AS predicted_direction FROM ind),
nx AS (SELECT ticker, timestamp, close, lead(close) OVER (PARTITION BY ticker ORDER BY timestamp) AS nxt FROM bars)
SELECT p.ticker, p.timestamp, p.predicted_direction,
       CASE WHEN nx.nxt IS NULL THEN NULL WHEN nx.nxt > nx.close THEN 'UP' ELSE 'DOWN' END AS actual_direction
FROM p LEFT JOIN nx ON p.ticker = nx.ticker AND p.timestamp = nx.timestamp
""")
def j17_backfill_actuals_rule(spark, sf_dir):
    b = bars(spark, sf_dir)
    ind = _ind.technical_features(b, keep_warmup=False, checkpoint=False)
    preds = ind.select("ticker", "timestamp", F.when(F.col("macd") > F.col("macd_signal"), F.lit("UP"))
                       .otherwise(F.lit("DOWN")).alias("predicted_direction"))
    return _scoring.backfill_actuals(preds, b)


@register("D5_fetch_outliers", f"""
WITH {BARS_CTE},
c AS (SELECT ticker, close FROM bars WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume > 0),
st AS (SELECT ticker, avg(close) AS m, stddev_samp(close) AS sd FROM c GROUP BY 1)
SELECT c.ticker, count(*) AS outlier_count FROM c JOIN st ON c.ticker = st.ticker
WHERE st.sd > 0 AND abs(c.close - st.m) > 3 * st.sd GROUP BY 1
""")
def d5_fetch_outliers(spark, sf_dir):
    """The outlier flag on a freshly cleaned batch (B1 applied first)."""
    from tickwise.functions.cleaning import positive_bars
    from tickwise.operators.quality import outlier_counts
    return outlier_counts(positive_bars(bars(spark, sf_dir)))


@register("E2_target_legacy_last_row", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp,
       coalesce(CAST(lead(close) OVER (PARTITION BY ticker ORDER BY timestamp) > close AS INTEGER), 0) AS target
FROM bars
""")
def e2_target_legacy(spark, sf_dir):
    """E2 with ``legacy_last_row=True``: the last bar of each ticker gets 0."""
    from tickwise.operators.series import halo_blocks, home_only, number_rows
    from tickwise.operators.training import add_target
    b = bars(spark, sf_dir).select("ticker", "timestamp", F.col("close").cast("double").alias("close"))
    d = add_target(halo_blocks(number_rows(b), halo=0, lead=1), legacy_last_row=True)
    return home_only(d).select("ticker", "timestamp", "target")


@register("J16_needing_prediction", f"""
WITH RECURSIVE {FEATURES_CTE},
lt AS (SELECT ticker, max(timestamp) AS ts FROM ind GROUP BY 1),
pred AS (SELECT ticker, timestamp AS predicted_at FROM ind),
fresh AS (SELECT DISTINCT ticker FROM pred
          WHERE predicted_at > (SELECT max(timestamp) FROM bars) + INTERVAL 30 minute - INTERVAL 3600 second)
SELECT lt.ticker, lt.ts AS timestamp FROM lt WHERE lt.ticker NOT IN (SELECT ticker FROM fresh)
""")
def j16_needing_prediction(spark, sf_dir):
    """Stored predictions (one per feature row, stamped with the bar time)
    are fresh when younger than the 1 h TTL at ``now`` = last bar + 30 min;
    only tickers without a fresh one are scored again."""
    from tickwise.operators.latest import latest_per_key
    b = bars(spark, sf_dir)
    ind = _ind.technical_features(b, keep_warmup=False)
    latest = latest_per_key(ind.select("ticker", "timestamp"), cols=["timestamp"])
    preds = ind.select("ticker", F.col("timestamp").cast("timestamp").alias("predicted_at"))
    now = b.agg(F.max("timestamp").alias("t")).scalar() + F.expr("INTERVAL 30 MINUTES")
    return _scoring.needing_prediction(latest, preds, now)
