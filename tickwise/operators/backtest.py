"""Backtest (J18) and multi-ticker aggregate.

Per ticker: the last 126 rows of the training frame, predictions from a
model (any DataFrame -> (y_pred, y_prob) scorer), strategy long when UP and
flat otherwise: the prediction at t earns the return t -> t+1 (125 returns
from 126 rows). Metrics D10-D12, drawdown E9/D23, total return D11 and
buy-and-hold. Tickers with fewer than 252 + 126 rows are
``insufficient_data``. All tickers run in one plan: the tail filter uses the
distributed numbering, the only windows are over the bounded 126-row tail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.folds import BACKTEST_DAYS, TRAIN_WINDOW
from tickwise.operators.metrics import confusion_metrics
from tickwise.operators.risk import drawdown_curve, sharpe, total_return
from tickwise.operators.series import newest_rows, with_length


def rule_scorer(df: DataFrame) -> DataFrame:
    """Deterministic reference model: UP when MACD is above its signal.

    Probability = logistic((macd - signal) / close * 100), so UP <=> p > 0.5.
    """
    z = F.try_divide(F.col("macd") - F.col("macd_signal"), F.col("close")) * 100.0
    prob = 1.0 / (1.0 + F.exp(-z))
    return df.withColumn("y_prob", prob).withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))


def backtest(frame: DataFrame, scorer=rule_scorer, days: int = BACKTEST_DAYS,
             min_rows: int = TRAIN_WINDOW + BACKTEST_DAYS, key: str = "ticker",
             ts: str = "timestamp") -> DataFrame:
    """J18 for every ticker of a training frame (needs close, target, features)."""
    tail = with_length(newest_rows(frame, days, key, ts), frame, key).filter(F.col("n") >= min_rows)
    tail = tail.withColumn("rn", F.col("n") - 1 - F.col("_back")).drop("_back")
    scored = scorer(tail).withColumnRenamed("target", "y_true")
    w = Window.partitionBy(key).orderBy("rn")        # bounded: the 126-row tail
    nxt = F.lead("close", 1).over(w)
    steps = (scored.withColumn("r", F.try_divide(nxt, F.col("close")) - 1.0)
             .withColumn("s", F.col("r") * F.col("y_pred")))
    rets = steps.filter(F.col("r").isNotNull())
    cls = confusion_metrics(scored, [key])
    strat = drawdown_curve(rets, [key], "rn", "s").groupBy(key).agg(
        sharpe(F.col("s")).alias("sharpe_ratio"),
        F.coalesce(F.min("drawdown"), F.lit(0.0)).alias("max_drawdown"),
        total_return(F.col("s")).alias("strategy_total_return"),
        sharpe(F.col("r")).alias("buyhold_sharpe"),
        total_return(F.col("r")).alias("buyhold_total_return"))
    res = cls.join(strat, key, "left")
    r4 = lambda c: F.round(c, 4)
    ok = res.select(key, F.lit("success").alias("status"), F.lit(days).alias("backtest_days"),
                    r4(F.col("accuracy")).alias("accuracy"), r4(F.col("precision")).alias("precision"),
                    r4(F.col("recall")).alias("recall"), r4(F.col("f1")).alias("f1"),
                    r4(F.col("win_rate")).alias("win_rate"),
                    r4(F.col("sharpe_ratio")).alias("sharpe_ratio"),
                    r4(F.col("max_drawdown")).alias("max_drawdown"),
                    r4(F.col("strategy_total_return")).alias("strategy_total_return"),
                    r4(F.col("buyhold_total_return")).alias("buyhold_total_return"),
                    r4(F.col("buyhold_sharpe")).alias("buyhold_sharpe"),
                    r4(F.col("strategy_total_return") - F.col("buyhold_total_return"))
                    .alias("outperformance"))
    short = (frame.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") < min_rows)
             .select(key, F.lit("insufficient_data").alias("status"), "rows"))
    return ok.withColumn("rows", F.lit(None).cast("long")).unionByName(short, allowMissingColumns=True)


def backtest_summary(per_ticker: DataFrame) -> DataFrame:
    """Tickers tested and mean accuracy / F1 / Sharpe over successful tickers."""
    ok = per_ticker.filter(F.col("status") == "success")
    return ok.agg(F.count(F.lit(1)).alias("tickers_tested"),
                  F.round(F.avg("accuracy"), 4).alias("avg_accuracy"),
                  F.round(F.avg("f1"), 4).alias("avg_f1"),
                  F.round(F.avg("sharpe_ratio"), 4).alias("avg_sharpe"))

