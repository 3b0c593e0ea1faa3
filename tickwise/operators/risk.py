"""Portfolio risk (K4) and its parts: B7, E15, C7, D8, D9, D10, D11, E9, D23.

Many portfolios are evaluated in one plan keyed by ``portfolio_id``. Every
group is bounded: a ticker contributes at most 252 returns, a portfolio at
most 252 aligned returns, so windows and exact percentiles per portfolio or
per ticker never see an unbounded group. The per-ticker return table
(tickers x 252 rows) joins the positions on ticker; AQE broadcasts it when
its measured size allows and splits a hot ticker otherwise (skew join).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.cleaning import normalize_ticker
from tickwise.operators.series import newest_rows

TRADING_DAYS = 252
WEIGHT_TOLERANCE = 0.01
SQRT_252 = math.sqrt(252.0)


def parse_portfolios(requests: DataFrame) -> DataFrame:
    """(portfolio_id, tickers 'A,B', weights '0.5,0.5') -> positions + validity.

    Rows: (portfolio_id, pos, ticker, weight, n_tickers, n_weights, weight_sum,
    error). ``error`` is NULL for a valid portfolio, else the first failed
    rule: non-numeric weight, length mismatch, weights not summing to 1.
    The sum is a left fold in list order (as the reference adds them), which
    decides the borderline cases |sum - 1| = 0.01; all checks are per-row
    array expressions, no shuffle.
    """
    t = F.split(F.col("tickers"), ",")
    w = F.split(F.col("weights"), ",")
    nums = F.transform(w, lambda x: F.trim(x).try_cast("double"))
    wsum = F.aggregate(nums, F.lit(0.0), lambda acc, x: acc + x)
    bad_num = F.exists(nums, lambda x: x.isNull())
    # fixed values: message texts that users of the reference match on
    err = (F.when(bad_num, F.lit("Weights must be numeric values"))
           .when(F.size(t) != F.size(w), F.lit("Number of tickers must match weights"))
           .when(F.abs(wsum - 1.0) > WEIGHT_TOLERANCE, F.lit("Weights must sum to 1.0")))
    base = requests.select("portfolio_id", F.size(t).alias("n_tickers"), F.size(w).alias("n_weights"),
                           wsum.alias("weight_sum"), err.alias("error"),
                           F.posexplode(F.arrays_zip(t.alias("t"), nums.alias("w"))).alias("pos", "z"))
    return (base.filter(F.col("pos") < F.least("n_tickers", "n_weights"))
            .select("portfolio_id", "pos", normalize_ticker(F.col("z.t")).alias("ticker"),
                    F.col("z.w").alias("weight"), "n_tickers", "n_weights", "weight_sum", "error"))


def recent_returns(bars: DataFrame, days: int = TRADING_DAYS, key: str = "ticker",
                   ts: str = "timestamp") -> DataFrame:
    """Simple returns of the last ``days + 1`` closes per ticker.

    Rows (ticker, pos, timestamp, r) with ``pos`` counted from the oldest kept return;
    a ticker with fewer than 2 closes has none.
    """
    tail = newest_rows(bars.select(key, ts, F.col("close").cast("double").alias("close")), days + 1, key, ts)
    w = Window.partitionBy(key).orderBy(ts)          # bounded: days + 1 rows
    d = tail.withColumns({"r": F.try_divide(F.col("close"), F.lag("close", 1).over(w)) - 1.0,
                          "pos": F.row_number().over(w) - 2})
    return d.filter(F.col("pos") >= 0).select(key, "pos", ts, "r")


def individual_risk(returns: DataFrame, key: str = "ticker") -> DataFrame:
    """D8/D9 per ticker: population vol x sqrt(252), 5 % historical VaR, mean x 252."""
    return returns.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_returns"),
        (F.stddev_pop("r") * SQRT_252).alias("annual_volatility"),
        F.percentile("r", 0.05).alias("var_95"),
        (F.avg("r") * TRADING_DAYS).alias("expected_return"))


def drawdown_curve(df: DataFrame, group: list[str], order: str, r: str = "r") -> DataFrame:
    """equity = running product of (1 + r); drawdown vs its running max.

    The initial capital is not part of the running max (first point is 1 + r0).
    Groups must be bounded (a portfolio's or a ticker's back-test window).
    """
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("equity", F.product(1.0 + F.col(r)).over(w))
            .withColumn("peak", F.max("equity").over(w))
            .withColumn("drawdown", F.try_divide(F.col("equity") - F.col("peak"), F.col("peak"))))


def sharpe(r: Column) -> Column:
    """Mean / population std x sqrt(252); 0 when std is 0 or undefined."""
    return F.coalesce(F.try_divide(F.avg(r), F.nullif(F.stddev_pop(r), F.lit(0.0))) * SQRT_252,
                      F.lit(0.0))


def total_return(r: Column) -> Column:
    """Compounded return prod(1 + r) - 1 (0 for no returns)."""
    return F.coalesce(F.product(1.0 + r) - 1.0, F.lit(0.0))


def portfolio_risk(bars: DataFrame, requests: DataFrame, days: int = TRADING_DAYS, by: str = "position",
                   ts: str = "timestamp"):
    """K4 for every requested portfolio. Returns (portfolio_df, individual_df).

    ``by="position"`` aligns returns from each ticker's oldest kept one and cuts to the
    shortest series (C7), as the reference does; ``by="date"`` uses the dates on which
    every position has a return.
    A portfolio naming a ticker without data gets error 'No price data'.
    """
    if by not in ("position", "date"):
        raise ValueError(f"unknown alignment {by!r}")
    positions = parse_portfolios(requests)
    rets = recent_returns(bars, days)
    per_ticker = individual_risk(rets)
    ind = (positions.join(per_ticker, "ticker", "left")
           .withColumn("error", F.coalesce(
               F.col("error"),
               F.max(F.when(F.col("n_returns").isNull(), F.concat(F.lit("No price data for ticker "),
                                                                  F.col("ticker"))))
               .over(Window.partitionBy("portfolio_id")))))
    valid = ind.filter(F.col("error").isNull())
    bound = valid.groupBy("portfolio_id").agg(F.min("n_returns").alias("_len"), F.count(F.lit(1)).alias("_held"))
    joined = valid.select("portfolio_id", "ticker", "weight").join(bound, "portfolio_id").join(rets, "ticker")
    step = "pos" if by == "position" else ts
    if by == "position":
        joined = joined.filter(F.col("pos") < F.col("_len"))
    preturn = joined.groupBy("portfolio_id", step).agg(
        F.sum(F.col("weight") * F.col("r")).alias("r"), (F.count(F.lit(1)) == F.max("_held")).alias("_full"))
    curve = drawdown_curve(preturn.filter(F.col("_full") | F.lit(by == "position")), ["portfolio_id"], step)
    port = curve.groupBy("portfolio_id").agg(
        F.round(F.percentile("r", 0.05), 6).alias("var_95"),
        F.round(F.percentile("r", 0.01), 6).alias("var_99"),
        F.round(F.avg("r") * TRADING_DAYS, 4).alias("expected_return"),
        F.round(F.min("drawdown"), 4).alias("max_drawdown"),
        F.round(F.stddev_pop("r") * SQRT_252, 4).alias("annual_volatility"))
    errors = ind.groupBy("portfolio_id").agg(F.max("error").alias("error"))
    portfolio = errors.join(port, "portfolio_id", "left")
    individual = ind.filter(F.col("error").isNull()).select(
        "portfolio_id", "pos", "ticker", "weight",
        F.round("annual_volatility", 4).alias("annual_volatility"),
        F.round("var_95", 6).alias("var_95"), F.round("expected_return", 4).alias("expected_return"))
    return portfolio, individual
