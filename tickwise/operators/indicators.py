"""Technical indicators per ticker: E1-E5, E7, E8, E10 and the K7 feature table.

All indicators run on one ``halo_blocks`` layout whose halo covers the
longest frame (SMA-200), so a single shuffle on (ticker, block) feeds every
window. Exponential means need no halo: their state is carried from block to
block exactly (``recurrence``), for any period and any length of history.

Semantics (fixed by the reference):
* returns: ``close / close[t-k] - 1``, null for the first k rows;
* SMA / Bollinger: null until the frame is full; Bollinger uses sample std;
* volatility: sample std of the last 20 log returns x sqrt(252), first value
  at row 20;
* RSI (Wilder, alpha 1/14): first delta counts as 0; rows 0-12 are 100.0;
  zero average loss gives 100; the whole column is null below 15 rows;
* MACD: EMA(12) - EMA(26) from row 0, signal EMA(9) of MACD; null below 26 rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators.recurrence import Chain, Ewm, ewm_pass, span_alpha
from tickwise.session import materialize
from tickwise.operators.series import (BLOCK_ROWS, N, RN, block_window, gated, halo_blocks,
                                       home_only, number_rows, trailing)

# Fixed values from the reference: feature columns in model order.
INDICATOR_COLUMNS = ["rsi_14", "macd", "macd_signal", "bollinger_upper", "bollinger_lower",
                     "sma_50", "sma_200"]
FEATURE_COLUMNS = INDICATOR_COLUMNS + ["return_1d", "return_3d", "return_5d", "volatility_20d"]
DEFAULT_LAGS = [1, 3, 5, 10]
SQRT_252 = math.sqrt(252.0)
MAX_HALO = 199         # rows before the current one in the longest frame


def layout(bars: DataFrame, key: str = "ticker", ts: str = "timestamp", price: str = "close",
           halo: int = MAX_HALO, block_rows: int = BLOCK_ROWS, bucket: str = "year") -> DataFrame:
    """Numbered, blocked series of (key, ts, close) ready for indicator columns."""
    base = bars.select(key, ts, F.col(price).cast("double").alias("close"))
    return halo_blocks(number_rows(base, key, ts, bucket), halo, block_rows)


def add_lag_returns(d: DataFrame, lags=None, key: str = "ticker") -> DataFrame:
    """``return_{k}d`` = close / close k rows back - 1."""
    w = block_window(key)
    return d.withColumns({f"return_{k}d": F.try_divide(F.col("close"), F.lag("close", k).over(w)) - 1.0
                          for k in (lags or DEFAULT_LAGS)})


def add_sma(d: DataFrame, rows: int, name: str, key: str = "ticker") -> DataFrame:
    """Simple moving average, null until ``rows`` closes are in the frame."""
    fr = trailing(key, rows)
    return d.withColumn(name, gated(F.avg("close").over(fr), F.count("close").over(fr), rows))


def add_bollinger(d: DataFrame, rows: int = 20, num_std: float = 2.0,
                  key: str = "ticker") -> DataFrame:
    """SMA(rows) +/- num_std * sample std over the same frame."""
    fr = trailing(key, rows)
    cnt = F.count("close").over(fr)
    mid, sd = F.avg("close").over(fr), F.stddev_samp("close").over(fr)
    return d.withColumns({"bollinger_upper": gated(mid + num_std * sd, cnt, rows),
                          "bollinger_lower": gated(mid - num_std * sd, cnt, rows)})


def add_volatility(d: DataFrame, rows: int = 20, key: str = "ticker") -> DataFrame:
    """E5: annualised sample std of the last ``rows`` log returns."""
    w = block_window(key)
    d = d.withColumn("_logret", F.ln(F.try_divide(F.col("close"), F.lag("close", 1).over(w))))
    fr = trailing(key, rows)
    vol = gated(F.stddev_samp("_logret").over(fr), F.count("_logret").over(fr), rows)
    return d.withColumn(f"volatility_{rows}d", vol * SQRT_252).drop("_logret")


def add_ewm(d: DataFrame, specs: list[Ewm], key: str = "ticker",
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """E6 on any ``halo_blocks`` layout."""
    return ewm_pass(d, specs, key, block_rows)


def _rsi_inputs(d: DataFrame, key: str) -> DataFrame:
    delta = F.col("close") - F.lag("close", 1).over(block_window(key))
    return d.withColumns({"_gain": F.when(delta > 0, delta).otherwise(F.lit(0.0)),
                          "_loss": F.when(delta < 0, -delta).otherwise(F.lit(0.0))})


def _rsi_specs(period: int) -> list[Ewm]:
    return [Ewm("_avg_gain", "_gain", 1.0 / period), Ewm("_avg_loss", "_loss", 1.0 / period)]


def _rsi_finish(d: DataFrame, period: int) -> DataFrame:
    rsi = (F.when(F.col(N) < period + 1, F.lit(None).cast("double"))
           .when(F.col(RN) < period - 1, F.lit(100.0))
           .when(F.col("_avg_loss") == 0, F.lit(100.0))
           .otherwise(100.0 - 100.0 / (1.0 + F.col("_avg_gain") / F.col("_avg_loss"))))
    return d.withColumn(f"rsi_{period}", rsi).drop("_gain", "_loss", "_avg_gain", "_avg_loss")


def _macd_specs(fast: int, slow: int) -> list[Ewm]:
    return [Ewm("_ema_fast", "close", span_alpha(fast)), Ewm("_ema_slow", "close", span_alpha(slow))]


def _macd_signal(signal: int) -> list[Chain]:
    return [Chain("_macd_sig", "_ema_fast", "_ema_slow", span_alpha(signal))]


def _macd_finish(d: DataFrame, slow: int) -> DataFrame:
    enough = F.col(N) >= slow
    return (d.withColumns({"macd": F.when(enough, F.col("_ema_fast") - F.col("_ema_slow")),
                           "macd_signal": F.when(enough, F.col("_macd_sig"))})
            .drop("_ema_fast", "_ema_slow", "_macd_sig"))


def add_rsi(d: DataFrame, period: int = 14, key: str = "ticker",
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Wilder RSI of any period, with the reference's warm-up and zero-loss rules
    (layout with a halo of one row or more)."""
    d = ewm_pass(_rsi_inputs(d, key), _rsi_specs(period), key, block_rows)
    return _rsi_finish(d, period)


def add_macd(d: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9,
             key: str = "ticker", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """MACD line and signal of any spans, in one pass."""
    d = ewm_pass(d, _macd_specs(fast, slow), key, block_rows, _macd_signal(signal))
    return _macd_finish(d, slow)


def technical_features(bars: DataFrame, key: str = "ticker", ts: str = "timestamp",
                       lags=None, block_rows: int = BLOCK_ROWS, bucket: str = "year",
                       keep_warmup: bool = True, checkpoint: bool = True) -> DataFrame:
    """All indicators + lag returns + volatility in one layout (``features_full``).

    ``keep_warmup=False`` applies B8 (drop rows until SMA-200 exists). The
    result is checkpointed (it is the persisted feature table of the
    reference, and downstream plans reference it several times).
    """
    d = layout(bars, key, ts, block_rows=block_rows, bucket=bucket)
    d = add_indicators(d, lags, key, block_rows)
    out = home_only(d)
    if not keep_warmup:
        out = out.filter(F.col("sma_200").isNotNull())
    return materialize(out) if checkpoint else out


def add_indicators(d: DataFrame, lags=None, key: str = "ticker",
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every indicator column on a layout built with ``MAX_HALO``."""
    d = add_lag_returns(d, lags, key)
    f50, f200 = trailing(key, 50), trailing(key, 200)
    d = d.withColumns({
        "sma_50": gated(F.avg("close").over(f50), F.count("close").over(f50), 50),
        "sma_200": gated(F.avg("close").over(f200), F.count("close").over(f200), 200)})
    d = add_bollinger(d, key=key)
    d = add_volatility(d, key=key)
    # RSI and MACD share one exponential-mean pass (four means and the signal)
    d = ewm_pass(_rsi_inputs(d, key), _rsi_specs(14) + _macd_specs(12, 26), key, block_rows, _macd_signal(9))
    return _macd_finish(_rsi_finish(d, 14), 26)
