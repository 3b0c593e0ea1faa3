"""Registered queries: bars, windows, indicators, latest/paging, serving (A, E, F, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import indicators as ind
from tickwise.operators.series import home_only
from tickwise.plans import serving
from tickwise.plans.catalog import BARS_CTE, SERIES_CTE, register
from tickwise.sources.tables import bars


def _bars(spark, sf_dir):
    return bars(spark, sf_dir)


# ---------------------------------------------------------------- K1 (flagship)
@register("K1_latest_prices", f"""
WITH {BARS_CTE},
latest AS (SELECT ticker, max(timestamp) AS timestamp,
                  arg_max(close, timestamp) AS close, arg_max(volume, timestamp) AS volume
           FROM bars GROUP BY ticker),
prev AS (SELECT ticker, arg_max(close, timestamp) AS prev_close FROM bars
         WHERE timestamp < (SELECT max(timestamp) FROM bars) GROUP BY ticker)
SELECT l.ticker, round(l.close, 2) AS latest_price,
       round(coalesce((l.close - p.prev_close) / nullif(p.prev_close, 0) * 100, 0), 2) AS change_pct,
       CAST(l.volume AS BIGINT) AS volume, l.timestamp
FROM latest l LEFT JOIN prev p ON l.ticker = p.ticker
""")
def k1_latest_prices(spark, sf_dir):
    return serving.latest_prices(_bars(spark, sf_dir))


# ---------------------------------------------------------------- E1 lag returns
@register("E1_lag_returns", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp,
  round(close / lag(close, 1) OVER w - 1, 8) AS return_1d,
  round(close / lag(close, 3) OVER w - 1, 8) AS return_3d,
  round(close / lag(close, 5) OVER w - 1, 8) AS return_5d,
  round(close / lag(close, 10) OVER w - 1, 8) AS return_10d
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)
""")
def e1_lag_returns(spark, sf_dir):
    d = ind.add_lag_returns(ind.layout(_bars(spark, sf_dir), halo=10))
    return home_only(d).select("ticker", "timestamp", *[
        F.round(f"return_{k}d", 8).alias(f"return_{k}d") for k in ind.DEFAULT_LAGS])


# ---------------------------------------------------------------- E3 SMA 50/200
@register("E3_sma", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp,
  CASE WHEN count(close) OVER w50 = 50 THEN round(avg(close) OVER w50, 6) END AS sma_50,
  CASE WHEN count(close) OVER w200 = 200 THEN round(avg(close) OVER w200, 6) END AS sma_200
FROM bars
WINDOW w50 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
       w200 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)
""")
def e3_sma(spark, sf_dir):
    d = ind.layout(_bars(spark, sf_dir), halo=199)
    d = ind.add_sma(ind.add_sma(d, 50, "sma_50"), 200, "sma_200")
    return home_only(d).select("ticker", "timestamp", F.round("sma_50", 6).alias("sma_50"),
                               F.round("sma_200", 6).alias("sma_200"))


# ---------------------------------------------------------------- E4 Bollinger
@register("E4_bollinger", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp,
  CASE WHEN count(close) OVER w = 20 THEN round(avg(close) OVER w + 2 * stddev_samp(close) OVER w, 2) END AS bollinger_upper,
  CASE WHEN count(close) OVER w = 20 THEN round(avg(close) OVER w - 2 * stddev_samp(close) OVER w, 2) END AS bollinger_lower
FROM bars
WINDOW w AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""")
def e4_bollinger(spark, sf_dir):
    d = ind.add_bollinger(ind.layout(_bars(spark, sf_dir), halo=19))
    return home_only(d).select("ticker", "timestamp",
                               F.round("bollinger_upper", 2).alias("bollinger_upper"),
                               F.round("bollinger_lower", 2).alias("bollinger_lower"))


# ---------------------------------------------------------------- E5 volatility
@register("E5_volatility", f"""
WITH {BARS_CTE},
lr AS (SELECT ticker, timestamp, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY timestamp)) AS r
       FROM bars)
SELECT ticker, timestamp,
  CASE WHEN count(r) OVER w = 20 THEN round(stddev_samp(r) OVER w * sqrt(252), 8) END AS volatility_20d
FROM lr
WINDOW w AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""")
def e5_volatility(spark, sf_dir):
    d = ind.add_volatility(ind.layout(_bars(spark, sf_dir), halo=20))
    return home_only(d).select("ticker", "timestamp",
                               F.round("volatility_20d", 8).alias("volatility_20d"))


# recursive oracle for the exponential means
_EWM_CTE = SERIES_CTE + """,
r AS (
  SELECT ticker, rn, n, timestamp, close,
         close AS e12, close AS e26, 0.0::DOUBLE AS sig, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l
  FROM s WHERE rn = 0
  UNION ALL
  SELECT s.ticker, s.rn, s.n, s.timestamp, s.close,
         (11.0/13) * r.e12 + (2.0/13) * s.close,
         (25.0/27) * r.e26 + (2.0/27) * s.close,
         0.8 * r.sig + 0.2 * (((11.0/13) * r.e12 + (2.0/13) * s.close) - ((25.0/27) * r.e26 + (2.0/27) * s.close)),
         (13.0/14) * r.g + (1.0/14) * greatest(s.close - r.close, 0),
         (13.0/14) * r.l + (1.0/14) * greatest(r.close - s.close, 0)
  FROM r JOIN s ON s.ticker = r.ticker AND s.rn = r.rn + 1)"""


@register("E6_ewm", f"""
WITH RECURSIVE {_EWM_CTE}
SELECT ticker, timestamp, round(e12, 2) AS ema_12, round(e26, 2) AS ema_26 FROM r
""")
def e6_ewm(spark, sf_dir):
    from tickwise.operators.recurrence import Ewm, span_alpha
    d = ind.layout(_bars(spark, sf_dir), halo=0)
    d = ind.add_ewm(d, [Ewm("ema_12", "close", span_alpha(12)),
                        Ewm("ema_26", "close", span_alpha(26))])
    return home_only(d).select("ticker", "timestamp", F.round("ema_12", 2).alias("ema_12"),
                               F.round("ema_26", 2).alias("ema_26"))


@register("E7_rsi", f"""
WITH RECURSIVE {_EWM_CTE}
SELECT ticker, timestamp,
  CASE WHEN n < 15 THEN NULL WHEN rn < 13 THEN 100.0 WHEN l = 0 THEN 100.0
       ELSE round(100 - 100 / (1 + g / l), 4) END AS rsi_14
FROM r
""")
def e7_rsi(spark, sf_dir):
    d = ind.add_rsi(ind.layout(_bars(spark, sf_dir), halo=1))
    return home_only(d).select("ticker", "timestamp", F.round("rsi_14", 4).alias("rsi_14"))


@register("E8_macd", f"""
WITH RECURSIVE {_EWM_CTE}
SELECT ticker, timestamp,
  CASE WHEN n >= 26 THEN round(e12 - e26, 2) END AS macd,
  CASE WHEN n >= 26 THEN round(sig, 2) END AS macd_signal
FROM r
""")
def e8_macd(spark, sf_dir):
    d = ind.add_macd(ind.layout(_bars(spark, sf_dir), halo=0))
    return home_only(d).select("ticker", "timestamp", F.round("macd", 2).alias("macd"),
                               F.round("macd_signal", 2).alias("macd_signal"))


# other periods than the reference's defaults
_PERIODS_CTE = SERIES_CTE + """,
r AS (
  SELECT ticker, rn, n, timestamp, close, close AS e5, close AS e35, 0.0::DOUBLE AS sig, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l
  FROM s WHERE rn = 0
  UNION ALL
  SELECT s.ticker, s.rn, s.n, s.timestamp, s.close, (2.0/3) * r.e5 + (1.0/3) * s.close, (17.0/18) * r.e35 + (1.0/18) * s.close,
         (2.0/3) * r.sig + (1.0/3) * (((2.0/3) * r.e5 + (1.0/3) * s.close) - ((17.0/18) * r.e35 + (1.0/18) * s.close)),
         (20.0/21) * r.g + (1.0/21) * greatest(s.close - r.close, 0), (20.0/21) * r.l + (1.0/21) * greatest(r.close - s.close, 0)
  FROM r JOIN s ON s.ticker = r.ticker AND s.rn = r.rn + 1)"""


@register("E7_rsi_21", f"""
WITH RECURSIVE {_PERIODS_CTE}
SELECT ticker, timestamp, CASE WHEN n < 22 THEN NULL WHEN rn < 20 THEN 100.0 WHEN l = 0 THEN 100.0
       ELSE round(100 - 100 / (1 + g / l), 4) END AS rsi_21 FROM r
""")
def e7_rsi_21(spark, sf_dir):
    """RSI of period 21."""
    d = ind.add_rsi(ind.layout(_bars(spark, sf_dir), halo=1), 21)
    return home_only(d).select("ticker", "timestamp", F.round("rsi_21", 4).alias("rsi_21"))


@register("E8_macd_5_35_5", f"""
WITH RECURSIVE {_PERIODS_CTE}
SELECT ticker, timestamp, CASE WHEN n >= 35 THEN round(e5 - e35, 2) END AS macd,
       CASE WHEN n >= 35 THEN round(sig, 2) END AS macd_signal FROM r
""")
def e8_macd_5_35_5(spark, sf_dir):
    """MACD of spans 5, 35 and signal 5 (fast and signal share their decay)."""
    d = ind.add_macd(ind.layout(_bars(spark, sf_dir), halo=0), 5, 35, 5)
    return home_only(d).select("ticker", "timestamp", F.round("macd", 2).alias("macd"),
                               F.round("macd_signal", 2).alias("macd_signal"))


SUSPENDED_DAYS = 2500


def suspended(bars):
    """Bars of every ticker, followed by ``SUSPENDED_DAYS`` days at its last close (a suspended stock)."""
    last = bars.groupBy("ticker").agg(F.max("timestamp").alias("t"), F.max_by("close", "timestamp").alias("close"))
    flat = last.select("ticker", F.explode(F.sequence(F.lit(1), F.lit(SUSPENDED_DAYS))).alias("d"), "t", "close")
    return bars.select("ticker", "timestamp", "close").unionByName(flat.select(
        "ticker", F.expr("t + make_dt_interval(d)").cast(bars.schema["timestamp"].dataType).alias("timestamp"), "close"))


@register("E7_rsi_suspended", f"""
WITH RECURSIVE {BARS_CTE},
b2 AS (SELECT ticker, timestamp, close FROM bars UNION ALL
       SELECT ticker, t + to_days(CAST(d AS INTEGER)), close
       FROM (SELECT ticker, max(timestamp) AS t, max_by(close, timestamp) AS close FROM bars GROUP BY 1), range(1, {SUSPENDED_DAYS + 1}) AS x(d)),
s AS (SELECT ticker, timestamp, close, row_number() OVER (PARTITION BY ticker ORDER BY timestamp) - 1 AS rn,
             count(*) OVER (PARTITION BY ticker) AS n FROM b2),
r AS (
  SELECT ticker, rn, n, timestamp, close, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l FROM s WHERE rn = 0
  UNION ALL
  SELECT s.ticker, s.rn, s.n, s.timestamp, s.close, (13.0/14) * r.g + (1.0/14) * greatest(s.close - r.close, 0),
         (13.0/14) * r.l + (1.0/14) * greatest(r.close - s.close, 0)
  FROM r JOIN s ON s.ticker = r.ticker AND s.rn = r.rn + 1)
SELECT ticker, timestamp, CASE WHEN n < 15 THEN NULL WHEN rn < 13 THEN 100.0 WHEN l = 0 THEN 100.0
       ELSE round(100 - 100 / (1 + g / l), 4) END AS rsi_14 FROM r
""")
def e7_rsi_suspended(spark, sf_dir):
    """RSI of series that end in a long flat run: both means decay together, their ratio stays."""
    d = ind.add_rsi(ind.layout(suspended(_bars(spark, sf_dir)), halo=1))
    return home_only(d).select("ticker", "timestamp", F.round("rsi_14", 4).alias("rsi_14"))
