"""Serving queries K1-K8 as DataFrame functions over all tickers at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators.latest import (last_two, latest_per_key, page_many,
                                       previous_close_before_global_max)


def latest_prices(bars: DataFrame) -> DataFrame:
    """K1: ticker, latest_price, change_pct (vs F2 previous close), volume, timestamp.

    One grouped aggregation: the latest row (F1) is ``max_by`` on the
    timestamp, the previous close (F2) is ``max_by`` on the timestamp masked
    to rows before the table-wide max (a scalar subquery); no join, and the
    bar table is aggregated once.
    """
    gmax = bars.select(F.max("timestamp")).scalar()
    before = F.when(F.col("timestamp") < gmax, F.col("timestamp"))
    agg = bars.groupBy("ticker").agg(
        F.max_by(F.struct("timestamp", "close", "volume"), F.col("timestamp")).alias("_l"),
        F.max_by(F.col("close"), before).alias("prev_close"))
    change = F.coalesce(
        F.try_divide(F.col("close") - F.col("prev_close"), F.nullif(F.col("prev_close"), F.lit(0)))
        * 100.0, F.lit(0.0))
    return (agg.select("ticker", "_l.*", "prev_close")
            .select("ticker",
                    F.round("close", 2).alias("latest_price"),
                    F.round(change, 2).alias("change_pct"),
                    F.col("volume").cast("long").alias("volume"),
                    "timestamp"))


def ticker_detail(bars: DataFrame, indicators: DataFrame) -> DataFrame:
    """K2: latest bar, change vs its own previous bar (F3) and newest indicators.

    Indicators are rounded as the reference presents them (2 or 4 places);
    a zero indicator stays 0 (only null is null).
    """
    top = last_two(bars)
    change = F.when(F.col("previous_close") != 0,
                    (F.col("close") - F.col("previous_close")) / F.col("previous_close") * 100.0
                    ).otherwise(F.lit(0.0))
    ind = latest_per_key(indicators.select("ticker", "timestamp", "rsi_14", "macd", "macd_signal",
                                           "bollinger_upper", "bollinger_lower", "sma_50",
                                           "sma_200"))
    ind = ind.select("ticker",
                     F.round("rsi_14", 2).alias("rsi_14"), F.round("macd", 4).alias("macd"),
                     F.round("macd_signal", 4).alias("macd_signal"),
                     F.round("bollinger_upper", 2).alias("bollinger_upper"),
                     F.round("bollinger_lower", 2).alias("bollinger_lower"),
                     F.round("sma_50", 2).alias("sma_50"), F.round("sma_200", 2).alias("sma_200"))
    return (top.select("ticker", F.round("close", 2).alias("latest_price"),
                       F.round(change, 2).alias("change_pct"),
                       F.round("previous_close", 2).alias("previous_close"),
                       F.col("volume").cast("long").alias("volume"), "timestamp")
            .join(ind, "ticker", "left"))


def history_page(bars: DataFrame, page: int = 1, page_size: int = 50) -> DataFrame:
    """K3: newest-first page of OHLCV (4 places) for every ticker."""
    p = page_many(bars, page, page_size)
    return p.select("ticker", "timestamp",
                    *[F.round(c, 4).alias(c) for c in ("open", "high", "low", "close")],
                    F.col("volume").cast("long").alias("volume"), "row_in_page",
                    F.lit(page).alias("page"), F.lit(page_size).alias("page_size"))


def chart_series(bars: DataFrame, page: int = 1, page_size: int = 500) -> DataFrame:
    """K8: a history page re-sorted oldest-first with close, high, low."""
    return (history_page(bars, page, page_size)
            .select("ticker", F.col("timestamp").alias("date"), "close", "high", "low")
            .orderBy("ticker", "date"))


def ticker_history(bars: DataFrame, ticker: str, page: int = 1, page_size: int = 50) -> DataFrame:
    """K3 for one ticker (upper-cased): an empty first page means an unknown
    ticker (``LookupError``); an empty later page is an empty result."""
    from tickwise.operators.latest import page_newest_first
    t = ticker.strip().upper()
    p = page_newest_first(bars.filter(F.col("ticker") == t), page, page_size).select(
        "timestamp", *[F.round(c, 4).alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"))
    if page == 1 and not p.take(1):
        raise LookupError(f"Ticker {t} not found")
    return p
