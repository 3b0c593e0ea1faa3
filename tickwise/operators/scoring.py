"""Scoring: latest features (E12, C4), result reuse (J16, K6) and outcome backfill (J17), for all
tickers at once. Prediction with the saved preparation and model (J15) is in ``refit``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.indicators import INDICATOR_COLUMNS
from tickwise.operators.series import block_window, halo_blocks, home_only, newest_rows, number_rows

PREDICTION_TTL_SECONDS = 3600
LATEST_ROWS = 30


def latest_feature_rows(bars: DataFrame, indicators: DataFrame, min_periods: int = 20,
                        key: str = "ticker", ts: str = "timestamp") -> DataFrame:
    """E12 + C4: newest row per ticker with lags 1/3/5 and 20-row volatility
    from the last 30 bars, joined to the indicator row of the same timestamp.

    ``min_periods`` gates the volatility frame (20 = the training rule; 2
    mirrors the reference's partial frames). Missing lags/volatility -> 0.0.
    The window runs over the bounded 30-row tail of each ticker.
    """
    tail = newest_rows(bars.select(key, ts, F.col("close").cast("double").alias("close")), LATEST_ROWS, key, ts)
    w = Window.partitionBy(key).orderBy(ts)
    lagged = tail.select(key, ts, "close", "_back",
                         *[(F.col("close") / F.nullif(F.lag("close", k).over(w), F.lit(0.0)) - 1)
                           .alias(f"return_{k}d") for k in (1, 3, 5)],
                         F.ln(F.col("close") / F.nullif(F.lag("close", 1).over(w), F.lit(0.0)))
                         .alias("_lr"))
    fr = w.rowsBetween(-19, 0)
    vol = F.when(F.count("_lr").over(fr) >= min_periods,
                 F.stddev_samp("_lr").over(fr) * math.sqrt(252.0))
    latest = lagged.withColumn("volatility_20d", vol).filter(F.col("_back") == 0)
    ind = indicators.select(key, ts, *INDICATOR_COLUMNS)
    j = latest.join(ind, [key, ts])
    return j.select(key, ts, "close", *INDICATOR_COLUMNS,
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                      for c in ("return_1d", "return_3d", "return_5d", "volatility_20d")])


def _fresh(predictions: DataFrame, now, ttl_seconds: int) -> DataFrame:
    """Stored predictions younger than the TTL at ``now`` (a value, or a column such as a scalar subquery)."""
    clock = now if isinstance(now, Column) else F.lit(now)
    return predictions.filter(F.col("predicted_at") > clock.cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def needing_prediction(latest: DataFrame, predictions: DataFrame, now,
                       ttl_seconds: int = PREDICTION_TTL_SECONDS, key: str = "ticker") -> DataFrame:
    """Tickers without a prediction younger than the TTL (anti join)."""
    return latest.join(_fresh(predictions, now, ttl_seconds).select(key).distinct(), key, "left_anti")


PREDICTION_COLUMNS = ["timestamp", "predicted_direction", "confidence", "model_version", "model_name"]


def predict_or_reuse(latest: DataFrame, stored: DataFrame, now, scorer, ttl_seconds: int = PREDICTION_TTL_SECONDS,
                     key: str = "ticker") -> DataFrame:
    """K6: for every ticker of ``latest`` its newest stored prediction if that is younger than the TTL, else one by
    ``scorer`` (feature rows -> key and ``PREDICTION_COLUMNS``), which sees only the tickers that need it.

    Rows carry ``reused``. Of stored predictions of the same moment the largest version counts.
    """
    fresh = _fresh(stored, now, ttl_seconds)
    newest = fresh.groupBy(key).agg(F.max_by(F.struct(*PREDICTION_COLUMNS), F.struct("predicted_at", "model_version")).alias("_p"))
    wanted = latest.select(key).distinct()
    old = newest.join(wanted, key, "left_semi").select(key, "_p.*", F.lit(True).alias("reused"))
    new = scorer(latest.join(newest.select(key), key, "left_anti")).select(key, *PREDICTION_COLUMNS, F.lit(False).alias("reused"))
    return old.unionByName(new)


def backfill_actuals(predictions: DataFrame, bars: DataFrame, key: str = "ticker",
                     ts: str = "timestamp") -> DataFrame:
    """actual_direction = UP if the next close is above the predicted bar's close.

    The next close is a ``lead`` on the block layout (each block holds the first row of the next).
    """
    d = halo_blocks(number_rows(bars.select(key, ts, F.col("close").cast("double").alias("close")), key, ts), halo=0, lead=1)
    d = home_only(d.withColumn("_next", F.lead("close", 1).over(block_window(key))))
    pairs = d.filter(F.col("_next").isNotNull()).select(key, ts, "close", "_next")
    out = predictions.join(pairs, [key, ts], "left")
    actual = F.when(F.col("_next").isNull(), F.lit(None).cast("string")).when(
        F.col("_next") > F.col("close"), F.lit("UP")).otherwise(F.lit("DOWN"))
    return out.withColumn("actual_direction", actual).drop("close", "_next")
