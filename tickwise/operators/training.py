"""Training frame (J1) with the next-day target.

J1 = bars JOIN indicators (C1) on (ticker, timestamp); lag returns 1/3/5 and
20-day volatility are computed on the *joined* rows (as the reference does,
so the first rows after the SMA-200 warm-up lose their lags); target =
``close[t+1] > close[t]``; rows with any NULL are dropped (B9).

By default the last row of each ticker has no target and is dropped;
``legacy_last_row=True`` gives it 0 like the reference's NaN comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import indicators as ind
from tickwise.session import materialize
from tickwise.operators.series import block_window, halo_blocks, home_only, number_rows

TRAIN_COLUMNS = ["ticker", "timestamp", "close"] + ind.FEATURE_COLUMNS + ["target"]


def add_target(d: DataFrame, key: str = "ticker", legacy_last_row: bool = False) -> DataFrame:
    """E2 on a layout built with ``lead=1``."""
    nxt = F.lead("close", 1).over(block_window(key))
    tgt = F.when(nxt.isNull(), F.lit(0) if legacy_last_row else F.lit(None).cast("int")) \
        .otherwise((nxt > F.col("close")).cast("int"))
    return d.withColumn("target", tgt)


def join_bars_indicators(bars: DataFrame, indicators: DataFrame) -> DataFrame:
    """Inner equi-join on (ticker, timestamp), close as double."""
    b = bars.select("ticker", "timestamp", F.col("close").cast("double").alias("close"))
    i = indicators.select("ticker", "timestamp", *ind.INDICATOR_COLUMNS)
    return b.join(i, ["ticker", "timestamp"])


def training_frame(bars: DataFrame, indicators: DataFrame | None = None,
                   legacy_last_row: bool = False, drop_nulls: bool = True,
                   bucket: str = "year", checkpoint: bool = True) -> DataFrame:
    """J1 for all tickers at once.

    With ``indicators`` given (a stored table), this is the C1 join followed
    by lags, volatility and target on the joined rows. Without, the
    indicators come from the same bars, so the joined rows are exactly the
    rows from position 199 on (where SMA-200 exists) and everything is
    computed in the indicator layout itself: lags, log returns and the
    target only look at rows inside that range, which equals recomputing
    them on the joined frame, without the join and a second numbering.
    """
    if indicators is None:
        return _training_frame_one_pass(bars, legacy_last_row, drop_nulls, bucket, checkpoint)
    joined = join_bars_indicators(bars, indicators)
    d = halo_blocks(number_rows(joined, "ticker", "timestamp", bucket), halo=20, lead=1)
    d = ind.add_lag_returns(d, [1, 3, 5])
    d = ind.add_volatility(d)
    d = add_target(d, legacy_last_row=legacy_last_row)
    out = home_only(d).select(*TRAIN_COLUMNS)
    out = out.na.drop(how="any") if drop_nulls else out
    return materialize(out) if checkpoint else out


WARMUP = 199   # rows before SMA-200 exists


def _training_frame_one_pass(bars: DataFrame, legacy_last_row: bool, drop_nulls: bool,
                             bucket: str, checkpoint: bool) -> DataFrame:
    from tickwise.operators.series import RN, trailing
    base = bars.select("ticker", "timestamp", F.col("close").cast("double").alias("close"))
    d = halo_blocks(number_rows(base, "ticker", "timestamp", bucket), halo=ind.MAX_HALO, lead=1)
    d = ind.add_indicators(d, lags=[1])
    w = block_window("ticker")
    rn = F.col(RN)
    for k in (1, 3, 5):
        d = d.withColumn(f"return_{k}d", F.when(rn - k >= WARMUP, F.try_divide(
            F.col("close"), F.lag("close", k).over(w)) - 1.0))
    d = d.withColumn("_lr", F.when(rn - 1 >= WARMUP, F.ln(F.try_divide(
        F.col("close"), F.lag("close", 1).over(w)))))
    fr = trailing("ticker", 20)
    d = d.withColumn("volatility_20d", F.when(F.count("_lr").over(fr) == 20,
                                              F.stddev_samp("_lr").over(fr)) * ind.SQRT_252)
    d = add_target(d, legacy_last_row=legacy_last_row)
    out = home_only(d).filter(rn >= WARMUP).select(*TRAIN_COLUMNS)
    out = out.na.drop(how="any") if drop_nulls else out
    return materialize(out) if checkpoint else out
