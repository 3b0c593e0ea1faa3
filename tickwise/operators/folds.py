"""E13 walk-forward folds and E14 holdout tail.

A fold f covers rows [21 f, 21 f + 273) of a ticker's training frame: the
first 252 train, the next 21 test; only complete folds exist; order is
never shuffled. Row ``rn`` belongs to folds
``max(0, ceil((rn - 272) / 21)) .. min(rn div 21, (n - 273) div 21)`` when
``n >= 273``, so the assignment is one ``explode(sequence(...))`` per row
(at most 13 copies) and every (ticker, fold) group has exactly 273 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators.series import newest_rows, number_rows, with_length

# Fixed values from the reference: walk-forward sizes and holdout length.
TRAIN_WINDOW = 252
TEST_WINDOW = 21
BACKTEST_DAYS = 126


def assign_folds(frame: DataFrame, train: int = TRAIN_WINDOW, test: int = TEST_WINDOW,
                 key: str = "ticker", ts: str = "timestamp", numbered: bool = False) -> DataFrame:
    """Rows (…, fold, split, rn, n) for every (row, fold) membership."""
    d = frame if numbered else number_rows(frame, key, ts)
    size = train + test
    rn, n = F.col("rn"), F.col("n")
    lo = F.greatest(F.lit(0), F.ceil((rn - (size - 1)) / test)).cast("int")
    hi = F.least(F.floor(rn / test), F.floor((n - size) / test)).cast("int")
    folds = F.when((n >= size) & (lo <= hi), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    out = d.withColumn("fold", F.explode(folds))
    return out.withColumn("split", F.when(rn - F.col("fold") * test < train, F.lit("train"))
                          .otherwise(F.lit("test")))


def holdout_tail(frame: DataFrame, rows: int = BACKTEST_DAYS, key: str = "ticker",
                 ts: str = "timestamp") -> DataFrame:
    """Last ``rows`` rows per key, with ``rn`` and ``n``."""
    d = with_length(newest_rows(frame, rows, key, ts), frame, key)
    return d.withColumn("rn", F.col("n") - 1 - F.col("_back")).drop("_back")
