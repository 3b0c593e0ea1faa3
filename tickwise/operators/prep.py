"""Per-fold data preparation J2-J7 for all (ticker, fold) groups at once.

Input: the fold assignment (E13) of the training frame. Every statistic is a
window aggregate over ``partitionBy(ticker, fold)`` (273 rows per group) and
the de-duplication groups by keys that include (ticker, fold), so one
shuffle on (ticker, fold) feeds all steps and no stats table is joined.

Order as in the reference: infinite values (J3) -> missing values (J2) ->
train duplicates (G3) -> IQR capping of train and min/max clipping of test
(J4/J5) -> standardisation with train mean and population std (J6).
Defaults use train statistics for the test split; ``leaky_test_impute=True``
gives the test split its own median like the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IQR_K = 1.5


def _windows(group):
    """Whole-group frame, forward running frame, and the backward running frame.

    The backward fill uses a running frame in descending order: a frame from
    the current row to the end is re-aggregated per row by Spark (quadratic),
    a running frame is incremental.
    """
    w = Window.partitionBy(*group)
    fwd = Window.partitionBy(*group).orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    bwd = Window.partitionBy(*group).orderBy(F.col("rn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return w, fwd, bwd


def fix_infinite(df: DataFrame, cols: list[str], group) -> DataFrame:
    """Where a column holds +-inf in a split, inf -> NULL, then forward
    fill and backward fill inside the split (ordinary NULLs are filled too).

    Per-split flags and fills are conditional window aggregates over the
    (ticker, fold) partition, so no separate (ticker, fold, split) shuffle.
    """
    w, fwd, bwd = _windows(group)
    is_train = F.col("split") == "train"
    keep = [c for c in df.columns if c not in cols]
    first = []
    for c in cols:
        is_inf = F.coalesce(F.abs(F.col(c)) == float("inf"), F.lit(False))
        first += [F.when(is_inf, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c),
                  is_inf.cast("int").alias(f"_inf_{c}"),
                  F.max(F.when(is_train, is_inf.cast("int"))).over(w).alias(f"_htr_{c}"),
                  F.max(F.when(~is_train, is_inf.cast("int"))).over(w).alias(f"_hte_{c}")]
    d = df.select(*keep, *first)
    filled = []
    for c in cols:
        in_tr, in_te = F.when(is_train, F.col(c)), F.when(~is_train, F.col(c))
        ff = F.when(is_train, F.last(in_tr, True).over(fwd)).otherwise(F.last(in_te, True).over(fwd))
        bf = F.when(is_train, F.last(in_tr, True).over(bwd)).otherwise(F.last(in_te, True).over(bwd))
        has = F.when(is_train, F.col(f"_htr_{c}")).otherwise(F.col(f"_hte_{c}")) > 0
        filled.append(F.when(has, F.coalesce(F.col(c), ff, bf)).otherwise(F.col(c)).alias(c))
    return d.select(*keep, *[f"_inf_{c}" for c in cols], *filled)


IMPUTE = ("median", "mean", "zero", "drop")


def impute(df: DataFrame, cols: list[str], group, strategy: str = "median",
           leaky_test_impute: bool = False) -> DataFrame:
    """NULLs become the median, the mean or zero (statistics of the train rows unless leaky), or their rows
    are dropped (``strategy="drop"``). ``_miss_<column>`` marks filled values; ``imputed_counts`` counts what was done."""
    if strategy not in IMPUTE:
        raise ValueError(f"unknown strategy {strategy!r}, one of {', '.join(IMPUTE)}")
    keep = [c for c in df.columns if c not in cols]
    if strategy == "drop":
        kept = df.na.drop(how="any", subset=cols)
        return kept.select(*keep, *[x for c in cols for x in (F.lit(0).alias(f"_miss_{c}"), F.col(c))])
    w, _, _ = _windows(group)
    is_train = F.col("split") == "train"

    def stat(x):
        if strategy == "median":
            return F.percentile(x, 0.5).over(w)
        if strategy == "mean":
            return F.avg(x).over(w)
        return F.lit(0.0)
    out = []
    for c in cols:
        tr = stat(F.when(is_train, F.col(c)))
        fill = F.when(is_train, tr).otherwise(stat(F.when(~is_train, F.col(c)))) if leaky_test_impute else tr
        out += [F.col(c).isNull().cast("int").alias(f"_miss_{c}"), F.coalesce(F.col(c), fill).alias(c)]
    return df.select(*keep, *out)


def imputed_counts(df: DataFrame, cols: list[str], group: list[str], strategy: str = "median") -> DataFrame:
    """(group..., imputed): values that ``impute`` fills in rows of a group, or the rows it drops."""
    missing = [F.col(c).isNull().cast("int") for c in cols]
    each = F.greatest(*missing, F.lit(0)) if strategy == "drop" else sum(missing, F.lit(0))
    return df.groupBy(*group).agg(F.sum(each).cast("long").alias("imputed"))


ZSCORE_K = 3.0


def cap_and_scale(df: DataFrame, cols: list[str], group, cap: bool = True,
                  scale: bool = True, method: str = "iqr") -> DataFrame:
    """J4 (fences on train: IQR, or ``method="zscore"``: mean and sample std), J5 (test clipped to capped-train min/max), J6.

    Three projections, each evaluating the window aggregates of every column
    together (one Window operator per step over the same partitioning).
    """
    w, _, _ = _windows(group)
    is_train = F.col("split") == "train"
    keep = [c for c in df.columns if c not in cols]
    if cap:
        if method not in ("iqr", "zscore"):
            raise ValueError(f"unknown cap method {method!r}")
        on_train = lambda c: F.when(is_train, F.col(c))
        if method == "iqr":
            centre = [F.percentile(on_train(c), F.array(F.lit(0.25), F.lit(0.75))).over(w).alias(f"_q_{c}") for c in cols]
        else:
            centre = [F.array(F.avg(on_train(c)).over(w), F.stddev_samp(on_train(c)).over(w)).alias(f"_q_{c}") for c in cols]
        d = df.select(*keep, *cols, *centre)
        fenced = []
        for c in cols:
            q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
            if method == "iqr":
                lo, hi = q1 - IQR_K * (q3 - q1), q3 + IQR_K * (q3 - q1)
            else:   # mean and std; a zero or undefined std caps nothing
                lo, hi = (F.when(q3 > 0, q1 + k * q3) for k in (-ZSCORE_K, ZSCORE_K))
            x = F.col(c)
            fenced.append(F.when(is_train, F.least(F.greatest(x, lo), hi)).otherwise(x).alias(c))
            fenced.append(F.coalesce((is_train & ((x < lo) | (x > hi))).cast("int"), F.lit(0)).alias(f"_cap_{c}"))
        d = d.select(*keep, *fenced)
        bounds = []
        for c in cols:
            tmin = F.min(F.when(is_train, F.col(c))).over(w)
            tmax = F.max(F.when(is_train, F.col(c))).over(w)
            bounds.append(F.when(is_train, F.col(c)).otherwise(F.least(F.greatest(F.col(c), tmin), tmax))
                          .alias(c))
        df = d.select(*keep, *[f"_cap_{c}" for c in cols], *bounds)
        keep = keep + [f"_cap_{c}" for c in cols]
    if scale:
        scaled = []
        for c in cols:
            mean = F.avg(F.when(is_train, F.col(c))).over(w)
            sd = F.stddev_pop(F.when(is_train, F.col(c))).over(w)
            scaled.append(((F.col(c) - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(c))
        df = df.select(*keep, *scaled)
    return df


def prepare_folds(folds: DataFrame, cols: list[str], group=("ticker", "fold"),
                  leaky_test_impute: bool = False, cap: bool = True, scale: bool = True,
                  cap_method: str = "iqr", strategy: str = "median"):
    """Returns (prepared rows, per-group counts).

    Counts per (ticker, fold): infinite values fixed and values imputed per
    split, train duplicates removed, train values capped.
    """
    group = list(group)
    d = folds.select(*group, "split", "rn", "timestamp", *[F.col(c).cast("double").alias(c) for c in cols],
                     "target")
    # one plan for all data: columns without gaps pass through the same windows unchanged
    d = impute(fix_infinite(d, cols, group), cols, group, strategy, leaky_test_impute)
    inf_cols = [f"_inf_{c}" for c in cols]
    miss_cols = [f"_miss_{c}" for c in cols]
    # Identical train rows (all columns) -> keep the first. A grouped
    # aggregate whose keys include (ticker, fold): it reuses the partitioning
    # of the windows (no shuffle) and combines copies before any exchange.
    # Test rows carry their row number in the key, so they are never merged.
    key_cols = group + ["split", "timestamp", *cols, "target"]
    rest = ["rn"] + inf_cols + miss_cols
    tie = F.when(F.col("split") != "train", F.col("rn")).alias("_tie")
    kept = d.groupBy(*key_cols, tie).agg(F.min_by(F.struct(*rest), F.col("rn")).alias("_r"),
                                         F.count(F.lit(1)).alias("_copies"))
    dups = kept.groupBy(*group).agg(F.sum(F.col("_copies") - 1).alias("duplicates_removed"))
    d = kept.select(*key_cols, *[F.col(f"_r.{c}").alias(c) for c in rest])
    d = cap_and_scale(d, cols, group, cap, scale, cap_method)
    cap_cols = [f"_cap_{c}" for c in cols] if cap else []
    counts = d.groupBy(*group).agg(
        F.sum(sum((F.col(c) for c in inf_cols + miss_cols), F.lit(0)) * (F.col("split") == "train").cast("int"))
        .alias("imputed_values_train"),
        F.sum(sum((F.col(c) for c in inf_cols + miss_cols), F.lit(0)) * (F.col("split") == "test").cast("int"))
        .alias("imputed_values_test"),
        F.sum(sum((F.col(c) for c in cap_cols), F.lit(0))).alias("outliers_capped"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"))
    counts = counts.join(dups, group, "left")
    out = d.drop(*inf_cols, *miss_cols, *cap_cols)
    return out, counts
