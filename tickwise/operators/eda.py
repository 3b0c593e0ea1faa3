"""Exploratory reports (D15-D22), grouped by ticker, in long form.

Every report is one or two aggregate passes over the training frame for all
tickers at once; medians use the distributed exact quantile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.stats import exact_quantiles, kurt_unbiased, skew_unbiased

# Fixed values from the reference.
BALANCED_RATIO = 0.7
HIGH_CORRELATION = 0.8
OUTLIER_Z = 3.0
MINORITY_WARN_PCT = 30.0


def _pandas_dtype(dt: str) -> str:
    return {"double": "float64", "float": "float32", "bigint": "int64", "int": "int32",
            "string": "object", "timestamp": "datetime64[ns, UTC]",
            "timestamp_ntz": "datetime64[ns]", "boolean": "bool"}.get(dt, dt)


def missing_report(df: DataFrame, group: list[str]) -> DataFrame:
    """(group, column, missing_count, missing_pct 2dp, dtype)."""
    cols = [c for c in df.columns if c not in group]
    agg = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_total"),
                                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot(group + ["_total"], cols, "column", "missing_count")
    types = dict(df.dtypes)
    dtype = F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(_pandas_dtype(types[c])))]),
                         F.col("column"))
    return long.select(*group, "column", F.col("missing_count").cast("long"),
                       F.round(F.when(F.col("_total") > 0, F.col("missing_count") * 100.0
                                      / F.col("_total")).otherwise(0.0), 2).alias("missing_pct"),
                       dtype.alias("dtype"))


def duplicate_report(df: DataFrame, group: list[str]) -> DataFrame:
    """Total, duplicate rows (all columns, first kept), unique, pct (2dp).

    ``groupBy(all columns).count()`` pre-aggregates copies on each mapper, so
    a hot group of identical rows is reduced before the shuffle.
    """
    cnt = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    g = cnt.groupBy(*group).agg(F.sum("_c").alias("total_rows"),
                                F.sum(F.col("_c") - 1).alias("duplicate_rows"))
    return g.select(*group, F.col("total_rows").cast("long"),
                    F.col("duplicate_rows").cast("long"),
                    (F.col("total_rows") - F.col("duplicate_rows")).cast("long").alias("unique_rows"),
                    F.round(F.col("duplicate_rows") * 100.0 / F.col("total_rows"), 2)
                    .alias("duplicate_pct"))


def class_balance(df: DataFrame, group: list[str], target: str = "target") -> DataFrame:
    """up/down counts and shares, ratio = min/max (4dp), balanced if ratio > 0.7."""
    g = df.groupBy(*group).agg(F.count_if(F.col(target) == 1).alias("up_days"),
                               F.count_if(F.col(target) == 0).alias("down_days"),
                               F.count(F.lit(1)).alias("_n"))
    ratio = F.coalesce(F.try_divide(F.least("up_days", "down_days").cast("double"),
                                    F.greatest("up_days", "down_days")), F.lit(0.0))
    return g.select(*group, F.col("up_days").cast("long"), F.col("down_days").cast("long"),
                    F.round(F.col("up_days") * 100.0 / F.col("_n"), 2).alias("up_pct"),
                    F.round(F.col("down_days") * 100.0 / F.col("_n"), 2).alias("down_pct"),
                    F.round(ratio, 4).alias("balance_ratio"),
                    (ratio > BALANCED_RATIO).alias("is_balanced"))


def _long_features(df: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    return df.select(*group, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        group, features, "feature", "x")


def distributions(df: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """Mean, std (sample), min, max, median, skewness, kurtosis (G1/G2), range.

    NULLs ignored; features with no values are omitted. One pass over the
    long (group, feature, x) form plus the distributed median.
    """
    long = _long_features(df, group, features).filter(F.col("x").isNotNull())
    x = F.col("x")
    agg = long.groupBy(*group, "feature").agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        F.max(x).alias("max"), skew_unbiased(x).alias("skewness"),
        kurt_unbiased(x).alias("kurtosis"))
    med = exact_quantiles(long, "x", [0.5], group + ["feature"]).select(
        *group, "feature", F.col("quantile").alias("median"))
    out = agg.join(med, group + ["feature"])
    return out.select(*group, "feature", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max", "median")],
                      F.round("skewness", 4).alias("skewness"), F.round("kurtosis", 4).alias("kurtosis"),
                      F.round(F.col("max") - F.col("min"), 6).alias("range"))


def correlations(df: DataFrame, group: list[str], features: list[str],
                 target: str = "target") -> DataFrame:
    """Pearson r for every feature pair (i < j) and feature->target, one aggregate.

    Pairwise NULL deletion as pandas does. Rows: (group, feature_1, feature_2,
    correlation 4dp, kind) with kind 'high_pair' (|r| > 0.8) or 'target'.
    """
    def pair_r(a, b):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")))
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    exprs = [pair_r(a, b).alias(f"{a}|{b}") for a, b in pairs]
    exprs += [pair_r(a, target).alias(f"{a}|{target}") for a in features]
    agg = df.groupBy(*group).agg(*exprs)
    names = [f"{a}|{b}" for a, b in pairs] + [f"{a}|{target}" for a in features]
    long = agg.unpivot(group, names, "pair", "r")
    f1, f2 = F.split("pair", r"\|").getItem(0), F.split("pair", r"\|").getItem(1)
    kind = F.when(f2 == target, F.lit("target")).otherwise(F.lit("high_pair"))
    out = long.select(*group, f1.alias("feature_1"), f2.alias("feature_2"),
                      F.round("r", 4).alias("correlation"), kind.alias("kind"), "r")
    return out.filter((F.col("kind") == "target") | (F.abs("r") > HIGH_CORRELATION)).drop("r")


def zscore_outliers(df: DataFrame, group: list[str], features: list[str],
                    threshold: float = OUTLIER_Z) -> DataFrame:
    """Per feature, rows with |x - mean| / sample std > 3; std 0 or no data -> 0."""
    long = _long_features(df, group, features)
    stats = long.groupBy(*group, "feature").agg(F.avg("x").alias("_m"),
                                                F.stddev_samp("x").alias("_s"),
                                                F.count("x").alias("_n"))
    z = F.abs(F.try_divide(F.col("x") - F.col("_m"), F.col("_s")))
    hit = F.when((F.col("_s") > 0) & (z > threshold), 1).otherwise(0)
    j = long.join(stats, group + ["feature"])
    agg = j.groupBy(*group, "feature").agg(F.sum(hit).alias("outlier_count"),
                                           F.first("_n").alias("_n"))
    return agg.select(*group, "feature", F.col("outlier_count").cast("long"),
                      F.round(F.coalesce(F.try_divide(F.col("outlier_count") * 100.0, F.col("_n")),
                                         F.lit(0.0)), 2).alias("outlier_pct"))


def eda_summary(df: DataFrame, group: list[str], ts: str = "timestamp") -> DataFrame:
    """D21 header: total rows and date range per group."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("total_rows"),
                                  F.min(ts).alias("start"), F.max(ts).alias("end"))


def eda_report(df: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """All sections as (group, section, item, metric, value) rows; dates as epoch seconds."""
    def melt(section: str, frame: DataFrame, item: str | None, metrics: list[str]) -> DataFrame:
        it = F.col(item).cast("string") if item else F.lit(None).cast("string")
        return frame.select(*group, F.lit(section).alias("section"), it.alias("item"),
                            *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
            group + ["section", "item"], metrics, "metric", "value")
    parts = [
        melt("summary", eda_summary(df, group).withColumns(
            {c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6 for c in ("start", "end")}),
             None, ["total_rows", "start", "end"]),
        melt("missing", missing_report(df, group), "column", ["missing_count", "missing_pct"]),
        melt("duplicates", duplicate_report(df, group), None,
             ["total_rows", "duplicate_rows", "unique_rows", "duplicate_pct"]),
        melt("class_balance", class_balance(df, group), None,
             ["up_days", "down_days", "up_pct", "down_pct", "balance_ratio"]),
        melt("distribution", distributions(df, group, features), "feature",
             ["mean", "std", "min", "max", "median", "skewness", "kurtosis", "range"]),
        melt("outliers", zscore_outliers(df, group, features), "feature",
             ["outlier_count", "outlier_pct"]),
        melt("correlation", correlations(df, group, features).withColumn(
            "pair", F.concat_ws("|", "feature_1", "feature_2")), "pair", ["correlation"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def frame_quality_report(df: DataFrame, group: list[str], features: list[str],
                         target: str = "target") -> DataFrame:
    """Missing, duplicate and infinite counts, minority share, warning texts."""
    n = F.count(F.lit(1))
    inf = [F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias(f"_i_{c}") for c in features]
    miss = [F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in features]
    agg = df.groupBy(*group).agg(n.alias("original_rows"), *inf, *miss,
                                 F.avg(F.col(target).cast("double")).alias("_up"))
    dup = duplicate_report(df, group).select(*group, F.col("duplicate_rows").alias("duplicates"))
    a = agg.join(dup, group, "left")
    minority = F.least(F.col("_up"), 1 - F.col("_up")) * 100.0
    # a one-class frame has a single class share of 100 %, so no warning
    minority = F.when((F.col("_up") == 0) | (F.col("_up") == 1), F.lit(100.0)).otherwise(minority)
    # fixed values: message texts that users of the reference match on
    warns = [F.when(F.col(f"_m_{c}") > 0, F.format_string(
        "'%s' has %d missing values (%.1f%%)", F.lit(c), F.col(f"_m_{c}"),
        F.col(f"_m_{c}") * 100.0 / F.col("original_rows"))) for c in features]
    warns.append(F.when(F.col("duplicates") > 0, F.format_string("%d duplicate rows found",
                                                                  F.col("duplicates"))))
    warns += [F.when(F.col(f"_i_{c}") > 0, F.format_string("'%s' has %d infinite values", F.lit(c),
                                                           F.col(f"_i_{c}"))) for c in features]
    warns.append(F.when(minority < MINORITY_WARN_PCT, F.format_string(
        "Class imbalance detected: minority class is %.1f%%", minority)))
    return a.select(*group, "original_rows",
                    sum((F.col(f"_m_{c}") for c in features), F.lit(0)).cast("long").alias("missing_values"),
                    F.col("duplicates").cast("long"),
                    sum((F.col(f"_i_{c}") for c in features), F.lit(0)).cast("long").alias("infinite_values"),
                    F.round(minority, 4).alias("minority_pct"),
                    (F.col("original_rows") - F.col("duplicates")).cast("long").alias("final_rows"),
                    F.concat_ws("; ", *warns).alias("warnings"))
