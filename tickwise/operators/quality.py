"""Data-quality checks (D1-D7) and the constraint audit.

The reference runs 1 + k SQL scans per table; here each check is one
aggregate pass (partial aggregation on every mapper), and the gate is a
small checks DataFrame (check, value, threshold, severity, passed).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values from the reference: gate thresholds.
MAX_NULL_PERCENT = 5.0
MAX_STALENESS_HOURS = 48.0
OUTLIER_STD_THRESHOLD = 3.0
MIN_ROWS = 1000
PRICE_TABLE_COLUMNS = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]


class DataQualityError(Exception):
    """A critical check failed."""


def null_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, null_count, total, null_pct, passed); no rows -> empty result."""
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot("_total", cols, "column", "null_count")
    return (long.filter(F.col("_total") > 0)
            .select("column", F.col("null_count").cast("long").alias("null_count"),
                    F.col("_total").cast("long").alias("total"),
                    (F.col("null_count") * 100.0 / F.col("_total")).alias("null_pct"))
            .withColumn("passed", F.col("null_pct") <= MAX_NULL_PERCENT))


def _hours_between(now, latest):
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / 3.6e9


def freshness(df: DataFrame, now, ts: str = "timestamp") -> DataFrame:
    """Hours since max(ts) at ``now``; no rows or > 48 h fails."""
    latest = F.max(ts)
    hours = _hours_between(F.lit(now), latest)
    return df.agg(latest.alias("last_update"), hours.alias("staleness_hours")).withColumn(
        "passed", F.coalesce(F.col("staleness_hours") <= MAX_STALENESS_HOURS, F.lit(False)))


def row_count(df: DataFrame, min_expected: int = MIN_ROWS) -> DataFrame:
    """D3: row count against a minimum."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "passed", F.col("row_count") >= min_expected)


def outlier_counts(df: DataFrame, key: str = "ticker", price: str = "close",
                   k: float = OUTLIER_STD_THRESHOLD) -> DataFrame:
    """Rows with |close - mean| > k * sample std, per key; keys with none omitted.

    Per-key stats are a grouped aggregate (one row per key) joined back on the
    key; AQE broadcasts it when its measured size is small. A key with zero or
    undefined std never matches (strict comparison / NULL).
    """
    x = F.col(price).cast("double")
    stats = df.groupBy(key).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std"))
    hits = (df.select(key, x.alias("_x")).join(stats, key)
            .filter(F.abs(F.col("_x") - F.col("_mean")) > k * F.col("_std")))
    return hits.groupBy(key).agg(F.count(F.lit(1)).alias("outlier_count"))


def quality_gate(df: DataFrame, now, cols: list[str] | None = None, min_rows: int = MIN_ROWS,
                 ts: str = "timestamp", key: str = "ticker", price: str = "close") -> DataFrame:
    """Checks table in run order. Critical: nulls, freshness, rows; outliers warn.

    One aggregate pass computes total, null counts and max(ts); the outlier
    check is the grouped D4 plan. ``enforce`` raises on the first failure.
    """
    cols = cols or PRICE_TABLE_COLUMNS
    agg = df.agg(F.count(F.lit(1)).alias("_total"), F.max(ts).alias("_last"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in cols])
    total = F.col("_total")
    rows = []
    for i, c in enumerate(cols):
        pct = F.when(total > 0, F.col(f"_n_{c}") * 100.0 / total)
        rows.append(F.struct(F.lit(i).alias("ord"), F.lit(f"null_rate:{c}").alias("check"),
                             pct.alias("value"), F.lit(MAX_NULL_PERCENT).alias("threshold"),
                             F.lit("critical").alias("severity"),
                             F.coalesce(pct <= MAX_NULL_PERCENT, F.lit(True)).alias("passed")))
    hours = _hours_between(F.lit(now), F.col("_last"))
    rows.append(F.struct(F.lit(len(cols)).alias("ord"), F.lit("freshness_hours").alias("check"),
                         hours.alias("value"), F.lit(MAX_STALENESS_HOURS).alias("threshold"),
                         F.lit("critical").alias("severity"),
                         F.coalesce(hours <= MAX_STALENESS_HOURS, F.lit(False)).alias("passed")))
    rows.append(F.struct(F.lit(len(cols) + 1).alias("ord"), F.lit("row_count").alias("check"),
                         total.cast("double").alias("value"),
                         F.lit(float(min_rows)).alias("threshold"),
                         F.lit("critical").alias("severity"), (total >= min_rows).alias("passed")))
    base = agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    out = outlier_counts(df, key, price).agg(
        F.coalesce(F.sum("outlier_count"), F.lit(0)).cast("double").alias("value"))
    warn = out.select(F.lit(len(cols) + 2).alias("ord"), F.lit("outliers").alias("check"),
                      "value", F.lit(OUTLIER_STD_THRESHOLD).alias("threshold"),
                      F.lit("warning").alias("severity"), F.lit(True).alias("passed"))
    return base.unionByName(warn)


def enforce(checks: DataFrame) -> DataFrame:
    """Raise on the first failed critical check (run order), else return checks."""
    failed = (checks.filter((F.col("severity") == "critical") & ~F.col("passed"))
              .orderBy("ord").limit(1).collect())
    if failed:
        r = failed[0]
        raise DataQualityError(f"{r['check']} failed: value {r['value']} vs {r['threshold']}")
    return checks


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count) for several tables in one union plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def constraint_audit(tables: dict[str, DataFrame], unique: dict[str, list[str]],
                     not_null: dict[str, list[str]], checks: dict[str, dict[str, str]],
                     single_true: dict[str, str] | None = None) -> DataFrame:
    """Violations as rows (table, constraint, detail, n).

    unique -> grouped count > 1 per key (partial aggregation);
    not_null -> count_if(col IS NULL); checks -> count_if(NOT (expr));
    single_true -> more than one row with the flag set.
    """
    parts = []
    for t, keys in unique.items():
        dup = (tables[t].groupBy(*keys).count().filter("count > 1")
               .agg(F.count(F.lit(1)).alias("n")))
        parts.append(dup.select(F.lit(t).alias("table"), F.lit("unique").alias("constraint"),
                                F.lit(",".join(keys)).alias("detail"), F.col("n").cast("long")))
    for t, cols in not_null.items():
        agg = tables[t].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(agg.unpivot([], cols, "detail", "n").select(
            F.lit(t).alias("table"), F.lit("not_null").alias("constraint"), "detail",
            F.col("n").cast("long")))
    for t, exprs in checks.items():
        agg = tables[t].agg(*[F.count_if(~F.coalesce(F.expr(e), F.lit(True))).alias(name)
                              for name, e in exprs.items()])
        parts.append(agg.unpivot([], list(exprs), "detail", "n").select(
            F.lit(t).alias("table"), F.lit("check").alias("constraint"), "detail",
            F.col("n").cast("long")))
    for t, flag in (single_true or {}).items():
        agg = tables[t].agg(F.count_if(F.col(flag)).alias("n"))
        parts.append(agg.select(F.lit(t).alias("table"), F.lit("single_active").alias("constraint"),
                                F.lit(flag).alias("detail"),
                                F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0).cast("long")
                                .alias("n")))
    return reduce(DataFrame.unionByName, parts)
