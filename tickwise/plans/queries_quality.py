"""Registered queries: feature table, training frame, quality gate, audit, EDA (K7, J1, D, A11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import eda, quality
from tickwise.operators import indicators as ind
from tickwise.operators.training import training_frame
from tickwise.plans.catalog import BARS_CTE, FEATURES_CTE, ROUND, register, sql_rounded
from tickwise.sources.tables import bars, table

NOW = "2001-08-03 12:00:00"   # explicit clock for freshness checks
TRAIN_COLS = ["ticker", "timestamp", "close"] + ind.FEATURE_COLUMNS + ["target"]
FEATURE_TABLE_COLS = ["ticker", "timestamp", "close"] + ind.INDICATOR_COLUMNS + [
    "return_1d", "return_3d", "return_5d", "return_10d", "volatility_20d"]


def rounded(df, cols):
    return df.select(*[F.round(c, ROUND[c]).alias(c) if c in ROUND else F.col(c) for c in cols])


def _train(spark, sf_dir):
    return training_frame(bars(spark, sf_dir))


# ---------------------------------------------------------------- K7 feature table
@register("K7_feature_table", f"""
WITH RECURSIVE {FEATURES_CTE},
lagged AS (
  SELECT feat.*, close / lag(close, 1) OVER w - 1 AS return_1d, close / lag(close, 3) OVER w - 1 AS return_3d,
         close / lag(close, 5) OVER w - 1 AS return_5d, close / lag(close, 10) OVER w - 1 AS return_10d,
         ln(close / lag(close, 1) OVER w) AS lr
  FROM feat WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)),
vol AS (
  SELECT *, CASE WHEN count(lr) OVER w20 = 20 THEN stddev_samp(lr) OVER w20 * sqrt(252) END AS volatility_20d
  FROM lagged WINDOW w20 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT {sql_rounded(FEATURE_TABLE_COLS)} FROM vol WHERE sma_200 IS NOT NULL
""")
def k7_feature_table(spark, sf_dir):
    """K7: every indicator for all tickers, warm-up rows dropped."""
    f = ind.technical_features(bars(spark, sf_dir), keep_warmup=False, checkpoint=False)
    return rounded(f, FEATURE_TABLE_COLS)


@register("K7_rows_per_ticker", f"""
WITH RECURSIVE {FEATURES_CTE}
SELECT ticker, count(*) AS n FROM ind GROUP BY ticker
""")
def k7_rows_per_ticker(spark, sf_dir):
    """K7 summary: feature rows produced per ticker."""
    f = ind.technical_features(bars(spark, sf_dir), keep_warmup=False, checkpoint=False)
    return f.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- J1 training frame
@register("J1_training_frame", f"""
WITH RECURSIVE {FEATURES_CTE}
SELECT {sql_rounded(TRAIN_COLS)} FROM train
""")
def j1_training_frame(spark, sf_dir):
    return rounded(_train(spark, sf_dir), TRAIN_COLS)


_C1 = ["ticker", "timestamp", "close"] + ind.INDICATOR_COLUMNS


@register("C1_bars_join_indicators", f"""
WITH RECURSIVE {FEATURES_CTE}
SELECT {sql_rounded(_C1)} FROM tj
""")
def c1_join(spark, sf_dir):
    from tickwise.operators.training import join_bars_indicators
    b = bars(spark, sf_dir)
    return rounded(join_bars_indicators(b, ind.technical_features(b, keep_warmup=False, checkpoint=False)), _C1)


# ---------------------------------------------------------------- D1-D7 quality
_COLS = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]


@register("D1_null_rates", f"""
WITH {BARS_CTE}
SELECT * FROM (
  SELECT 'ticker' AS column, count(*) FILTER (WHERE ticker IS NULL) AS null_count, count(*) AS total FROM bars
  UNION ALL SELECT 'timestamp', count(*) FILTER (WHERE timestamp IS NULL), count(*) FROM bars
  UNION ALL SELECT 'open', count(*) FILTER (WHERE open IS NULL), count(*) FROM bars
  UNION ALL SELECT 'high', count(*) FILTER (WHERE high IS NULL), count(*) FROM bars
  UNION ALL SELECT 'low', count(*) FILTER (WHERE low IS NULL), count(*) FROM bars
  UNION ALL SELECT 'close', count(*) FILTER (WHERE close IS NULL), count(*) FROM bars
  UNION ALL SELECT 'volume', count(*) FILTER (WHERE volume IS NULL), count(*) FROM bars
) x, LATERAL (SELECT null_count * 100.0 / total AS null_pct, null_count * 100.0 / total <= 5.0 AS passed)
WHERE total > 0
""")
def d1_null_rates(spark, sf_dir):
    return quality.null_rates(bars(spark, sf_dir), _COLS)


_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


def _null_rate_sql(source: str, cols: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total FROM {source}"
                              for c in cols)
    return f"""SELECT * FROM ({rows}) x,
LATERAL (SELECT null_count * 100.0 / total AS null_pct, null_count * 100.0 / total <= 5.0 AS passed) WHERE total > 0"""


@register("D1_null_rates_lineitem", _null_rate_sql("lineitem", _LINEITEM))
def d1_null_rates_lineitem(spark, sf_dir):
    """Null rates of every column of ``lineitem``."""
    return quality.null_rates(table(spark, sf_dir, "lineitem"), _LINEITEM)


@register("D2_freshness", f"""
WITH {BARS_CTE}
SELECT max(timestamp) AS last_update,
       (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(timestamp))) / 3.6e9 AS staleness_hours,
       coalesce((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(timestamp))) / 3.6e9 <= 48, false) AS passed
FROM bars
""")
def d2_freshness(spark, sf_dir):
    return quality.freshness(bars(spark, sf_dir), NOW)


@register("D3_row_count", """
SELECT count(*) AS row_count, count(*) >= 1000 AS passed FROM lineitem
""")
def d3_row_count(spark, sf_dir):
    return quality.row_count(table(spark, sf_dir, "lineitem"))


@register("D4_outliers", f"""
WITH {BARS_CTE},
st AS (SELECT ticker, avg(close) AS m, stddev_samp(close) AS sd FROM bars GROUP BY ticker)
SELECT b.ticker, count(*) AS outlier_count FROM bars b JOIN st ON b.ticker = st.ticker
WHERE abs(b.close - st.m) > 3 * st.sd GROUP BY b.ticker
""")
def d4_outliers(spark, sf_dir):
    return quality.outlier_counts(bars(spark, sf_dir))


@register("D4_outliers_lineitem", """
WITH st AS (SELECT l_returnflag, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd
            FROM lineitem GROUP BY 1)
SELECT l.l_returnflag, count(*) AS outlier_count FROM lineitem l JOIN st USING (l_returnflag)
WHERE abs(l.l_extendedprice - st.m) > 3 * st.sd GROUP BY 1
""")
def d4_outliers_lineitem(spark, sf_dir):
    return quality.outlier_counts(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")


@register("D4_outliers_low_bound", f"""
WITH {BARS_CTE},
st AS (SELECT ticker, avg(close) AS m, stddev_samp(close) AS sd FROM bars GROUP BY ticker)
SELECT b.ticker, count(*) AS outlier_count FROM bars b JOIN st ON b.ticker = st.ticker
WHERE abs(b.close - st.m) > 1.5 * st.sd GROUP BY b.ticker
""")
def d4_outliers_low_bound(spark, sf_dir):
    """D4 at a bound that the bars do exceed (1.5 standard deviations)."""
    return quality.outlier_counts(bars(spark, sf_dir), k=1.5)


@register("D6_quality_gate", f"""
WITH {BARS_CTE},
a AS (SELECT count(*) AS total, max(timestamp) AS last FROM bars),
o AS (SELECT count(*) AS n FROM bars b JOIN (SELECT ticker, avg(close) m, stddev_samp(close) sd FROM bars GROUP BY 1) st
      ON b.ticker = st.ticker WHERE abs(b.close - st.m) > 3 * st.sd),
c AS (
  SELECT 0 AS ord, 'null_rate:ticker' AS "check", (SELECT count(*) FILTER (WHERE ticker IS NULL) * 100.0 / count(*) FROM bars) AS value FROM a
  UNION ALL SELECT 1, 'null_rate:timestamp', (SELECT count(*) FILTER (WHERE timestamp IS NULL) * 100.0 / count(*) FROM bars) FROM a
  UNION ALL SELECT 2, 'null_rate:open', (SELECT count(*) FILTER (WHERE open IS NULL) * 100.0 / count(*) FROM bars) FROM a
  UNION ALL SELECT 3, 'null_rate:high', (SELECT count(*) FILTER (WHERE high IS NULL) * 100.0 / count(*) FROM bars) FROM a
  UNION ALL SELECT 4, 'null_rate:low', (SELECT count(*) FILTER (WHERE low IS NULL) * 100.0 / count(*) FROM bars) FROM a
  UNION ALL SELECT 5, 'null_rate:close', (SELECT count(*) FILTER (WHERE close IS NULL) * 100.0 / count(*) FROM bars) FROM a
  UNION ALL SELECT 6, 'null_rate:volume', (SELECT count(*) FILTER (WHERE volume IS NULL) * 100.0 / count(*) FROM bars) FROM a)
SELECT ord, "check", value, 5.0 AS threshold, 'critical' AS severity, value <= 5.0 AS passed FROM c
UNION ALL
SELECT 7, 'freshness_hours', (epoch_us(TIMESTAMP '{NOW}') - epoch_us(last)) / 3.6e9, 48.0, 'critical',
       coalesce((epoch_us(TIMESTAMP '{NOW}') - epoch_us(last)) / 3.6e9 <= 48, false) FROM a
UNION ALL SELECT 8, 'row_count', total::DOUBLE, 1000.0, 'critical', total >= 1000 FROM a
UNION ALL SELECT 9, 'outliers', n::DOUBLE, 3.0, 'warning', true FROM o
""")
def d6_quality_gate(spark, sf_dir):
    return quality.quality_gate(bars(spark, sf_dir), NOW)


@register("D7_table_counts", """
SELECT 'orders' AS "table", count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'events', count(*) FROM events
""")
def d7_table_counts(spark, sf_dir):
    return quality.table_counts({n: table(spark, sf_dir, n)
                                 for n in ("orders", "lineitem", "customer", "events")})


@register("A11_constraint_audit", f"""
WITH {BARS_CTE}
SELECT 'bars' AS "table", 'unique' AS "constraint", 'ticker,timestamp' AS detail,
       (SELECT count(*) FROM (SELECT ticker, timestamp FROM bars GROUP BY 1, 2 HAVING count(*) > 1)) AS n
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber',
       (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
UNION ALL SELECT 'bars', 'not_null', 'close', (SELECT count(*) FILTER (WHERE close IS NULL) FROM bars)
UNION ALL SELECT 'bars', 'not_null', 'volume', (SELECT count(*) FILTER (WHERE volume IS NULL) FROM bars)
UNION ALL SELECT 'bars', 'check', 'positive_prices',
       (SELECT count(*) FILTER (WHERE NOT coalesce(open > 0 AND high > 0 AND low > 0 AND close > 0, true)) FROM bars)
UNION ALL SELECT 'bars', 'check', 'high_ge_low',
       (SELECT count(*) FILTER (WHERE NOT coalesce(high >= low, true)) FROM bars)
UNION ALL SELECT 'lineitem', 'check', 'discount_range',
       (SELECT count(*) FILTER (WHERE NOT coalesce(l_discount BETWEEN 0 AND 1, true)) FROM lineitem)
""")
def a11_constraint_audit(spark, sf_dir):
    b, li = bars(spark, sf_dir), table(spark, sf_dir, "lineitem")
    return quality.constraint_audit(
        {"bars": b, "lineitem": li},
        unique={"bars": ["ticker", "timestamp"], "lineitem": ["l_orderkey", "l_linenumber"]},
        not_null={"bars": ["close", "volume"]},
        checks={"bars": {"positive_prices": "open > 0 AND high > 0 AND low > 0 AND close > 0",
                         "high_ge_low": "high >= low"},
                "lineitem": {"discount_range": "l_discount BETWEEN 0 AND 1"}})


# ---------------------------------------------------------------- D15-D22 EDA on J1
_FEATS = ind.FEATURE_COLUMNS


_REPORTED = [c for c in TRAIN_COLS if c != "ticker"]
_DTYPES = {"timestamp": "datetime64[ns]", "target": "int32"}


@register("D15_missing_report", f"""
WITH RECURSIVE {FEATURES_CTE},
g AS (SELECT ticker, count(*) AS total, {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in _REPORTED)} FROM tv GROUP BY ticker)
{" UNION ALL ".join(f"SELECT ticker, '{c}' AS column, CAST(n_{c} AS BIGINT) AS missing_count, round(n_{c} * 100.0 / total, 2) AS missing_pct, '{_DTYPES.get(c, 'float64')}' AS dtype FROM g" for c in _REPORTED)}
""")
def d15_missing_report(spark, sf_dir):
    """Missing values of every column of the training frame."""
    return eda.missing_report(training_frame(bars(spark, sf_dir), drop_nulls=False), ["ticker"])


@register("D16_duplicates", """
SELECT l_returnflag, sum(k)::BIGINT AS total_rows, sum(k - 1)::BIGINT AS duplicate_rows,
       (sum(k) - sum(k - 1))::BIGINT AS unique_rows, round(sum(k - 1) * 100.0 / sum(k), 2) AS duplicate_pct
FROM (SELECT *, count(*) AS k FROM lineitem GROUP BY ALL) GROUP BY l_returnflag
""")
def d16_duplicates(spark, sf_dir):
    """Duplicates over all columns of ``lineitem``."""
    return eda.duplicate_report(table(spark, sf_dir, "lineitem"), ["l_returnflag"])


@register("D17_class_balance", f"""
WITH RECURSIVE {FEATURES_CTE},
g AS (SELECT ticker, count(*) FILTER (WHERE target = 1) AS up, count(*) FILTER (WHERE target = 0) AS down,
             count(*) AS n FROM train GROUP BY ticker)
SELECT ticker, up AS up_days, down AS down_days, round(up * 100.0 / n, 2) AS up_pct,
       round(down * 100.0 / n, 2) AS down_pct,
       round(coalesce(least(up, down)::DOUBLE / nullif(greatest(up, down), 0), 0), 4) AS balance_ratio,
       coalesce(least(up, down)::DOUBLE / nullif(greatest(up, down), 0), 0) > 0.7 AS is_balanced
FROM g
""")
def d17_class_balance(spark, sf_dir):
    return eda.class_balance(_train(spark, sf_dir), ["ticker"])


@register("D17_class_balance_labels", """
WITH g AS (SELECT count(*) FILTER (WHERE quality = 1) AS up, count(*) FILTER (WHERE quality = 0) AS down,
                  count(*) AS n FROM labels)
SELECT up AS up_days, down AS down_days, round(up * 100.0 / n, 2) AS up_pct, round(down * 100.0 / n, 2) AS down_pct,
       round(coalesce(least(up, down)::DOUBLE / nullif(greatest(up, down), 0), 0), 4) AS balance_ratio,
       coalesce(least(up, down)::DOUBLE / nullif(greatest(up, down), 0), 0) > 0.7 AS is_balanced FROM g
""")
def d17_class_balance_labels(spark, sf_dir):
    return eda.class_balance(table(spark, sf_dir, "labels"), [], target="quality")


_DIST_FEATS = ind.FEATURE_COLUMNS
_DIST_LIST = ", ".join(_DIST_FEATS)


@register("D18_distributions", f"""
WITH RECURSIVE {FEATURES_CTE},
l AS (SELECT ticker, feature, x FROM train UNPIVOT (x FOR feature IN ({_DIST_LIST})))
SELECT ticker, feature, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
       round(max(x), 6) AS max, round(quantile_cont(x, 0.5), 6) AS median,
       round(skewness(x), 4) AS skewness, round(kurtosis(x), 4) AS kurtosis, round(max(x) - min(x), 6) AS range
FROM l WHERE x IS NOT NULL GROUP BY ticker, feature
""")
def d18_distributions(spark, sf_dir):
    return eda.distributions(_train(spark, sf_dir), ["ticker"], _DIST_FEATS)


_PAIRS = [(a, b) for i, a in enumerate(_FEATS) for b in [*_FEATS[i + 1:], "target"]]
_CORR_COLS = ", ".join(f'corr({a}, {b}) AS "{a}|{b}"' for a, b in _PAIRS)
_CORR_NAMES = ", ".join(f'"{a}|{b}"' for a, b in _PAIRS)
_CORR_SQL = f"""c AS (SELECT ticker, {_CORR_COLS} FROM train GROUP BY ticker),
l AS (SELECT ticker, pair, r FROM c UNPIVOT (r FOR pair IN ({_CORR_NAMES}))),
cr AS (SELECT ticker, split_part(pair, '|', 1) AS feature_1, split_part(pair, '|', 2) AS feature_2, round(r, 4) AS correlation,
              CASE WHEN split_part(pair, '|', 2) = 'target' THEN 'target' ELSE 'high_pair' END AS kind
       FROM l WHERE split_part(pair, '|', 2) = 'target' OR abs(r) > 0.8)"""


@register("D19_correlations", f"""
WITH RECURSIVE {FEATURES_CTE},
{_CORR_SQL}
SELECT * FROM cr
""")
def d19_correlations(spark, sf_dir):
    """Correlations of all feature pairs and of every feature with the target."""
    return eda.correlations(_train(spark, sf_dir), ["ticker"], _FEATS)


@register("D20_zscore_outliers", f"""
WITH RECURSIVE {FEATURES_CTE},
l AS (SELECT ticker, feature, x FROM train UNPIVOT (x FOR feature IN ({_DIST_LIST}))),
st AS (SELECT ticker, feature, avg(x) AS m, stddev_samp(x) AS s, count(x) AS n FROM l GROUP BY 1, 2)
SELECT l.ticker, l.feature,
       sum(CASE WHEN st.s > 0 AND abs((l.x - st.m) / st.s) > 3 THEN 1 ELSE 0 END)::BIGINT AS outlier_count,
       round(coalesce(sum(CASE WHEN st.s > 0 AND abs((l.x - st.m) / st.s) > 3 THEN 1 ELSE 0 END) * 100.0 / nullif(max(st.n), 0), 0), 2) AS outlier_pct
FROM l JOIN st ON l.ticker = st.ticker AND l.feature = st.feature GROUP BY 1, 2
""")
def d20_zscore_outliers(spark, sf_dir):
    return eda.zscore_outliers(_train(spark, sf_dir), ["ticker"], _DIST_FEATS)


def _d21_sql() -> str:
    miss_cols = [c for c in TRAIN_COLS if c != "ticker"]
    miss = "\nUNION ALL ".join(
        f"SELECT ticker, 'missing' AS section, '{c}' AS item, 'missing_count' AS metric, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value FROM train GROUP BY ticker "
        f"UNION ALL SELECT ticker, 'missing', '{c}', 'missing_pct', "
        f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) FROM train GROUP BY ticker"
        for c in miss_cols)
    dist_metrics = {"mean": "round(avg(x), 6)", "std": "round(stddev_samp(x), 6)", "min": "round(min(x), 6)",
                    "max": "round(max(x), 6)", "median": "round(quantile_cont(x, 0.5), 6)",
                    "skewness": "round(skewness(x), 4)", "kurtosis": "round(kurtosis(x), 4)",
                    "range": "round(max(x) - min(x), 6)"}
    dist = "\nUNION ALL ".join(
        f"SELECT ticker, 'distribution', feature, '{m}', {e} FROM lf WHERE x IS NOT NULL GROUP BY ticker, feature"
        for m, e in dist_metrics.items())
    feats = ", ".join(_DIST_FEATS)
    return f"""
WITH RECURSIVE {FEATURES_CTE},
{_CORR_SQL},
lf AS (SELECT ticker, feature, x FROM train UNPIVOT (x FOR feature IN ({feats}))),
st AS (SELECT ticker, feature, avg(x) AS m, stddev_samp(x) AS s, count(x) AS n FROM lf GROUP BY 1, 2),
oc AS (SELECT lf.ticker, lf.feature,
              sum(CASE WHEN st.s > 0 AND abs((lf.x - st.m) / st.s) > 3 THEN 1 ELSE 0 END) AS k, max(st.n) AS n
       FROM lf JOIN st ON lf.ticker = st.ticker AND lf.feature = st.feature GROUP BY 1, 2),
dup AS (SELECT ticker, sum(c) AS total, sum(c - 1) AS d FROM (SELECT *, count(*) AS c FROM train GROUP BY ALL) GROUP BY 1),
cb AS (SELECT ticker, count(*) FILTER (WHERE target = 1) AS up, count(*) FILTER (WHERE target = 0) AS down,
              count(*) AS n FROM train GROUP BY 1)
SELECT ticker, 'summary' AS section, CAST(NULL AS VARCHAR) AS item, 'total_rows' AS metric,
       CAST(count(*) AS DOUBLE) AS value FROM train GROUP BY ticker
UNION ALL {miss}
UNION ALL SELECT ticker, 'duplicates', NULL, 'total_rows', total FROM dup
UNION ALL SELECT ticker, 'duplicates', NULL, 'duplicate_rows', d FROM dup
UNION ALL SELECT ticker, 'duplicates', NULL, 'unique_rows', total - d FROM dup
UNION ALL SELECT ticker, 'duplicates', NULL, 'duplicate_pct', round(d * 100.0 / total, 2) FROM dup
UNION ALL SELECT ticker, 'class_balance', NULL, 'up_days', up FROM cb
UNION ALL SELECT ticker, 'class_balance', NULL, 'down_days', down FROM cb
UNION ALL SELECT ticker, 'class_balance', NULL, 'up_pct', round(up * 100.0 / n, 2) FROM cb
UNION ALL SELECT ticker, 'class_balance', NULL, 'down_pct', round(down * 100.0 / n, 2) FROM cb
UNION ALL SELECT ticker, 'class_balance', NULL, 'balance_ratio',
       round(coalesce(least(up, down)::DOUBLE / nullif(greatest(up, down), 0), 0), 4) FROM cb
UNION ALL {dist}
UNION ALL SELECT ticker, 'outliers', feature, 'outlier_count', k FROM oc
UNION ALL SELECT ticker, 'outliers', feature, 'outlier_pct', round(coalesce(k * 100.0 / nullif(n, 0), 0), 2) FROM oc
UNION ALL SELECT ticker, 'summary', NULL, 'start', epoch_us(CAST(min(timestamp) AS TIMESTAMP)) / 1e6 FROM train GROUP BY ticker
UNION ALL SELECT ticker, 'summary', NULL, 'end', epoch_us(CAST(max(timestamp) AS TIMESTAMP)) / 1e6 FROM train GROUP BY ticker
UNION ALL SELECT ticker, 'correlation', feature_1 || '|' || feature_2, 'correlation', correlation FROM cr
"""


@register("D21_eda_report", _d21_sql())
def d21_eda_report(spark, sf_dir):
    """The composed long-form report (sections of D15-D20) per ticker."""
    return eda.eda_report(_train(spark, sf_dir), ["ticker"], _DIST_FEATS)


def _missing_warning(c: str) -> str:
    text = f"'''{c}'' has {{}} missing values ({{}}%)'"
    return f"CASE WHEN m_{c} > 0 THEN format({text}, m_{c}, printf('%.1f', m_{c} * 100.0 / original_rows)) END"


def _infinite_warning(c: str) -> str:
    text = f"'''{c}'' has {{}} infinite values'"
    return f"CASE WHEN i_{c} > 0 THEN format({text}, i_{c}) END"


def _d22_sql() -> str:
    t = ", ".join(["ticker", *_FEATS, "target"])
    miss = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS m_{c}, count(*) FILTER (WHERE isinf({c})) AS i_{c}" for c in _FEATS)
    warn = ",\n".join([*map(_missing_warning, _FEATS),
                       "CASE WHEN d.duplicates > 0 THEN format('{} duplicate rows found', d.duplicates) END",
                       *map(_infinite_warning, _FEATS)])
    return f"""
WITH RECURSIVE {FEATURES_CTE},
t AS (SELECT {t} FROM tv),
a AS (SELECT ticker, count(*) AS original_rows, {miss}, avg(target) AS up FROM t GROUP BY 1),
d AS (SELECT ticker, sum(k - 1) AS duplicates FROM (SELECT *, count(*) AS k FROM t GROUP BY ALL) GROUP BY 1)
SELECT a.ticker, original_rows, ({" + ".join(f"m_{c}" for c in _FEATS)})::BIGINT AS missing_values, d.duplicates::BIGINT AS duplicates,
       ({" + ".join(f"i_{c}" for c in _FEATS)})::BIGINT AS infinite_values,
       round(CASE WHEN up = 0 OR up = 1 THEN 100.0 ELSE least(up, 1 - up) * 100.0 END, 4) AS minority_pct,
       (original_rows - d.duplicates)::BIGINT AS final_rows,
       concat_ws('; ', {warn},
         CASE WHEN (CASE WHEN up = 0 OR up = 1 THEN 100.0 ELSE least(up, 1 - up) * 100.0 END) < 30
              THEN format('Class imbalance detected: minority class is {{}}%', printf('%.1f', least(up, 1 - up) * 100.0)) END
       ) AS warnings
FROM a JOIN d ON a.ticker = d.ticker
"""


@register("D22_frame_quality", _d22_sql())
def d22_frame_quality(spark, sf_dir):
    """Quality report of the training frame over all features."""
    f = training_frame(bars(spark, sf_dir), drop_nulls=False)
    return eda.frame_quality_report(f.select("ticker", *_FEATS, "target"), ["ticker"], _FEATS)


# ---------------------------------------------------------------- wider key (25 tickers)
from tickwise.sources.tables import WIDE_BAR_VIEW_SQL  # noqa: E402

_WIDE_BARS = "bars AS (" + WIDE_BAR_VIEW_SQL.strip() + ")"


@register("K7_feature_table_wide", "WITH RECURSIVE " + FEATURES_CTE.replace(BARS_CTE, _WIDE_BARS, 1) + f"""
SELECT {sql_rounded(["ticker", "timestamp", "close"] + ind.INDICATOR_COLUMNS)} FROM ind
""")
def k7_feature_table_wide(spark, sf_dir):
    """K7 on the 25-ticker bar view (market segment x priority)."""
    f = ind.technical_features(bars(spark, sf_dir, wide=True), keep_warmup=False, checkpoint=False)
    return rounded(f, ["ticker", "timestamp", "close"] + ind.INDICATOR_COLUMNS)
