"""Registered queries: one per SURVEY inventory item, each with its DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Every query reads the driver tables (bars are derived from ``orders``) over
whole tables; computed columns carry the same alias in both languages.
Oracle SQL is independent of the Spark code: plain windows, recursive CTEs
for the recurrences, exact quantiles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The bar view (identical text in Spark and DuckDB; see sources/tables.py).
BARS_CTE = """bars AS (
  SELECT o_orderpriority AS ticker, o_orderdate AS timestamp,
         min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
         count(*) AS volume
  FROM orders GROUP BY 1, 2)"""

# Numbered bars: position from oldest and series length.
SERIES_CTE = BARS_CTE + """,
s AS (
  SELECT ticker, timestamp, open, high, low, close, volume,
         row_number() OVER (PARTITION BY ticker ORDER BY timestamp) - 1 AS rn,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM bars)"""


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills the registries
    from tickwise.plans import queries_core  # noqa: F401
    from tickwise.plans import queries_models  # noqa: F401
    from tickwise.plans import queries_quality  # noqa: F401
    from tickwise.plans import queries_ml  # noqa: F401
    from tickwise.plans import queries_stream  # noqa: F401


def _prepared(fn):
    import functools

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tickwise.session import apply_conventions, ship_package
        apply_conventions(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered queries; each first applies the session conventions (UTC)
    and ships the package to the Python workers."""
    _load_all()
    return {name: _prepared(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)


# Feature table (K7) and training frame (J1) in SQL, built independently of the
# Spark code: recursive exponential means, plain windows, joins.
FEATURES_CTE = SERIES_CTE + """,
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
  FROM r JOIN s ON s.ticker = r.ticker AND s.rn = r.rn + 1),
fw AS (
  SELECT ticker, timestamp, close, rn, n,
    CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END AS sma_50,
    CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END AS sma_200,
    CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 + 2 * stddev_samp(close) OVER w20 END AS bollinger_upper,
    CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 - 2 * stddev_samp(close) OVER w20 END AS bollinger_lower
  FROM s
  WINDOW w50 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
feat AS (
  SELECT fw.ticker, fw.timestamp, fw.close, fw.rn, fw.n,
    CASE WHEN fw.n < 15 THEN NULL WHEN fw.rn < 13 THEN 100.0 WHEN r.l = 0 THEN 100.0
         ELSE 100 - 100 / (1 + r.g / r.l) END AS rsi_14,
    CASE WHEN fw.n >= 26 THEN r.e12 - r.e26 END AS macd,
    CASE WHEN fw.n >= 26 THEN r.sig END AS macd_signal,
    fw.bollinger_upper, fw.bollinger_lower, fw.sma_50, fw.sma_200
  FROM fw JOIN r ON fw.ticker = r.ticker AND fw.rn = r.rn),
ind AS (SELECT * FROM feat WHERE sma_200 IS NOT NULL),
tj AS (
  SELECT b.ticker, b.timestamp, b.close, i.rsi_14, i.macd, i.macd_signal, i.bollinger_upper,
         i.bollinger_lower, i.sma_50, i.sma_200
  FROM bars b JOIN ind i ON b.ticker = i.ticker AND b.timestamp = i.timestamp),
tl AS (
  SELECT *, close / lag(close, 1) OVER w - 1 AS return_1d, close / lag(close, 3) OVER w - 1 AS return_3d,
         close / lag(close, 5) OVER w - 1 AS return_5d, ln(close / lag(close, 1) OVER w) AS lr,
         lead(close, 1) OVER w AS nxt
  FROM tj WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)),
tv AS (
  SELECT *, CASE WHEN count(lr) OVER w20 = 20 THEN stddev_samp(lr) OVER w20 * sqrt(252) END AS volatility_20d,
         CASE WHEN nxt IS NULL THEN NULL ELSE CAST(nxt > close AS INTEGER) END AS target
  FROM tl WINDOW w20 AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
train AS (
  SELECT ticker, timestamp, close, rsi_14, macd, macd_signal, bollinger_upper, bollinger_lower,
         sma_50, sma_200, return_1d, return_3d, return_5d, volatility_20d, target
  FROM tv
  WHERE rsi_14 IS NOT NULL AND macd IS NOT NULL AND macd_signal IS NOT NULL
    AND bollinger_upper IS NOT NULL AND bollinger_lower IS NOT NULL AND sma_50 IS NOT NULL
    AND sma_200 IS NOT NULL AND return_1d IS NOT NULL AND return_3d IS NOT NULL
    AND return_5d IS NOT NULL AND volatility_20d IS NOT NULL AND target IS NOT NULL)"""

# Output rounding per column family (same in both languages): prices and
# exponential means 4 places, SMA 6 (exact means have at most 5 decimals),
# ratios 8.
ROUND = {"close": 4, "rsi_14": 4, "macd": 4, "macd_signal": 4, "bollinger_upper": 4,
         "bollinger_lower": 4, "sma_50": 6, "sma_200": 6, "return_1d": 8, "return_3d": 8,
         "return_5d": 8, "return_10d": 8, "volatility_20d": 8}


def sql_rounded(cols, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, {ROUND[c]}) AS {c}" if c in ROUND else f"{prefix}{c}"
                     for c in cols)
