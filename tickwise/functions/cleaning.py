"""Row-level cleaning and validation expressions (B1-B9), all JVM-side.

Missing values: pandas NaN and SQL NULL both become NULL once, at the
source (Spark orders NaN above every number, so ``NaN > 0`` would pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_COLS = ["open", "high", "low", "close"]
OHLCV = PRICE_COLS + ["volume"]


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN -> NULL for the given numeric columns."""
    for c in cols:
        df = df.withColumn(c, F.when(~F.isnan(F.col(c)), F.col(c)))
    return df


def positive_bars(df: DataFrame) -> DataFrame:
    """B1: keep rows whose open, high, low, close and volume are all > 0."""
    df = nan_to_null(df, [c for c in OHLCV if c in df.columns])
    cond = F.lit(True)
    for c in OHLCV:
        cond = cond & (F.col(c) > 0)
    return df.filter(F.coalesce(cond, F.lit(False)))


def round_bars(df: DataFrame) -> DataFrame:
    """B2: prices rounded to 4 places as decimal(12,4), volume as bigint."""
    out = df
    for c in PRICE_COLS:
        out = out.withColumn(c, F.round(F.col(c).cast("double"), 4).cast("decimal(12,4)"))
    return out.withColumn("volume", F.col("volume").cast("bigint"))


def normalize_ticker(col: Column) -> Column:
    """``upper(trim(ticker))``; empty or blank becomes NULL (rejected)."""
    t = F.upper(F.trim(col))
    return F.when(F.length(t) > 0, t)


def parse_timestamp(col: Column) -> Column:
    """ISO-8601 text (offset form or bare date) -> timestamp; NULL on failure."""
    return F.coalesce(F.try_to_timestamp(col),
                      F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                      F.try_to_timestamp(col, F.lit("yyyy-MM-dd")))


# Message contract. Every field is read as text, then checked.
MESSAGE_FIELDS = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]


def apply_contract(df: DataFrame, raw: str = "value") -> DataFrame:
    """Message contract on the JSON text column ``raw``.

    Adds (ticker, timestamp, open..close, volume, error). Rules: JSON object
    with all 7 fields non-null; ticker non-blank (upper-cased); timestamp
    parses; prices numeric (numeric strings accepted) and > 0, then rounded to
    4 places (checked before rounding, so 0.00001 passes as 0.0); volume
    integral and > 0 (1000000.0 passes, 1.5 fails); extra fields ignored.
    ``error`` names the first failed rule, NULL when valid; the typed
    columns are NULL for rejected messages.

    Staged projections: the JSON is parsed once and each field typed once
    (Spark does not hoist common subexpressions out of conditional branches,
    and it does not collapse projections that would duplicate ``from_json``).
    """
    schema = "struct<" + ",".join(f"{f}:string" for f in MESSAGE_FIELDS) + ">"
    d = df.withColumn("_m", F.from_json(F.col(raw), schema)).withColumn(
        "_obj", F.coalesce(F.trim(F.col(raw)).startswith("{"), F.lit(False)) & F.col("_m").isNotNull())
    missing = F.lit(False)
    for k in MESSAGE_FIELDS:
        missing = missing | F.col(f"_m.{k}").isNull()
    d = d.select("*", missing.alias("_miss"),
                 normalize_ticker(F.col("_m.ticker")).alias("_t"),
                 parse_timestamp(F.col("_m.timestamp")).alias("_ts"),
                 *[F.col(f"_m.{k}").try_cast("decimal(38,10)").alias(f"_d_{k}")
                   for k in PRICE_COLS + ["volume"]])
    bad_price = F.lit(False)
    for k in PRICE_COLS:
        bad_price = bad_price | F.col(f"_d_{k}").isNull() | (F.col(f"_d_{k}") <= 0)
    vol = F.col("_d_volume")
    bad_volume = vol.isNull() | (vol != F.floor(vol)) | (vol <= 0)
    error = (F.when(~F.col("_obj"), F.lit("not_a_json_object"))
             .when(F.col("_miss"), F.lit("missing_field"))
             .when(F.col("_t").isNull(), F.lit("empty_ticker"))
             .when(F.col("_ts").isNull(), F.lit("bad_timestamp"))
             .when(bad_price, F.lit("bad_price"))
             .when(bad_volume, F.lit("bad_volume")))
    d = d.withColumn("error", error)
    ok = F.col("error").isNull()
    helpers = ["_m", "_obj", "_miss", "_t", "_ts"] + [f"_d_{k}" for k in PRICE_COLS + ["volume"]]
    return d.select(*[c for c in df.columns],
                    F.when(ok, F.col("_t")).alias("ticker"), F.when(ok, F.col("_ts")).alias("timestamp"),
                    *[F.when(ok, F.round(F.col(f"_d_{k}").cast("double"), 4)).alias(k) for k in PRICE_COLS],
                    F.when(ok, vol.cast("bigint")).alias("volume"), "error").drop(*helpers)
