"""Bar and macro-series sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.cleaning import nan_to_null, positive_bars, round_bars

# Fixed values from the reference: legal look-back periods.
VALID_PERIODS = ["1d", "5d", "1mo", "3mo", "6mo", "1y", "2y", "5y", "10y", "ytd", "max"]
_PERIOD_INTERVAL = {"1d": "1 day", "5d": "5 days", "1mo": "1 month", "3mo": "3 months",
                    "6mo": "6 months", "1y": "1 year", "2y": "2 years", "5y": "5 years",
                    "10y": "10 years"}

VENDOR_FIELDS = ["Open", "High", "Low", "Close", "Volume"]


def melt_vendor_frame(wide: DataFrame, tickers: list[str], date_col: str = "date",
                      sep: str = "__") -> DataFrame:
    """A1: ticker-wide vendor frame (``{ticker}__{Field}`` columns) -> long bars.

    With a single requested ticker the vendor's plain layout (columns ``Open`` .. ``Volume``) is
    read too. Per ticker: rows with all fields null are dropped, then rows with null
    open or close; tickers whose columns are absent are skipped. Then B1/B2.
    The melt is a narrow ``stack`` projection: no shuffle.
    """
    if len(tickers) == 1 and all(f in wide.columns for f in VENDOR_FIELDS):
        wide = wide.withColumnsRenamed({f: f"{tickers[0]}{sep}{f}" for f in VENDOR_FIELDS})
    present = [t for t in tickers if all(f"{t}{sep}{f}" in wide.columns for f in VENDOR_FIELDS)]
    if not present:
        return wide.sparkSession.createDataFrame(
            [], "ticker string, timestamp timestamp, open decimal(12,4), high decimal(12,4), "
                "low decimal(12,4), close decimal(12,4), volume bigint")
    pieces = []
    for t in present:
        cols = {f.lower(): F.col(f"`{t}{sep}{f}`").cast("double") for f in VENDOR_FIELDS}
        pieces.append(F.struct(F.lit(t).alias("ticker"),
                               *[c.alias(k) for k, c in cols.items()]))
    long = (wide.select(F.col(date_col).alias("timestamp"), F.explode(F.array(*pieces)).alias("r"))
            .select("r.ticker", F.col("timestamp").cast("timestamp").alias("timestamp"),
                    "r.open", "r.high", "r.low", "r.close", "r.volume"))
    long = nan_to_null(long, ["open", "high", "low", "close", "volume"])
    long = long.na.drop(how="all", subset=["open", "high", "low", "close", "volume"])
    long = long.filter(F.col("open").isNotNull() & F.col("close").isNotNull())
    return round_bars(positive_bars(long))


def period_filter(df: DataFrame, period: str, asof=None, ts: str = "timestamp") -> DataFrame:
    """A2: keep rows inside the look-back ``period`` ending at ``asof``.

    ``asof`` defaults to the table's max timestamp (scalar subquery), so the
    result does not depend on the clock.
    """
    if period not in VALID_PERIODS:
        raise ValueError(f"unknown look-back {period!r}; known: {', '.join(VALID_PERIODS)}")
    if period == "max":
        return df
    end = F.lit(asof) if asof is not None else df.select(F.max(ts)).scalar()
    if period == "ytd":
        start = F.date_trunc("year", end)
    else:
        start = end - F.expr(f"INTERVAL {_PERIOD_INTERVAL[period]}")
    return df.filter(F.col(ts) >= start)


def load_macro_series(raw: DataFrame, series_map: DataFrame, start_date: str = "2020-01-01") -> DataFrame:
    """A3: (series_id, timestamp, value) -> (series_id, name, timestamp, value).

    ``series_map`` (series_id, name) is the caller's id->name list: a configuration list, whose size does not
    follow the data, so it is broadcast. A shuffle by series would send all rows of a series to one task, and
    its few keys keep AQE from a broadcast of its own (``nonEmptyPartitionRatioForBroadcastJoin``). NaN values are
    dropped and values rounded to 6 places. A series without rows simply yields none.
    """
    r = nan_to_null(raw, ["value"]).filter(F.col("timestamp") >= F.lit(start_date).cast("timestamp"))
    r = r.filter(F.col("value").isNotNull())
    return (r.join(F.broadcast(series_map), "series_id")
            .select("series_id", "name", "timestamp", F.round("value", 6).alias("value")))


def series_for(df: DataFrame, ticker: str, key: str = "ticker", ts: str = "timestamp") -> DataFrame:
    """A5: one ticker's bars ordered by time, prices as double (filter pushed to the scan)."""
    out = df.filter(F.col(key) == ticker)
    for c in ("open", "high", "low", "close"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out.orderBy(ts)


def distinct_tickers(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Sorted distinct tickers."""
    return df.select(key).distinct().orderBy(key)
