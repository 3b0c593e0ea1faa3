"""Driver tables and the OHLCV bar adapter.

The test tables carry no stock prices, so a bar view is derived from
``orders`` (one shared SQL text runs unchanged in Spark and DuckDB):

    ticker = o_orderpriority, timestamp = o_orderdate,
    open = price of the smallest order key of the day, close = of the largest,
    high/low = max/min price, volume = number of orders.

At scale this is one hash aggregation with map-side partial aggregation
(``min_by``/``max_by`` combine partially), so a hot (ticker, day) group is
pre-aggregated on every mapper before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

BAR_VIEW_SQL = """
SELECT o_orderpriority AS ticker, o_orderdate AS timestamp,
       min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
       count(*) AS volume
FROM orders GROUP BY 1, 2
"""

# Wider key for benchmarks: market segment x priority = 25 tickers.
WIDE_BAR_VIEW_SQL = """
SELECT concat(c_mktsegment, '/', o_orderpriority) AS ticker, o_orderdate AS timestamp,
       min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
       count(*) AS volume
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, wide: bool = False,
         materialized: bool = False) -> DataFrame:
    """OHLCV bars (ticker, timestamp, open, high, low, close, volume).

    A lazy view: filters and column choice reach the scan of ``orders``. With
    ``materialized`` it is stored once (reliable checkpoint, one row per ticker-day),
    for plans that use the bars several times.
    """
    df = _bar_view(spark, sf_dir, wide)
    if not materialized:
        return df
    from tickwise.session import materialize
    return materialize(df)


def _bar_view(spark: SparkSession, sf_dir: str, wide: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    if not wide:
        return (orders.groupBy(F.col("o_orderpriority").alias("ticker"),
                               F.col("o_orderdate").alias("timestamp"))
                .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                     F.max("o_totalprice").alias("high"),
                     F.min("o_totalprice").alias("low"),
                     F.max_by("o_totalprice", "o_orderkey").alias("close"),
                     F.count(F.lit(1)).alias("volume")))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return (j.groupBy(F.concat("c_mktsegment", F.lit("/"), "o_orderpriority").alias("ticker"),
                      F.col("o_orderdate").alias("timestamp"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).alias("volume")))
