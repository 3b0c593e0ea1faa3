"""Sinks: idempotent append (A4), replay export (A7), JSON reports (A9),
time-partitioned tables (A10)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.cleaning import PRICE_COLS


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be written yet; any other read error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_arrivals(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """In-batch duplicates: the first arrival (smallest ``order``) wins.

    A grouped ``min_by``: copies of a hot key are combined on every mapper
    before the shuffle, so a key repeated a billion times is no hot spot.
    """
    rest = [c for c in batch.columns if c not in keys]
    packed = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return batch.groupBy(*keys).agg(packed.alias("_r")).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: list[str],
                     order: list[str]) -> DataFrame:
    """Rows to append = first arrival per key, minus keys already stored.

    Existing rows win over new ones (left anti join on the key columns only,
    so only the target's key columns are scanned).
    """
    firsts = first_arrivals(batch, keys, order)
    return firsts.join(target.select(*keys), keys, "left_anti")


def append_partitioned(df: DataFrame, path: str, ts: str = "timestamp",
                       part: str = "year", writers: int = 8) -> None:
    """A10: append into a table partitioned by a coarse time column.

    Rows are clustered by the partition column and a hash of the time, so each task
    writes few files and one partition is written by up to ``writers`` tasks;
    readers prune partitions from ``year`` filters.
    """
    out = df.withColumn(part, F.year(ts))
    out.repartition(part, F.pmod(F.xxhash64(ts), F.lit(writers))).write.mode("append").partitionBy(part).parquet(path)


def replay_messages(bars: DataFrame, produced_at, ticker_filter: str | None = None,
                    max_messages: int | None = None) -> DataFrame:
    """Bars ordered by (timestamp, ticker) as keyed JSON messages.

    ``max_messages`` is the reference's optional message cap (a top-k when
    set: TakeOrdered keeps only k rows per partition).
    """
    src = bars
    if ticker_filter:
        src = src.filter(F.col("ticker") == ticker_filter)
    src = src.orderBy("timestamp", "ticker")
    if max_messages:
        src = src.limit(max_messages)
    value = F.to_json(F.struct(
        F.col("ticker"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"),
        *[F.round(F.col(c).cast("double"), 4).alias(c) for c in PRICE_COLS],
        F.col("volume").cast("long").alias("volume"),
        F.date_format(F.lit(produced_at).cast("timestamp"),
                      "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("produced_at")))
    return src.select(F.col("ticker").alias("key"), value.alias("value"))


def write_json_report(df: DataFrame, path: str) -> None:
    """Result DataFrame as JSON lines (a folder of part files, written in parallel)."""
    df.write.mode("overwrite").json(path)
