"""Latest-row, paging and arg-max operators.

Latest-per-key uses ``max_by`` aggregates: partial aggregation on every
mapper, one row per key after the shuffle, no sort of the key's history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str = "ticker", ts: str = "timestamp",
                   cols: list[str] | None = None) -> DataFrame:
    """Newest row per key (``DISTINCT ON`` replacement)."""
    cols = cols or [c for c in df.columns if c not in (key,)]
    packed = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(ts)).alias("_r")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def previous_close_before_global_max(df: DataFrame, key: str = "ticker",
                                     ts: str = "timestamp", price: str = "close") -> DataFrame:
    """per key, the latest ``price`` strictly before the table-wide max timestamp.

    The global max is an uncorrelated scalar subquery (evaluated once).
    """
    gmax = df.select(F.max(ts)).scalar()
    return (df.filter(F.col(ts) < gmax).groupBy(key)
            .agg(F.max_by(price, ts).alias("prev_close")))


def last_two(df: DataFrame, key: str = "ticker", ts: str = "timestamp",
             price: str = "close") -> DataFrame:
    """newest row per key plus its own previous close (itself when single).

    ``max_by`` over the row and ``max_by`` over rows before it, per key, via
    two partial aggregations: no sort of the key's history.
    """
    latest = latest_per_key(df, key, ts)
    before = (df.join(latest.select(key, F.col(ts).alias("_lts")), key)
              .filter(F.col(ts) < F.col("_lts"))
              .groupBy(key).agg(F.max_by(price, ts).alias("_pc")))
    return (latest.join(before, key, "left")
            .withColumn("previous_close", F.coalesce(F.col("_pc"), F.col(price))).drop("_pc"))


def page_newest_first(df: DataFrame, page: int, page_size: int, ts: str = "timestamp") -> DataFrame:
    """F5 for one series: ``ORDER BY ts DESC LIMIT size OFFSET (page-1)*size``.

    Spark plans ``orderBy + offset + limit`` as a top-k (TakeOrdered), so only
    ``page*size`` rows per partition travel to the final task.
    """
    if page < 1 or not 1 <= page_size <= 500:
        raise ValueError("page >= 1 and 1 <= page_size <= 500 required")
    return df.orderBy(F.col(ts).desc()).offset((page - 1) * page_size).limit(page_size)


def page_after(df: DataFrame, before, page_size: int, ts: str = "timestamp") -> DataFrame:
    """F5 keyset pagination for deep pages: the ``page_size`` newest rows
    strictly older than the cursor ``before`` (the last timestamp of the
    previous page). Cost does not grow with the page number, unlike OFFSET."""
    if not 1 <= page_size <= 500:
        raise ValueError("1 <= page_size <= 500 required")
    src = df if before is None else df.filter(F.col(ts) < F.lit(before))
    return src.orderBy(F.col(ts).desc()).limit(page_size)


def page_many(df: DataFrame, page: int, page_size: int, key: str = "ticker",
              ts: str = "timestamp") -> DataFrame:
    """F5 for every key at once.

    The newest ``page * page_size`` rows of each key are kept in every task before
    the shuffle; the page is a filter on them.
    """
    if page < 1 or not 1 <= page_size <= 500:
        raise ValueError("page >= 1 and 1 <= page_size <= 500 required")
    from tickwise.operators.series import newest_rows
    lo = (page - 1) * page_size
    d = newest_rows(df, lo + page_size, key, ts).filter(F.col("_back") >= lo)
    return d.withColumn("row_in_page", (F.col("_back") - lo).cast("int")).drop("_back")


def arg_max(df: DataFrame, metric: str, tie_order: str, group: list[str] | None = None) -> DataFrame:
    """row with the highest ``metric``; ties go to the smallest ``tie_order``."""
    score = F.struct(F.col(metric), (-F.col(tie_order)).alias("_t"))
    packed = F.max_by(F.struct(*[F.col(c) for c in df.columns]), score).alias("_r")
    agg = df.groupBy(*(group or [])).agg(packed)
    return agg.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns])


__all__ = ["latest_per_key", "previous_close_before_global_max", "last_two",
           "page_newest_first", "page_after", "page_many", "arg_max"]
