"""Ordered per-key series without whole-key tasks.

``Window.partitionBy("ticker")`` puts every row of a ticker into one task.
When one ticker holds a third of all rows that task is the job, so the
series operators here never partition by the key alone:

1. ``number_rows`` gives every row its exact 0-based position ``rn`` inside
   its key and the key length ``n``. Rows are first grouped by a coarse
   time bucket (default: calendar year); only the tiny (key, bucket) count
   table is scanned per key to turn bucket counts into offsets, and the
   big table is windowed per (key, bucket).
2. ``halo_blocks`` cuts each key into blocks of ``block_rows`` positions
   and copies the last ``halo`` rows of a block into the next one, so any
   trailing frame of up to ``halo + 1`` rows is complete inside one
   (key, block) partition. Callers compute windows over
   ``block_window()`` and keep ``_home`` rows only. Replication factor is
   ``1 + halo / block_rows``.

Both steps are hash-partitioned on two-column keys whose groups are
bounded (a bucket of time, a block of rows), so the work spreads over the
cluster regardless of key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1024
RN, N, BLK, HOME, POS = "rn", "n", "_blk", "_home", "_pos"


def number_rows(df: DataFrame, key: str = "ticker", ts: str = "timestamp",
                bucket: str = "year") -> DataFrame:
    """Add ``rn`` (0-based position by ``ts`` within ``key``) and ``n`` (key length).

    ``bucket`` is a ``date_trunc`` unit; pick one whose per-key row count is
    bounded (a year of daily bars is at most 366 rows).
    """
    d = df.withColumn("_bkt", F.date_trunc(bucket, F.col(ts)))
    local = d.withColumn("_lrn", F.row_number().over(Window.partitionBy(key, "_bkt").orderBy(ts)) - 1)
    # bucket sizes need two columns of the input and are summed on the mappers
    counts = d.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per (key, bucket): size grows with time span, not with data volume
    wk = Window.partitionBy(key).orderBy("_bkt")
    offsets = counts.select(
        key, "_bkt",
        (F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cnt"))
        .alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(key)).alias(N))
    out = local.join(offsets, [key, "_bkt"])
    return out.withColumn(RN, (F.col("_off") + F.col("_lrn")).cast("long")).drop(
        "_bkt", "_lrn", "_off")


def newest_rows(df: DataFrame, rows: int, key: str = "ticker", ts: str = "timestamp") -> DataFrame:
    """The newest ``rows`` rows of each key with ``_back`` (0 = newest).

    A descending row number with a limit: Spark keeps at most ``rows`` rows of a key in
    each task before the shuffle, so a key's history is never moved or sorted whole.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    # the limit must stand on the bare row number for Spark to see it
    kept = df.withColumn("_back", F.row_number().over(w)).filter(F.col("_back") <= rows)
    return kept.withColumn("_back", F.col("_back") - 1)


def with_length(df: DataFrame, whole: DataFrame, key: str = "ticker") -> DataFrame:
    """Adds ``n``, the key's number of rows in ``whole`` (summed on the mappers)."""
    return df.join(whole.groupBy(key).agg(F.count(F.lit(1)).alias(N)), key)


def halo_blocks(df: DataFrame, halo: int, block_rows: int = BLOCK_ROWS,
                lead: int = 0) -> DataFrame:
    """Assign rows to (key, ``_blk``) blocks with a trailing halo; flag ``_home``.

    Requires ``rn``. ``_pos`` is the position inside the home block. Block k
    receives the ``halo`` rows before it (from as many earlier blocks as
    needed), so partition k holds positions ``[max(0, kB - halo), (k+1)B)``.
    ``lead`` also copies the first rows of a block into the previous one,
    for ``lead()``-style look-ahead.
    """
    if lead > block_rows:
        raise ValueError(f"lead {lead} larger than block {block_rows}")
    home_blk = F.floor(F.col(RN) / block_rows).cast("long")
    pos = (F.col(RN) - home_blk * block_rows).cast("int")
    reach = -(-halo // block_rows)  # blocks a row can be copied forward into
    # never copy past the key's last block (it would hold halo rows only)
    last_blk = (F.floor((F.col(N) - 1) / block_rows).cast("long") if N in df.columns
                else F.lit(None).cast("long"))
    fwd = (F.transform(F.filter(F.sequence(F.lit(1), F.lit(reach)),
                                lambda j: (pos >= j * block_rows - halo)
                                & F.coalesce(home_blk + j <= last_blk, F.lit(True))),
                       lambda j: home_blk + j.cast("long"))
           if reach > 0 else F.array().cast("array<long>"))
    prv = F.when((F.lit(lead) > 0) & (pos < lead) & (home_blk > 0), F.array(home_blk - 1))
    targets = F.concat(F.array(home_blk), fwd, F.coalesce(prv, F.array().cast("array<long>")))
    return (df.withColumn("_hb", home_blk).withColumn(POS, pos)
            .withColumn(BLK, F.explode(targets))
            .withColumn(HOME, F.col(BLK) == F.col("_hb")).drop("_hb"))


def block_window(key: str = "ticker"):
    return Window.partitionBy(key, BLK).orderBy(RN)


def trailing(key: str, rows: int):
    """Frame of the current row and ``rows - 1`` preceding rows."""
    return block_window(key).rowsBetween(-(rows - 1), 0)


def gated(expr: Column, count_expr: Column, rows: int) -> Column:
    """``expr`` only where the trailing frame is complete (``count == rows``)."""
    return F.when(count_expr == rows, expr)


def home_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(HOME, BLK, POS)
