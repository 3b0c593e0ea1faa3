"""R2 fixed-window limiter, exact and parallel (no per-key sequential scan).

Semantics per (path, client): a window opens at a hit, lasts W seconds, every
hit counts, a hit is rejected when its window has more than ``max`` hits;
the next window opens at the first hit at or after ``anchor + W``.

The anchors of a key are the orbit of its first hit under
``next(i) = index of the first hit with t >= t_i + W``:

1. hits are numbered per key by (time, seq) through per-(key, W-bucket)
   counts, like ``series.number_rows``;
2. ``next(i)`` is a rank: hits before bucket b+1 plus the hits of bucket b+1
   earlier than ``t_i + W`` (a running count over the union of those hits
   and the query times, per (key, bucket));
3. the orbit is found by pointer doubling: ``S <- S u J_k(S)``,
   ``J_{k+1} = J_k o J_k``, log2(n) rounds of equi-joins on the hit index,
   each round checkpointed;
4. windows are at least W apart, so a hit's anchor lies in its own or the
   previous W-bucket: one equi-join, then ``idx - anchor_idx + 1 > max``.

Every step is a join or window on (key, bucket) or on the hit index, so a
key holding a third of all hits is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.session import materialize

KEYS = ["path", "client"]


def _numbered(log: DataFrame, w_us: int) -> DataFrame:
    d = (log.select(*KEYS, "ts", "seq", "status")
         .withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
         .withColumn("_b", F.floor(F.col("_t") / w_us).cast("long")))
    local = d.withColumn("_l", F.row_number().over(
        Window.partitionBy(*KEYS, "_b").orderBy("_t", "seq")) - 1)
    counts = d.groupBy(*KEYS, "_b").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*KEYS).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    # one row per (key, bucket): grows with the time span, not with the hit count
    offs = counts.select(*KEYS, "_b", (F.sum("_c").over(run) - F.col("_c")).alias("_off"), "_c",
                         F.sum("_c").over(Window.partitionBy(*KEYS)).alias("_n"))
    return local.join(offs, KEYS + ["_b"]).withColumn("idx", F.col("_off") + F.col("_l"))


def _next_index(hits: DataFrame, w_us: int) -> DataFrame:
    """(key, idx, nxt): index of the first hit at or after t + W (NULL if none)."""
    q = hits.select(*KEYS, (F.col("_b") + 1).alias("_bb"), (F.col("_t") + w_us).alias("_time"),
                    F.lit(0).alias("_kind"), "idx", (F.col("_off") + F.col("_c")).alias("_before"),
                    "_n")
    h = hits.select(*KEYS, F.col("_b").alias("_bb"), F.col("_t").alias("_time"),
                    F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("idx"),
                    F.lit(None).cast("long").alias("_before"), F.lit(None).cast("long").alias("_n"))
    # queries sort before hits at equal time: only strictly earlier hits count
    w = Window.partitionBy(*KEYS, "_bb").orderBy("_time", "_kind").rowsBetween(
        Window.unboundedPreceding, -1)
    u = q.unionByName(h).withColumn("_rank", F.coalesce(F.sum("_kind").over(w), F.lit(0)))
    nxt = F.col("_before") + F.col("_rank")
    return (u.filter(F.col("_kind") == 0)
            .select(*KEYS, "idx", F.when(nxt < F.col("_n"), nxt).cast("long").alias("nxt")))


def fixed_window_limit_parallel(log: DataFrame, max_requests: int, window_seconds: float,
                                max_rounds: int = 64) -> DataFrame:
    """R2 for every (path, client); rows (path, client, ts, seq, status, rejected)."""
    w_us = int(round(window_seconds * 1e6))
    hits = materialize(_numbered(log, w_us))
    jump = materialize(_next_index(hits, w_us).filter(F.col("nxt").isNotNull()))
    orbit = materialize(hits.filter(F.col("idx") == 0).select(*KEYS, F.col("idx").alias("node")))
    size = orbit.count()
    for _ in range(max_rounds):
        step = (orbit.join(jump.withColumnRenamed("idx", "node"), KEYS + ["node"])
                .select(*KEYS, F.col("nxt").alias("node")))
        grown = materialize(orbit.unionByName(step).distinct())
        new_size = grown.count()
        if new_size == size:
            break
        orbit, size = grown, new_size
        j2 = jump.alias("a").join(jump.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in KEYS]
                                  + [F.col("a.nxt") == F.col("b.idx")])
        jump = materialize(j2.select(*[F.col(f"a.{k}") for k in KEYS], F.col("a.idx"),
                                     F.col("b.nxt").alias("nxt")))
    else:
        raise RuntimeError("fixed-window orbit did not converge")
    anchors = (orbit.join(hits.select(*KEYS, F.col("idx").alias("node"), "_b"), KEYS + ["node"])
               .select(*KEYS, F.col("node").alias("_a"), "_b"))
    cand = anchors.select(*KEYS, "_a", "_b").unionByName(
        anchors.select(*KEYS, "_a", (F.col("_b") + 1).alias("_b")))
    j = hits.join(cand, KEYS + ["_b"], "left")
    per_hit = j.groupBy(*KEYS, "idx", "ts", "seq", "status").agg(
        F.max(F.when(F.col("_a") <= F.col("idx"), F.col("_a"))).alias("_anchor"))
    rejected = (F.col("idx") - F.col("_anchor") + 1) > max_requests
    return per_hit.select(*KEYS, "ts", "seq",
                          F.when(rejected, F.lit(429)).otherwise(F.col("status")).cast("int")
                          .alias("status"), rejected.alias("rejected"))
