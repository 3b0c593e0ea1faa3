"""Request-log analytics (R1-R4): counters, both rate limiters, alert rules.

The reference keeps these as in-process counters and a live limiter in its
web server; here they are jobs over a request log
``(ts timestamp, client string, path string, status int)``.

R2 runs fully parallel (``fixed_window``). R3 is cut into independent segments
(``sliding_log_limit``), so a hot client's hits are spread over tasks wherever the
log lets its state be known; in streaming both keep one small state per key
(``tickwise.streaming.limits``).
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values from the reference: limiter defaults and alert rules.
DEFAULT_MAX_REQUESTS = 60
DEFAULT_WINDOW_SECONDS = 60
ALERT_RULES = [
    # name, path (None = any), status filter, threshold per second, sustained minutes
    ("PredictRateLimitSpike", "/api/v1/predict", 429, 0.5, 10),
    ("PortfolioRateLimitSpike", "/api/v1/portfolio-risk", 429, 0.2, 10),
    ("ApiHigh5xx", None, "5xx", 0.1, 5),
]
RATE_WINDOW_MINUTES = 5

LIMIT_SCHEMA = "path string, client string, ts timestamp, seq long, status int, rejected boolean"


def fixed_window_limit(log: DataFrame, max_requests: int = DEFAULT_MAX_REQUESTS,
                       window_seconds: float = DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """R2 for every (path, client); rejected hits get status 429."""
    from tickwise.operators.fixed_window import fixed_window_limit_parallel
    return fixed_window_limit_parallel(log, max_requests, window_seconds)


class SlidingWindow:
    """R3 of one key over hits in time order (integer microseconds).

    ``ring`` holds the last ``size`` accepted times; its next slot is the oldest. A hit
    is accepted if that one lies more than ``span`` back. Hits are decided a run at a
    time: up to ``size`` accepted ones by one comparison with the ring, and all
    rejected ones before the slot frees by one binary search.
    """

    NEVER = -(1 << 62)

    def __init__(self, size: int, span: int, accepted=()):
        self.size, self.span = size, span
        self.ring = np.full(max(size, 1), self.NEVER, np.int64)
        self.slot = 0
        self.push(np.asarray(accepted, np.int64))

    def push(self, times: np.ndarray) -> None:
        """Records accepted hits."""
        for part in (times[-self.size:] if self.size else times[:0],):
            at = (self.slot + np.arange(len(part))) % self.size if self.size else part
            self.ring[at] = part
            self.slot = (self.slot + len(part)) % max(self.size, 1)

    def accepted(self) -> np.ndarray:
        """Accepted times that are kept, oldest first."""
        order = np.roll(self.ring, -self.slot)
        return order[order != self.NEVER]

    def decide(self, times: np.ndarray) -> np.ndarray:
        """True for rejected hits."""
        rejected = np.zeros(len(times), bool)
        if self.size == 0:
            return ~rejected
        at = 0
        while at < len(times):
            run = times[at:at + self.size]
            free = run - np.roll(self.ring, -self.slot)[:len(run)] > self.span
            taken = len(run) if free.all() else int(np.argmin(free))
            self.push(run[:taken])
            at += taken
            if taken < len(run):
                to = int(np.searchsorted(times, self.ring[self.slot] + self.span, side="right"))
                rejected[at:to] = True
                at = to
        return rejected


def _segments(log: DataFrame, max_requests: int, span: int) -> DataFrame:
    """Hits with ``_seg`` and ``_halo``: segments of a key that can be decided apart.

    Time is cut into buckets of one window. After an empty bucket no earlier hit
    counts. A bucket that holds at most ``max`` hits together with the one before it is
    calm: all its hits are accepted whatever came earlier, so the next bucket
    can start from it alone and gets its hits as a halo.
    """
    keys = ["path", "client"]
    hits = (log.select(*keys, "ts", "seq", "status")
            .withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
            .withColumn("_b", F.floor(F.col("_t") / span).cast("long")))
    # one row per key and bucket: grows with the time span, not with the hits
    w = Window.partitionBy(*keys).orderBy("_b")
    c = hits.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    c = c.withColumn("_joined", F.coalesce(F.lag("_b").over(w) == F.col("_b") - 1, F.lit(False)))
    c = c.withColumn("_calm", F.col("_c") + F.when(F.col("_joined"), F.lag("_c").over(w)).otherwise(0) <= max_requests)
    c = c.withColumn("_after_calm", F.col("_joined") & F.lag("_calm").over(w))
    c = c.withColumn("_seg", F.sum((~F.col("_joined") | F.col("_after_calm")).cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    c = c.withColumn("_lends", F.coalesce(F.lead("_after_calm").over(w), F.lit(False))).select(*keys, "_b", "_seg", "_lends")
    placed = hits.join(c, keys + ["_b"])
    places = F.when(F.col("_lends"), F.array(F.struct(F.col("_seg").alias("s"), F.lit(False).alias("h")),
                                             F.struct((F.col("_seg") + 1).alias("s"), F.lit(True).alias("h")))).otherwise(
        F.array(F.struct(F.col("_seg").alias("s"), F.lit(False).alias("h"))))
    return (placed.withColumn("_p", F.explode(places))
            .select(*keys, "ts", "seq", "status", "_t", F.col("_p.s").alias("_seg"), F.col("_p.h").alias("_halo")))


def sliding_log_limit(log: DataFrame, max_requests: int = DEFAULT_MAX_REQUESTS,
                      window_seconds: float = DEFAULT_WINDOW_SECONDS) -> DataFrame:
    """R3 for every (path, client); rejected hits get status 429.

    Segments are sorted streams; what stays of a client that exceeds its limit without
    a pause is decided in order by one task, in time proportional to its accepted hits.
    """
    span = int(round(window_seconds * 1e6))
    keys = ["path", "client", "_seg"]

    def scan(batches):
        current, state = None, None
        for pdf in batches:
            rejected = np.zeros(len(pdf), bool)
            t, halo = pdf["_t"].to_numpy(), pdf["_halo"].to_numpy()
            names = list(zip(*(pdf[k].tolist() for k in keys)))
            new = np.flatnonzero([True] + [a != b for a, b in zip(names[1:], names)])
            for s, e in zip(new, np.append(new[1:], len(pdf))):
                if names[s] != current:
                    current, state = names[s], SlidingWindow(max_requests, span)
                lent = s + int(halo[s:e].sum())        # the halo lies before all other hits
                state.push(t[s:lent])
                rejected[lent:e] = state.decide(t[lent:e])
            own = ~halo
            out = pdf.loc[own, ["path", "client", "ts", "seq"]].copy()
            out["status"] = np.where(rejected, 429, pdf["status"])[own].astype("int32")
            out["rejected"] = rejected[own]
            yield out

    hits = (_segments(log, max_requests, span).repartition(*keys)
            .sortWithinPartitions(*keys, "ts", "seq"))
    return hits.mapInPandas(scan, LIMIT_SCHEMA)


def request_counters(log: DataFrame) -> DataFrame:
    """(metric, label, value) rows: total, per path, per status class,
    rate-limited total and per path; one aggregation of the log."""
    spark = log.sparkSession
    cls = F.concat((F.col("status") / 100).cast("int").cast("string"), F.lit("xx"))
    metric = lambda name, label: F.struct(F.lit(name).alias("metric"), label.alias("label"))
    limited = F.array(metric("rate_limited_total", F.lit("")), metric("rate_limited_by_path", F.col("path")))
    every = F.array(metric("requests_total", F.lit("")), metric("requests_by_path", F.col("path")),
                    metric("responses_by_class", cls))
    counts = (log.groupBy("path", "status").agg(F.count(F.lit(1)).alias("n"))
              .select(F.explode(F.when(F.col("status") == 429, F.concat(every, limited)).otherwise(every)).alias("m"), "n")
              .select("m.metric", "m.label", "n"))
    zeros = spark.createDataFrame([("requests_total", "", 0), ("rate_limited_total", "", 0)],
                                  "metric string, label string, n bigint")
    return counts.unionByName(zeros).groupBy("metric", "label").agg(F.sum("n").cast("long").alias("value"))


def alert_firings(log: DataFrame, rules=None, step_minutes: int = 1) -> DataFrame:
    """Per rule, 5-minute rates sliding by one minute; a rule fires over a
    run of consecutive breaching evaluations whose first and last are at least its
    ``for`` time apart.

    Rows (alert, path, start, end, minutes). All rules are conditional counts of one
    windowed aggregation. Gaps-and-islands over the breaching windows: island =
    window start minus row_number minutes; the window sort is per (rule, path) over
    at most one row per minute of breach.
    """
    rules = rules or ALERT_RULES
    counts, fields = [], []
    for k, (name, path, status, threshold, minutes) in enumerate(rules):
        hit = ((F.col("status") / 100).cast("int") == 5) if status == "5xx" else (F.col("status") == status)
        counts.append(F.count_if(hit if path is None else hit & (F.col("path") == path)).alias(f"_n{k}"))
        fields.append(F.struct(F.lit(name).alias("alert"), F.lit(path or "*").alias("path"), F.lit(minutes).alias("_need"),
                               F.lit(float(threshold)).alias("thr"),
                               (F.col(f"_n{k}") / (RATE_WINDOW_MINUTES * 60.0)).alias("rate")))
    rates = log.groupBy(F.window("ts", f"{RATE_WINDOW_MINUTES} minutes", f"{step_minutes} minute").alias("w")).agg(*counts)
    breaches = (rates.select(F.col("w.start").alias("wstart"), F.explode(F.array(*fields)).alias("r"))
                .where("r.rate > r.thr").select("r.alert", "r.path", "r._need", "wstart"))
    w = Window.partitionBy("alert", "path").orderBy("wstart")
    island = F.col("wstart") - F.make_dt_interval(mins=F.row_number().over(w) * step_minutes)
    g = breaches.withColumn("_island", island).groupBy("alert", "path", "_island", "_need").agg(
        F.min("wstart").alias("start"), F.max("wstart").alias("end"))
    dur = (F.unix_seconds(F.col("end").cast("timestamp")) - F.unix_seconds(F.col("start").cast("timestamp"))) / 60
    return (g.withColumn("minutes", dur.cast("long")).filter(F.col("minutes") >= F.col("_need"))
            .select("alert", "path", "start", "end", "minutes"))


def events_as_request_log(events: DataFrame) -> DataFrame:
    """Stand-in request log from the ``events`` table: client = user_id,
    path = event_type, status 500 for 'error' events else 200; ``seq`` =
    event_id orders hits with equal timestamps."""
    return events.select(F.col("ts").cast("timestamp").alias("ts"),
                         F.col("user_id").cast("string").alias("client"),
                         F.col("event_type").alias("path"),
                         F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200))
                         .cast("int").alias("status"),
                         F.col("event_id").cast("long").alias("seq"))


def windowed_counts(log: DataFrame, window: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """R1 over event time: counts per (window, path, status class).

    Works on a batch or a streaming log. Without ``watermark`` a streaming query counts
    every request however late (update mode; its state is one row per window, path and
    class). With it, state is dropped and later rows are not counted.
    """
    src = log.withWatermark("ts", watermark) if watermark else log
    cls = F.concat((F.col("status") / 100).cast("int").cast("string"), F.lit("xx"))
    return (src.groupBy(F.window("ts", window).alias("w"), "path", cls.alias("status_class"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "path", "status_class", "n"))
