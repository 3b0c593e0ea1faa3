"""Streaming rate limiters (R2, R3) with ``applyInPandasWithState``.

Key = (path, client). State is bounded: R2 keeps its window's start and hit count;
R3 keeps at most ``max_requests`` accepted hit times. All hits that a micro-batch holds
for a key are put into event-time order before any of them is decided; across
micro-batches decisions follow arrival, as a live limiter's do. No hit is dropped for
being late. With ``idle_seconds`` keys without hits for that processing time lose their
state (for continuous triggers: a query that waits for time-outs has no last batch).

A call of the Python function costs milliseconds however few its hits, so keys come in groups:
a group is a hash bucket of keys, called once a micro-batch, and its state holds
each of its keys' own. The number of calls is bounded by ``buckets``, what is left grows with hits. A micro-batch
writes the state of every bucket it hits: raise ``buckets`` for many keys and small micro-batches. A
checkpoint keeps the number it was started with.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tickwise.operators.requestlog import DEFAULT_MAX_REQUESTS, DEFAULT_WINDOW_SECONDS, SlidingWindow

OUT = "path string, client string, ts timestamp, seq long, status int, rejected boolean"


def _fixed_runs(times: np.ndarray, start, count: int, limit: int, span: int):
    """R2 over ordered times: (rejected, window start, hits in it), a window at a time."""
    rejected = np.zeros(len(times), bool)
    at = 0
    while at < len(times):
        if start is None or times[at] >= start + span:
            start, count = int(times[at]), 0
        to = max(at + 1, int(np.searchsorted(times, start + span, side="left")))
        rejected[at:to] = count + 1 + np.arange(to - at) > limit
        count, at = count + to - at, to
    return rejected, start, count


_STATE = "paths array<string>, clients array<string>, seen array<long>, sizes array<int>, numbers array<long>"


def _load(state) -> dict[tuple, tuple[int, list[int]]]:
    """Key -> (processing time of its last hits, its limiter's numbers) of a bucket."""
    if not state.exists:
        return {}
    paths, clients, seen, sizes, numbers = state.get
    ends = np.cumsum(np.array(sizes, np.int64)).tolist()
    return {(p, c): (at, numbers[e - n:e]) for p, c, at, n, e in zip(paths, clients, seen, sizes, ends)}


def _save(state, known: dict[tuple, tuple[int, list[int]]]) -> None:
    state.update(([k[0] for k in known], [k[1] for k in known], [at for at, _ in known.values()],
                  [len(x) for _, x in known.values()], [v for _, x in known.values() for v in x]))


def _names(column: pd.Series) -> list:
    return column.astype(object).where(column.notna(), None).tolist()


def _decide(kind: str, limit: int, span: int, idle_ms: int | None):
    def one_key(times, numbers):
        if kind == "sliding":
            window = SlidingWindow(limit, span, numbers)
            rejected = window.decide(times)
            return rejected, window.accepted().tolist()
        rejected, start, count = _fixed_runs(times, *(numbers or (None, 0)), limit, span)
        return rejected, [start, count]

    def fn(bucket, pdfs, state):
        known = _load(state)
        now = state.getCurrentProcessingTimeMs() if idle_ms is not None else 0
        out = None
        if not state.hasTimedOut:
            pdf = pd.concat(list(pdfs))
            pdf["_key"] = pdf.groupby(["path", "client"], dropna=False, sort=False).ngroup().to_numpy()
            pdf = pdf.sort_values(["_key", "ts", "seq"], kind="stable")
            times = pdf["ts"].astype("datetime64[us]").astype("int64").to_numpy()
            first = np.flatnonzero(np.diff(pdf["_key"].to_numpy(), prepend=-1))
            rejected = np.zeros(len(pdf), bool)
            keys = pdf.iloc[first]
            for s, e, key in zip(first, np.append(first[1:], len(pdf)), zip(_names(keys["path"]), _names(keys["client"]))):
                rejected[s:e], numbers = one_key(times[s:e], known[key][1] if key in known else ())
                known[key] = (now, numbers)
            out = pd.DataFrame({"path": pdf["path"].to_numpy(), "client": pdf["client"].to_numpy(), "ts": pdf["ts"].to_numpy(),
                                "seq": pdf["seq"].to_numpy(), "status": np.where(rejected, 429, pdf["status"]).astype("int32"),
                                "rejected": rejected})
        if idle_ms is not None:
            known = {key: kept for key, kept in known.items() if kept[0] + idle_ms >= now}
        if known:
            _save(state, known)
            if idle_ms is not None:      # called again when the first of its keys is due
                state.setTimeoutDuration(max(1, min(at for at, _ in known.values()) + idle_ms - now))
        else:
            state.remove()
        if out is not None:
            yield out
    return fn


def stream_limit(log_stream: DataFrame, kind: str = "sliding",
                 max_requests: int = DEFAULT_MAX_REQUESTS,
                 window_seconds: float = DEFAULT_WINDOW_SECONDS, idle_seconds: float | None = None, buckets: int = 1024) -> DataFrame:
    """R2 (``kind='fixed'``) or R3 (``'sliding'``) over a request-log stream."""
    fn = _decide(kind, max_requests, int(round(window_seconds * 1e6)), None if idle_seconds is None else int(idle_seconds * 1000))
    return (log_stream.select(F.col("path").cast("string").alias("path"), F.col("client").cast("string").alias("client"), "ts", "seq", "status",
                              F.pmod(F.xxhash64(F.col("path").cast("string"), F.col("client").cast("string")), F.lit(buckets)).alias("_bucket"))
            .groupBy("_bucket")
            .applyInPandasWithState(fn, OUT, _STATE, "append", GroupStateTimeout.NoTimeout if idle_seconds is None
                                    else GroupStateTimeout.ProcessingTimeTimeout))
