"""Registered queries: streaming ingest, request log, sentiment, sources/sinks,
remaining serving queries (I, R, L, A, G, K2/K3/K5/K8/K9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise.functions.cleaning import apply_contract
from tickwise.operators import requestlog as rl
from tickwise.operators import sentiment as se
from tickwise.plans import serving
from tickwise.plans.catalog import BARS_CTE, FEATURES_CTE, SERIES_CTE, register
from tickwise.session import checkpoint_dir
from tickwise.sources import loaders, sinks
from tickwise.sources.tables import bars, table
from tickwise.streaming import ingest

PRODUCED_AT = "2001-08-03 00:00:00"


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/runs/{uuid.uuid4().hex}/{name}"


def _event_messages(spark, sf_dir):
    """Stand-in stream content from ``events``: one price message per event
    (ticker = event type, price = value, volume = user id) and one message per
    event made of its ``props`` text (fails the contract)."""
    ev = table(spark, sf_dir, "events")
    good = ev.select(F.to_json(F.struct(
        F.col("event_type").alias("ticker"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
        F.col("user_id").alias("volume"))).alias("value"))
    bad = ev.select(F.col("props").alias("value"))
    return good, bad


def _run_ingest(spark, sf_dir):
    base = _scratch(spark, "ingest")
    src = f"{base}/in"
    replay = sinks.replay_messages(bars(spark, sf_dir), PRODUCED_AT).select("value")
    good, bad = _event_messages(spark, sf_dir)
    # bars, the same bars again (all duplicates of stored keys), event prices, invalid props: each in files as
    # Spark writes them, several to a micro-batch
    for part in (replay, replay, good, bad):
        part.write.mode("append").text(src)
    stream = ingest.file_source(spark, src, max_files_per_trigger=4)
    q = ingest.run_ingest(stream, f"{base}/prices", f"{base}/dead", f"{base}/stats", f"{base}/ckpt")
    q.awaitTermination()
    return base


_INGEST_CTE = f"""{BARS_CTE},
msgs AS (
  SELECT ticker, timestamp, round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low,
         round(close, 4) AS close, CAST(volume AS BIGINT) AS volume FROM bars
  UNION ALL
  SELECT upper(trim(event_type)), date_trunc('microseconds', ts), round(value, 4), round(value, 4), round(value, 4),
         round(value, 4), CAST(user_id AS BIGINT) FROM events WHERE value > 0 AND user_id > 0 AND trim(event_type) <> '')"""


@register("I1_stream_ingest", f"""
WITH {_INGEST_CTE}
SELECT ticker, timestamp, open, high, low, close, volume FROM msgs
""")
def i1_stream_ingest(spark, sf_dir):
    """Replayed messages through the streaming ingest; returns the stored table."""
    base = _run_ingest(spark, sf_dir)
    t = ingest.read_prices(spark, f"{base}/prices", f"{base}/stats")
    return t.select("ticker", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                    "open", "high", "low", "close", "volume")


@register("I1_stream_counts", f"""
WITH {_INGEST_CTE}
SELECT (SELECT 2 * count(*) FROM bars) + (SELECT count(*) FROM events WHERE user_id > 0) AS consumed,
       (SELECT count(*) FROM msgs) AS inserted,
       (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE user_id <= 0) AS errors
""")
def i1_stream_counts(spark, sf_dir):
    """(consumed, inserted, errors) of the same run, summed over micro-batches."""
    return ingest.totals(spark, f"{_run_ingest(spark, sf_dir)}/stats")


@register("I2_message_routing", """
SELECT error, count(*) AS n FROM (
  SELECT CASE WHEN user_id <= 0 THEN 'bad_volume' END AS error FROM events
  UNION ALL SELECT 'missing_field' FROM events) GROUP BY error
""")
def i2_message_routing(spark, sf_dir):
    """I2/B5/B6 in batch: contract outcome counts over the event messages."""
    good, bad = _event_messages(spark, sf_dir)
    parsed = apply_contract(good.unionByName(bad), "value")
    return parsed.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def _messages_sql(where: str = "") -> str:
    """Key, place in the replay and the message's fields, read back from its JSON text on the Spark side."""
    return f"""SELECT ticker AS key, row_number() OVER (ORDER BY timestamp, ticker) AS place, ticker, strftime(timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp,
       round(CAST(open AS DOUBLE), 4) AS open, round(CAST(high AS DOUBLE), 4) AS high, round(CAST(low AS DOUBLE), 4) AS low,
       round(CAST(close AS DOUBLE), 4) AS close, CAST(volume AS BIGINT) AS volume, '2001-08-03T00:00:00+00:00' AS produced_at FROM bars {where}"""


_MESSAGE = "ticker string, timestamp string, open double, high double, low double, close double, volume bigint, produced_at string"


def _read_messages(m):
    return m.select("key", F.from_json("value", _MESSAGE, {"mode": "FAILFAST"}).alias("m")).select("key", "m.*")


@register("A7_replay_export", f"""
WITH {BARS_CTE}, m AS ({_messages_sql()})
SELECT * EXCLUDE (place) FROM m
""")
def a7_replay_export(spark, sf_dir):
    """Keyed JSON messages of all bars, field by field."""
    return _read_messages(sinks.replay_messages(bars(spark, sf_dir), PRODUCED_AT))


@register("A7_replay_first_messages", f"""
WITH {BARS_CTE}, m AS ({_messages_sql("WHERE ticker = '2-HIGH'")})
SELECT * FROM m WHERE place <= 100
""")
def a7_replay_first_messages(spark, sf_dir):
    """A7 with a ticker and a message limit: the first 100 messages of one ticker, in replay order (by file and line)."""
    m = sinks.replay_messages(bars(spark, sf_dir), PRODUCED_AT, ticker_filter="2-HIGH", max_messages=100)
    out = _scratch(spark, "replay")
    m.write.json(out)       # ordered parts: file by file, line by line
    back = spark.read.schema("key string, value string").json(out).select("key", "value", F.col("_metadata.file_name").alias("_file"),
                                                                          F.monotonically_increasing_id().alias("_line"))
    from pyspark.sql import Window
    placed = back.withColumn("place", F.row_number().over(Window.orderBy("_file", "_line")).cast("long"))      # 100 rows at most
    return placed.select("place", "key", F.from_json("value", _MESSAGE, {"mode": "FAILFAST"}).alias("m")).select("place", "key", "m.*")


# ---------------------------------------------------------------- request log
R_MAX, R_WINDOW = 2, 86400.0   # 2 hits per client and path per day


def _log(spark, sf_dir):
    return rl.events_as_request_log(table(spark, sf_dir, "events"))


_LOG_CTE = """lg AS (SELECT CAST(ts AS TIMESTAMP) AS ts, CAST(user_id AS VARCHAR) AS client, event_type AS path,
                 CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, event_id AS seq FROM events),
ln AS (SELECT *, row_number() OVER (PARTITION BY path, client ORDER BY ts, seq) AS k,
              epoch_us(ts) / 1e6 AS t FROM lg)"""

_R3_SQL = f"""
WITH RECURSIVE {_LOG_CTE},
r AS (SELECT path, client, k, ts, seq, status, [t] AS hits, false AS rejected FROM ln WHERE k = 1
      UNION ALL
      SELECT ln.path, ln.client, ln.k, ln.ts, ln.seq, ln.status,
             CASE WHEN len(list_filter(r.hits, lambda h: ln.t - h <= {R_WINDOW})) >= {R_MAX}
                  THEN list_filter(r.hits, lambda h: ln.t - h <= {R_WINDOW})
                  ELSE list_append(list_filter(r.hits, lambda h: ln.t - h <= {R_WINDOW}), ln.t) END,
             len(list_filter(r.hits, lambda h: ln.t - h <= {R_WINDOW})) >= {R_MAX}
      FROM r JOIN ln ON ln.path = r.path AND ln.client = r.client AND ln.k = r.k + 1)"""

_R2_SQL = f"""
WITH RECURSIVE {_LOG_CTE},
r AS (SELECT path, client, k, ts, seq, status, t AS anchor, 1 AS cnt FROM ln WHERE k = 1
      UNION ALL
      SELECT ln.path, ln.client, ln.k, ln.ts, ln.seq, ln.status,
             CASE WHEN ln.t >= r.anchor + {R_WINDOW} THEN ln.t ELSE r.anchor END,
             CASE WHEN ln.t >= r.anchor + {R_WINDOW} THEN 1 ELSE r.cnt + 1 END
      FROM r JOIN ln ON ln.path = r.path AND ln.client = r.client AND ln.k = r.k + 1)"""


@register("R3_sliding_log_limit", _R3_SQL + """
SELECT path, client, CAST(ts AS TIMESTAMP) AS ts, seq, CASE WHEN rejected THEN 429 ELSE status END AS status, rejected FROM r
""")
def r3_sliding_log_limit(spark, sf_dir):
    out = rl.sliding_log_limit(_log(spark, sf_dir), R_MAX, R_WINDOW)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("R2_fixed_window_limit", _R2_SQL + f"""
SELECT path, client, CAST(ts AS TIMESTAMP) AS ts, seq, CASE WHEN cnt > {R_MAX} THEN 429 ELSE status END AS status,
       cnt > {R_MAX} AS rejected FROM r
""")
def r2_fixed_window_limit(spark, sf_dir):
    out = rl.fixed_window_limit(_log(spark, sf_dir), R_MAX, R_WINDOW)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("R2_fixed_window_limit_parallel", _R2_SQL + f"""
SELECT path, client, CAST(ts AS TIMESTAMP) AS ts, seq, CASE WHEN cnt > {R_MAX} THEN 429 ELSE status END AS status,
       cnt > {R_MAX} AS rejected FROM r
""")
def r2_fixed_window_limit_parallel(spark, sf_dir):
    """R2 by pointer doubling over window anchors (the one path of R2)."""
    out = rl.fixed_window_limit(_log(spark, sf_dir), R_MAX, R_WINDOW)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("R1_request_counters", _R3_SQL + """,
lim AS (SELECT path, CASE WHEN rejected THEN 429 ELSE status END AS status FROM r)
SELECT 'requests_total' AS metric, '' AS label, count(*) AS value FROM lim
UNION ALL SELECT 'requests_by_path', path, count(*) FROM lim GROUP BY path
UNION ALL SELECT 'responses_by_class', CAST(CAST(trunc(status / 100) AS INTEGER) AS VARCHAR) || 'xx', count(*) FROM lim GROUP BY 2
UNION ALL SELECT 'rate_limited_total', '', count(*) FILTER (WHERE status = 429) FROM lim
UNION ALL SELECT 'rate_limited_by_path', path, count(*) FROM lim WHERE status = 429 GROUP BY path
""")
def r1_request_counters(spark, sf_dir):
    """R1 over the log after the R3 limiter (so 429s are counted)."""
    return rl.request_counters(rl.sliding_log_limit(_log(spark, sf_dir), R_MAX, R_WINDOW))


ALERT_STANDIN = [("ErrorEventsHigh", "error", 500, 0.001, 10),
                 ("Any5xx", None, "5xx", 0.0005, 5)]


@register("R4_alert_firings", f"""
WITH {_LOG_CTE.split(',' + chr(10) + 'ln AS')[0]},
m AS (SELECT DISTINCT time_bucket(INTERVAL 1 minute, ts) AS mt FROM lg),
wins AS (SELECT DISTINCT mt - INTERVAL (i) minute AS ws FROM m, range(0, 5) AS r(i)),
rates AS (
  SELECT 'ErrorEventsHigh' AS alert, 'error' AS path, 10 AS need, w.ws,
         (SELECT count(*) FROM lg WHERE path = 'error' AND status = 500 AND ts >= w.ws AND ts < w.ws + INTERVAL 5 minute) / 300.0 AS rate,
         0.001 AS thr FROM wins w
  UNION ALL
  SELECT 'Any5xx', '*', 5, w.ws,
         (SELECT count(*) FROM lg WHERE status >= 500 AND status < 600 AND ts >= w.ws AND ts < w.ws + INTERVAL 5 minute) / 300.0,
         0.0005 FROM wins w),
b AS (SELECT alert, path, need, ws, ws - INTERVAL (row_number() OVER (PARTITION BY alert, path ORDER BY ws)) minute AS isl
      FROM rates WHERE rate > thr),
g AS (SELECT alert, path, need, min(ws) AS start, max(ws) AS "end" FROM b GROUP BY alert, path, need, isl)
SELECT alert, path, CAST(start AS TIMESTAMP) AS start, CAST("end" AS TIMESTAMP) AS "end",
       CAST(datediff('minute', start, "end") AS BIGINT) AS minutes
FROM g WHERE datediff('minute', start, "end") >= need
""")
def r4_alert_firings(spark, sf_dir):
    """R4 with thresholds scaled to the event rate of the test tables."""
    out = rl.alert_firings(_log(spark, sf_dir), ALERT_STANDIN)
    return out.select("alert", "path", F.col("start").cast("timestamp_ntz").alias("start"),
                      F.col("end").cast("timestamp_ntz").alias("end"), "minutes")


@register("R3_stream_limit", _R3_SQL + """
SELECT path, client, CAST(ts AS TIMESTAMP) AS ts, seq, CASE WHEN rejected THEN 429 ELSE status END AS status, rejected FROM r
""")
def r3_stream_limit(spark, sf_dir):
    """R3 as a streaming job (applyInPandasWithState) over the log replayed as files."""
    from tickwise.streaming.limits import stream_limit
    base = _scratch(spark, "limits")
    _log(spark, sf_dir).write.parquet(f"{base}/in")
    schema = "ts timestamp, client string, path string, status int, seq long"
    src = spark.readStream.schema(schema).parquet(f"{base}/in")
    q = (stream_limit(src, "sliding", R_MAX, R_WINDOW).writeStream
         .format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---------------------------------------------------------------- sentiment (L1, L2)
@register("L1_neutral_sentiment", """
SELECT doc_id, text, 0.0 AS positive, 0.0 AS negative, 1.0 AS neutral, 'neutral' AS label FROM documents
""")
def l1_neutral_sentiment(spark, sf_dir):
    return se.neutral_sentiment(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _l2_sql(positive, negative) -> str:
    pos = ", ".join(f"'{w}'" for w in sorted(positive))
    neg = ", ".join(f"'{w}'" for w in sorted(negative))
    return f"""
WITH w AS (SELECT doc_id, lang, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS ws FROM documents),
c AS (SELECT lang, len(ws) AS nw, len(list_filter(ws, lambda x: list_contains([{pos}], x))) AS p,
             len(list_filter(ws, lambda x: list_contains([{neg}], x))) AS q FROM w),
l AS (SELECT lang, CASE WHEN p > q THEN 'positive' WHEN q > p THEN 'negative' ELSE 'neutral' END AS label,
             CASE WHEN p > q THEN p / greatest(nw, 1) ELSE 0.0 END AS positive,
             CASE WHEN q > p THEN q / greatest(nw, 1) ELSE 0.0 END AS negative FROM c)
SELECT lang, label, count(*) AS n, round(sum(positive), 6) AS positive, round(sum(negative), 6) AS negative
FROM l GROUP BY 1, 2
"""


def _l2_labels(spark, sf_dir, positive, negative):
    scored = se.lexicon_sentiment(table(spark, sf_dir, "documents").select("lang", "text"), positive, negative)
    return scored.groupBy("lang", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("positive"), 6).alias("positive"),
        F.round(F.sum("negative"), 6).alias("negative"))


@register("L2_lexicon_sentiment_labels", _l2_sql(se.POSITIVE_WORDS, se.NEGATIVE_WORDS))
def l2_lexicon_sentiment(spark, sf_dir):
    """L2 over every document (whole texts): label counts per language."""
    return _l2_labels(spark, sf_dir, se.POSITIVE_WORDS, se.NEGATIVE_WORDS)


# a lexicon of words that the documents hold, so that all three labels occur
_L2_POS, _L2_NEG = {"the", "que", "der", "on"}, {"of", "de", "and", "und", "la"}


@register("L2_sentiment_other_lexicon", _l2_sql(_L2_POS, _L2_NEG))
def l2_other_lexicon(spark, sf_dir):
    """L2 with a given lexicon."""
    return _l2_labels(spark, sf_dir, _L2_POS, _L2_NEG)


# ---------------------------------------------------------------- sources / sinks (A, G)
def _vendor_wide(spark, sf_dir):
    """Stand-in vendor frame: bars pivoted to ``{ticker}__{Field}`` columns per date."""
    b = bars(spark, sf_dir)
    tick = [r[0] for r in b.select("ticker").distinct().orderBy("ticker").collect()]
    wide = b.groupBy(F.col("timestamp").alias("date")).pivot("ticker", tick).agg(
        F.first("open").alias("Open"), F.first("high").alias("High"), F.first("low").alias("Low"),
        F.first("close").alias("Close"), F.first("volume").alias("Volume"))
    ren = {c: c.replace("_Open", "__Open").replace("_High", "__High").replace("_Low", "__Low")
           .replace("_Close", "__Close").replace("_Volume", "__Volume") for c in wide.columns}
    return wide.select(*[F.col(f"`{c}`").alias(ren[c]) for c in wide.columns]), tick


@register("A1_vendor_melt", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp, round(open, 4) AS open, round(high, 4) AS high,
       round(low, 4) AS low, round(close, 4) AS close, CAST(volume AS BIGINT) AS volume
FROM bars WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume > 0
""")
def a1_vendor_melt(spark, sf_dir):
    """A1 + B1-B3: wide vendor frame -> long cleaned bars (missing dates dropped)."""
    wide, tick = _vendor_wide(spark, sf_dir)
    out = loaders.melt_vendor_frame(wide, tick + ["NOT-LISTED"])
    return out.select("ticker", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                      "volume")


@register("A1_vendor_single", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp, round(open, 4) AS open, round(high, 4) AS high,
       round(low, 4) AS low, round(close, 4) AS close, CAST(volume AS BIGINT) AS volume
FROM bars WHERE ticker = '2-HIGH' AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume > 0
""")
def a1_vendor_single(spark, sf_dir):
    """A1 in the vendor's layout for one ticker (columns without its name)."""
    wide = bars(spark, sf_dir).filter(F.col("ticker") == "2-HIGH").select(
        F.col("timestamp").alias("date"), *[F.col(c.lower()).alias(c) for c in loaders.VENDOR_FIELDS])
    out = loaders.melt_vendor_frame(wide, ["2-HIGH"])
    return out.select("ticker", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], "volume")


@register("A2_period_filter_1y", f"""
WITH {BARS_CTE}
SELECT ticker, count(*) AS n FROM bars
WHERE timestamp >= (SELECT max(timestamp) FROM bars) - INTERVAL 1 year GROUP BY 1
""")
def a2_period_filter(spark, sf_dir):
    b = loaders.period_filter(bars(spark, sf_dir), "1y")
    return b.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


@register("A3_macro_series", """
SELECT l_returnflag AS series_id,
       CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None' WHEN 'R' THEN 'Returned' END AS name,
       l_shipdate AS timestamp, round(l_discount, 6) AS value
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_discount IS NOT NULL AND NOT isnan(l_discount)
  AND l_returnflag IN ('A', 'N', 'R')
""")
def a3_macro_series(spark, sf_dir):
    """A3 with a stand-in raw series (return flag -> discount by ship date) and
    the id->name list of all three series."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("series_id"), F.col("l_shipdate").alias("timestamp"),
        F.col("l_discount").alias("value"))
    names = spark.createDataFrame([("A", "Accepted"), ("N", "None"), ("R", "Returned")],
                                  "series_id string, name string")
    return loaders.load_macro_series(raw, names, "1995-01-01")


@register("A4_insert_if_absent", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp, close FROM bars WHERE timestamp >= TIMESTAMP '1998-01-01'
""")
def a4_insert_if_absent(spark, sf_dir):
    """target = bars before 1998; batch = all bars, then the same bars with
    a later arrival and changed close. New rows = first arrival of unseen keys."""
    b = bars(spark, sf_dir).select("ticker", "timestamp", "close")
    target = b.filter(F.col("timestamp") < F.lit("1998-01-01").cast("timestamp_ntz"))
    batch = (b.withColumn("_arrival", F.lit(0))
             .unionByName(b.withColumn("close", F.col("close") + 1).withColumn("_arrival", F.lit(1))))
    return sinks.insert_if_absent(batch, target, ["ticker", "timestamp"], ["_arrival"]).drop("_arrival")


@register("A5_keyed_scan", f"""
WITH {BARS_CTE}
SELECT timestamp, open, high, low, close, volume FROM bars WHERE ticker = '1-URGENT'
""")
def a5_keyed_scan(spark, sf_dir):
    # one ticker: keep the view lazy so the key filter reaches the orders scan
    return loaders.series_for(bars(spark, sf_dir, materialized=False), "1-URGENT").drop("ticker")


@register("A6_G2_distinct_tickers", f"""
WITH {BARS_CTE}
SELECT DISTINCT ticker FROM bars
""")
def a6_distinct_tickers(spark, sf_dir):
    return loaders.distinct_tickers(bars(spark, sf_dir))


@register("A10_A9_partitioned_roundtrip", f"""
WITH {BARS_CTE}
SELECT year(timestamp) AS year, count(*) AS n, round(sum(close), 2) AS sum_close FROM bars
WHERE year(timestamp) >= 1998 GROUP BY 1
""")
def a10_partitioned_roundtrip(spark, sf_dir):
    """A10: bars appended into a year-partitioned table, read back with a
    partition filter (pruned scan); A9: the summary written as a JSON report."""
    base = _scratch(spark, "bars_table")
    sinks.append_partitioned(bars(spark, sf_dir), base)
    t = spark.read.parquet(base).filter(F.col("year") >= 1998)
    summary = t.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("close"), 2).alias("sum_close"))
    sinks.write_json_report(summary, f"{base}_report")
    return spark.read.schema("year int, n long, sum_close double").json(f"{base}_report")


@register("G1_union_sources", """
SELECT 'orders' AS source, date_trunc('day', o_orderdate) AS day, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'lineitem', date_trunc('day', l_shipdate), count(*) FROM lineitem GROUP BY 2
""")
def g1_union_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"),
                                              F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day"))
    li = table(spark, sf_dir, "lineitem").select(F.lit("lineitem").alias("source"),
                                                 F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("day"))
    return o.unionByName(li).groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- serving K2 K3 K5 K8
@register("K2_ticker_detail", f"""
WITH RECURSIVE {FEATURES_CTE},
lt AS (SELECT ticker, arg_max(timestamp, timestamp) AS ts, arg_max(close, timestamp) AS close,
              arg_max(volume, timestamp) AS volume FROM bars GROUP BY 1),
pv AS (SELECT b.ticker, arg_max(b.close, b.timestamp) AS pc FROM bars b JOIN lt ON b.ticker = lt.ticker
       WHERE b.timestamp < lt.ts GROUP BY 1),
li AS (SELECT ticker, arg_max(rsi_14, timestamp) AS rsi_14, arg_max(macd, timestamp) AS macd,
              arg_max(macd_signal, timestamp) AS macd_signal, arg_max(bollinger_upper, timestamp) AS bollinger_upper,
              arg_max(bollinger_lower, timestamp) AS bollinger_lower, arg_max(sma_50, timestamp) AS sma_50,
              arg_max(sma_200, timestamp) AS sma_200 FROM ind GROUP BY 1)
SELECT lt.ticker, round(lt.close, 2) AS latest_price,
       round(CASE WHEN coalesce(pv.pc, lt.close) <> 0 THEN (lt.close - coalesce(pv.pc, lt.close)) / coalesce(pv.pc, lt.close) * 100 ELSE 0 END, 2) AS change_pct,
       round(coalesce(pv.pc, lt.close), 2) AS previous_close, CAST(lt.volume AS BIGINT) AS volume, lt.ts AS timestamp,
       round(li.rsi_14, 2) AS rsi_14, round(li.macd, 4) AS macd, round(li.macd_signal, 4) AS macd_signal,
       round(li.bollinger_upper, 2) AS bollinger_upper, round(li.bollinger_lower, 2) AS bollinger_lower,
       round(li.sma_50, 2) AS sma_50, round(li.sma_200, 2) AS sma_200
FROM lt LEFT JOIN pv ON lt.ticker = pv.ticker LEFT JOIN li ON lt.ticker = li.ticker
""")
def k2_ticker_detail(spark, sf_dir):
    from tickwise.operators.indicators import technical_features
    b = bars(spark, sf_dir)
    return serving.ticker_detail(b, technical_features(b, keep_warmup=False, checkpoint=False))


@register("K3_history_page2", f"""
WITH {SERIES_CTE}
SELECT ticker, timestamp, round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low,
       round(close, 4) AS close, CAST(volume AS BIGINT) AS volume, CAST(n - 1 - rn - 50 AS INTEGER) AS row_in_page,
       2 AS page, 50 AS page_size
FROM s WHERE n - 1 - rn >= 50 AND n - 1 - rn < 100
""")
def k3_history_page(spark, sf_dir):
    return serving.history_page(bars(spark, sf_dir), page=2, page_size=50)


@register("K8_chart_series", f"""
WITH {SERIES_CTE}
SELECT ticker, timestamp AS date, round(close, 4) AS close, round(high, 4) AS high, round(low, 4) AS low
FROM s WHERE n - 1 - rn < 500
""")
def k8_chart_series(spark, sf_dir):
    return serving.chart_series(bars(spark, sf_dir))


@register("K5_health_status", f"""
WITH {BARS_CTE},
c AS (SELECT count(*) AS n, max(timestamp) AS last FROM bars),
h AS (SELECT n, last, round((epoch_us(TIMESTAMP '2001-08-03 12:00:00') - epoch_us(last)) / 3.6e9, 1) AS hours FROM c)
SELECT CASE WHEN n = 0 THEN 'failed' ELSE 'degraded' END AS status, last AS last_data_update,
       hours AS data_freshness_hours, n AS raw_prices_rows, 0::BIGINT AS predictions_rows,
       0::BIGINT AS model_registry_rows, CAST(NULL AS VARCHAR) AS active_model,
       concat_ws('; ', CASE WHEN hours > 48 THEN format('Data is {{}}h stale', CAST(round(hours) AS BIGINT)) END,
                 CASE WHEN n = 0 THEN 'No price data in database' END, 'No active model') AS message
FROM h
""")
def k5_health_status(spark, sf_dir):
    """K5 over bars, an empty predictions table and an empty registry."""
    from tickwise.plans.status import health_status
    empty_pred = spark.createDataFrame([], "ticker string, timestamp timestamp")
    empty_reg = spark.createDataFrame([], "model_name string, version string, f1 double, is_active boolean")
    return health_status(bars(spark, sf_dir), empty_pred, empty_reg, "2001-08-03 12:00:00")


def _standin_registry(spark, sf_dir):
    """Predictions: each ticker's last bar; registry: a row for each ticker, active where it has the most bars."""
    b = bars(spark, sf_dir)
    per = b.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("timestamp"))
    top = per.agg(F.max("n")).scalar()
    registry = per.select(F.lit("rule").alias("model_name"), F.col("ticker").alias("version"),
                          (F.col("n") / 10000).alias("f1"), (F.col("n") == top).alias("is_active"))
    return b, per.select("ticker", "timestamp"), registry


@register("K5_health_status_active", f"""
WITH {BARS_CTE},
per AS (SELECT ticker, count(*) AS n FROM bars GROUP BY 1),
c AS (SELECT count(*) AS n, max(timestamp) AS last FROM bars),
h AS (SELECT n, last, 12.0 AS hours, (SELECT count(*) FROM per) AS k,
             (SELECT max('rule:' || ticker) FROM per WHERE n = (SELECT max(n) FROM per)) AS active FROM c)
SELECT 'healthy' AS status, last AS last_data_update, hours AS data_freshness_hours, n AS raw_prices_rows, k AS predictions_rows,
       k AS model_registry_rows, active AS active_model, 'All systems operational' AS message FROM h
""")
def k5_health_status_active(spark, sf_dir):
    """K5 with fresh bars, predictions and an active model."""
    from tickwise.plans.status import health_status
    b, predictions, registry = _standin_registry(spark, sf_dir)
    clock = b.agg(F.max("timestamp") + F.expr("INTERVAL 12 HOURS")).first()[0]
    return health_status(b, predictions, registry, clock)


def _daily(spark, sf_dir):
    from tickwise.plans.daily import run_daily
    b = bars(spark, sf_dir, materialized=True)
    clock = b.agg(F.max("timestamp") + F.expr("INTERVAL 12 HOURS")).first()[0]     # half a day after the last bar
    return run_daily(spark, b, now=clock)


@register("K9_daily_job")
def k9_daily_job(spark, sf_dir):
    """K9: ingest bars -> gate -> features -> folds/prep -> three models -> refit, register, promote."""
    return _daily(spark, sf_dir)


@register("K9_daily_job_counts", f"""
WITH RECURSIVE {FEATURES_CTE},
f AS (SELECT ticker, count(*) AS n FROM train GROUP BY 1 HAVING count(*) >= 273)
SELECT 'inserted_rows' AS step, CAST(count(*) AS DOUBLE) AS value FROM bars
UNION ALL SELECT 'feature_rows', CAST(count(*) AS DOUBLE) FROM ind
UNION ALL SELECT 'train_rows', CAST(count(*) AS DOUBLE) FROM train
UNION ALL SELECT 'folds', CAST(coalesce(sum(floor((n - 273) / 21) + 1), 0) AS DOUBLE) FROM f
""")
def k9_daily_job_counts(spark, sf_dir):
    """The countable steps of the same job."""
    return _daily(spark, sf_dir).filter(~F.col("step").isin("best_f1", "promoted"))


@register("J14_registry", f"""
WITH {BARS_CTE},
m AS (SELECT ticker, count(*) AS n, row_number() OVER (ORDER BY ticker) AS k, round(count(*) / 10000.0, 4) AS f1 FROM bars GROUP BY 1),
a AS (SELECT *, max(f1) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM m)
SELECT 'rule' AS model_name, ticker AS version, ticker, f1, k = (SELECT max(k) FROM a WHERE best IS NULL OR k = 1) AS is_active FROM a
""")
def j14_registry(spark, sf_dir):
    """A model for each ticker (its F1 stands for the number of bars) registered in one change; the first one is promoted,
    the others only by a gain above 1, which none has."""
    from tickwise.operators.registry import ModelRegistry
    per = bars(spark, sf_dir).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0.0)
    rows = per.select(F.lit("rule").alias("model_name"), F.col("ticker").alias("version"), "ticker", zero.alias("accuracy"), zero.alias("precision_score"),
                      zero.alias("recall"), F.round(F.col("n") / 10000.0, 4).alias("f1"), F.lit(PRODUCED_AT).cast("timestamp").alias("trained_at"),
                      F.lit("").alias("model_path"))
    reg = ModelRegistry(spark, _scratch(spark, "registry"))
    reg.register_all(rows)
    for r in reg.table().orderBy("version").select("version", "f1").toLocalIterator():      # a row for each ticker of the registry
        reg.auto_promote_if_better(r.version, r.f1, threshold=1.0)
    return reg.table().select("model_name", "version", "ticker", "f1", "is_active")


@register("F5_page_one_ticker", f"""
WITH {BARS_CTE}
SELECT ticker, timestamp, open, high, low, close, volume FROM bars WHERE ticker = '2-HIGH'
ORDER BY timestamp DESC LIMIT 50 OFFSET 50
""")
def f5_page_one_ticker(spark, sf_dir):
    """F5 for one ticker: page 2 of 50, newest first (top-k with offset)."""
    from tickwise.operators.latest import page_newest_first
    b = bars(spark, sf_dir, materialized=False).filter(F.col("ticker") == "2-HIGH")
    return page_newest_first(b, page=2, page_size=50)


@register("R1_stream_windowed_counts", """
SELECT time_bucket(INTERVAL 5 minute, CAST(ts AS TIMESTAMP)) AS window_start, event_type AS path,
       CASE WHEN event_type = 'error' THEN '5xx' ELSE '2xx' END AS status_class, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def r1_stream_windowed_counts(spark, sf_dir):
    """R1 as Structured Streaming: 5-minute event-time windows in update mode. Every
    micro-batch writes the windows it changed; a window's count only grows, so its
    largest one is the current one (a replayed batch writes the same rows again)."""
    base = _scratch(spark, "counts")
    _log(spark, sf_dir).repartition(3).write.parquet(f"{base}/in")
    schema = "ts timestamp, client string, path string, status int, seq long"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = (rl.windowed_counts(src, "5 minutes").writeStream.outputMode("update")
         .foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}"))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out").groupBy("window_start", "path", "status_class").agg(F.max("n").alias("n"))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
