"""Operators with hand tables: stats, folds, drawdown, limiter, contract, append, backtest."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import series_df


def test_exact_quantiles_and_moments(spark):
    from tickwise.functions.stats import exact_quantiles, kurt_unbiased, skew_unbiased
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    q = {r["p"]: r["quantile"] for r in exact_quantiles(df, "x", [0.05, 0.5]).collect()}
    assert q[0.05] == pytest.approx(1.15) and q[0.5] == pytest.approx(3.0)
    r = df.agg(F.stddev_samp("x"), F.stddev_pop("x"), skew_unbiased(F.col("x")),
               kurt_unbiased(F.col("x"))).collect()[0]
    assert r[0] == pytest.approx(3.095696, abs=1e-6) and r[1] == pytest.approx(2.680951, abs=1e-6)
    assert r[2] == pytest.approx(1.137624, abs=1e-6) and r[3] == pytest.approx(0.757656, abs=1e-6)


def test_exact_quantiles_grouped_with_hot_value(spark):
    from tickwise.functions.stats import exact_quantiles
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(3000, 5.0), rng.normal(0, 10, 2000)])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(vals)) % 3 == 0, "a", "b"), "x": vals})
    df = spark.createDataFrame(pdf)
    for rounds in (1, 2):
        got = {(r["g"], r["p"]): r["quantile"] for r in
               exact_quantiles(df, "x", [0.01, 0.25, 0.5, 0.99], ["g"], rounds=rounds).collect()}
        for g, sub in pdf.groupby("g"):
            for p in (0.01, 0.25, 0.5, 0.99):
                assert got[(g, p)] == pytest.approx(np.percentile(sub["x"], p * 100), abs=1e-12)


def test_walk_forward_folds_match_sliding_definition(spark):
    from tickwise.operators.folds import assign_folds
    for n in (100, 273, 315, 1500):
        f = assign_folds(series_df(spark, range(1, n + 1)))
        got = {(r["fold"], r["rn"], r["split"]) for r in f.select("fold", "rn", "split").collect()}
        want, start, k = set(), 0, 0
        while start + 273 <= n:
            want |= {(k, i, "train") for i in range(start, start + 252)}
            want |= {(k, i, "test") for i in range(start + 252, start + 273)}
            start, k = start + 21, k + 1
        assert got == want, n


def test_drawdown_curve_hand_values(spark):
    from tickwise.operators.risk import drawdown_curve
    df = spark.createDataFrame([("p", 0, -0.1), ("p", 1, 0.2)], "g string, pos int, r double")
    rows = drawdown_curve(df, ["g"], "pos").orderBy("pos").collect()
    assert [round(r["equity"], 10) for r in rows] == [0.9, 1.08]
    assert min(r["drawdown"] for r in rows) == 0.0


def test_limiters_hand_values():
    from tickwise.operators.requestlog import SlidingWindow
    from tickwise.streaming.limits import _fixed_runs
    hits = np.array([0, 0, 30, 60, 61], dtype=float)
    assert SlidingWindow(2, 60).decide(np.array(hits)).tolist() == [False, False, True, True, False]
    assert _fixed_runs(np.array(hits), None, 0, 2, 60)[0].tolist() == [False, False, True, False, False]


def test_batch_and_stream_limiter_agree(spark, tmp_path):
    from tickwise.operators.requestlog import sliding_log_limit
    from tickwise.streaming.limits import stream_limit
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), "c1", "/p", 200, i)
            for i, s in enumerate([0, 0, 30, 60, 61, 200, 201, 202])]
    schema = "ts timestamp, client string, path string, status int, seq long"
    log = spark.createDataFrame(rows, schema)
    batch = {r["seq"]: r["rejected"] for r in sliding_log_limit(log, 2, 60).collect()}
    log.write.parquet(str(tmp_path / "in"))
    q = (stream_limit(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "sliding", 2, 60)
         .writeStream.format("memory").queryName("lim_out").trigger(availableNow=True).start())
    q.awaitTermination()
    stream = {r["seq"]: r["rejected"] for r in spark.sql("select * from lim_out").collect()}
    assert batch == stream and batch[2] and batch[3] and not batch[4]


@pytest.mark.parametrize("kind", ["sliding", "fixed"])
def test_stream_limiter_calls_grow_with_buckets_not_keys(spark, tmp_path, kind):
    """Many keys (null ones too) in few calls; each key goes on from its own state in the next micro-batch."""
    import datetime as dt
    from tickwise.operators.requestlog import fixed_window_limit, sliding_log_limit
    from tickwise.streaming.limits import stream_limit
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=10 * i + k % 7), None if k == 5 else f"c{k}", "/p" if k % 2 else None, 200, 1000 * i + k)
            for i in range(6) for k in range(300)]
    schema = "ts timestamp, client string, path string, status int, seq long"
    log = spark.createDataFrame(rows, schema)
    log.where("seq < 3000").coalesce(1).write.parquet(str(tmp_path / "in"))
    source = str(tmp_path / "in")
    for turn in range(2):
        if turn:
            log.where("seq >= 3000").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        q = (stream_limit(stream, kind, 2, 30, buckets=8).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    got = {r["seq"]: r["rejected"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = (sliding_log_limit if kind == "sliding" else fixed_window_limit)(log.where("client is not null and path is not null"), 2, 30)
    want = {r["seq"]: r["rejected"] for r in batch.collect()}
    assert len(got) == 1800 and want and all(got[k] == v for k, v in want.items())
    by_key = lambda k: [got[1000 * i + k] for i in range(6)]
    assert by_key(5) == by_key(4) == by_key(7)


def test_limiter_bucket_forgets_only_idle_keys():
    from tickwise.streaming.limits import _decide

    class State:
        exists = hasTimedOut = False
        now = 0

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, value):
            self.exists, self.get = True, value

        def remove(self):
            self.exists = False

        def setTimeoutDuration(self, ms):
            self.due = self.now + ms

    def hit(client, second):
        return pd.DataFrame({"path": ["/p"], "client": [client], "ts": [pd.Timestamp(second, unit="s")], "seq": [second], "status": [200]})

    fn, state = _decide("sliding", 1, 10**12, 1000), State()
    run = lambda *hits: [x for out in fn((0,), iter(hits), state) for x in out["rejected"]]
    assert run(hit("a", 0), hit("b", 0)) == [False, False] and state.due == 1000
    state.now = 600
    assert run(hit("a", 1)) == [True] and state.due == 1000
    state.now, state.hasTimedOut = 1100, True
    assert run() == [] and state.due == 1600
    state.hasTimedOut = False
    assert run(hit("a", 2), hit("b", 2)) == [True, False]
    state.now, state.hasTimedOut = 2200, True
    assert run() == [] and not state.exists


def test_message_contract_cases(spark):
    from tickwise.functions.cleaning import apply_contract
    base = '"ticker":"aapl","timestamp":"2024-01-02T00:00:00+00:00","high":155,"low":149,"close":154'
    cases = {
        "str_price": ('{' + base + ',"open":"150.0","volume":1000000}', None),
        "frac_volume": ('{' + base + ',"open":150,"volume":1.5}', "bad_volume"),
        "float_volume": ('{' + base + ',"open":150,"volume":1000000.0}', None),
        "tiny_price": ('{' + base + ',"open":0.00001,"volume":5}', None),
        "missing": ('{"ticker":"a","timestamp":"2024-01-02","open":1,"high":1,"low":1,"volume":1}',
                    "missing_field"),
        "extra": ('{' + base + ',"open":150,"volume":5,"produced_at":"x"}', None),
        "bad_ts": ('{"ticker":"a","timestamp":"nope","open":1,"high":1,"low":1,"close":1,"volume":1}',
                   "bad_timestamp"),
        "list": ('[1,2]', "not_a_json_object"),
        "null": ('{' + base + ',"open":null,"volume":5}', "missing_field"),
        "empty_ticker": ('{"ticker":" ","timestamp":"2024-01-02","open":1,"high":1,"low":1,"close":1,"volume":1}',
                         "empty_ticker"),
        "neg_price": ('{' + base + ',"open":-150,"volume":5}', "bad_price"),
        "zero_volume": ('{' + base + ',"open":150,"volume":0}', "bad_volume"),
    }
    df = spark.createDataFrame([(k, v) for k, (v, _) in cases.items()], "name string, value string")
    got = {r["name"]: r for r in apply_contract(df, "value").collect()}
    for k, (_, err) in cases.items():
        assert got[k]["error"] == err, k
    assert got["str_price"]["ticker"] == "AAPL" and got["tiny_price"]["open"] == 0.0


def test_insert_if_absent_first_wins_existing_wins(spark):
    from tickwise.sources.sinks import insert_if_absent
    target = spark.createDataFrame([("A", 1, 10.0)], "k string, t int, v double")
    batch = spark.createDataFrame([("A", 1, 99.0, 0), ("B", 1, 1.0, 0), ("B", 1, 2.0, 1), ("C", 2, 3.0, 5)],
                                  "k string, t int, v double, arrival int")
    out = {(r["k"], r["t"]): r["v"] for r in insert_if_absent(batch, target, ["k", "t"], ["arrival"]).collect()}
    assert out == {("B", 1): 1.0, ("C", 2): 3.0}


def test_confusion_and_auc(spark):
    from tickwise.operators.metrics import confusion_metrics, roc_auc
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1), (1, 1, 0.8), (0, 0, 0.2), (1, 1, 0.7)],
                               "y_true int, y_pred int, y_prob double")
    m = confusion_metrics(df, []).collect()[0]
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 1.0, 1.0, 1.0)
    inv = df.withColumn("y_pred", 1 - F.col("y_pred"))
    assert confusion_metrics(inv, []).collect()[0]["f1"] == 0.0
    assert roc_auc(df, []).collect()[0]["roc_auc"] == 1.0
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y_true int, y_prob double")
    assert roc_auc(ties, []).collect()[0]["roc_auc"] == pytest.approx(0.875)
    one = spark.createDataFrame([(1, 0.5), (1, 0.2)], "y_true int, y_prob double")
    assert roc_auc(one, []).collect()[0]["roc_auc"] == 0.5


def test_prep_caps_and_scales(spark):
    from tickwise.operators.prep import prepare_folds
    rows = [("T", 0, "train", i, float(i), 0) for i in range(10)] + [("T", 0, "train", 10, 1000.0, 1)]
    rows += [("T", 0, "test", 11, 5000.0, 1), ("T", 0, "test", 12, -50.0, 0)]
    df = spark.createDataFrame(rows, "ticker string, fold int, split string, rn long, x double, target int") \
        .withColumn("timestamp", F.current_timestamp())
    out, counts = prepare_folds(df, ["x"], scale=False)
    got = {r["rn"]: r["x"] for r in out.collect()}
    q1, q3 = np.percentile(list(range(10)) + [1000], [25, 75])
    hi = q3 + 1.5 * (q3 - q1)
    assert got[10] == pytest.approx(hi)
    assert got[11] == pytest.approx(hi) and got[12] == pytest.approx(0.0)
    assert counts.collect()[0]["outliers_capped"] == 1
    const = spark.createDataFrame([("T", 0, "train", i, 3.0, 0) for i in range(5)],
                                  "ticker string, fold int, split string, rn long, x double, target int") \
        .withColumn("timestamp", F.current_timestamp())
    scaled, _ = prepare_folds(const, ["x"])
    assert {r["x"] for r in scaled.collect()} == {0.0}


def test_backtest_applies_prediction_to_next_return(spark):
    from tickwise.operators.backtest import backtest
    df = series_df(spark, [100, 110, 99, 120]).withColumn("target", F.lit(1)) \
        .withColumn("p", F.monotonically_increasing_id())

    def scorer(d):
        # predict UP on rows 0 and 2 only (by close value)
        return d.withColumn("y_pred", F.col("close").isin(100.0, 99.0).cast("int")) \
            .withColumn("y_prob", F.col("y_pred").cast("double"))
    r = backtest(df, scorer, days=4, min_rows=4).collect()[0]
    want = (1.1) * (120 / 99) - 1
    assert r["strategy_total_return"] == pytest.approx(round(want, 4))
    assert r["buyhold_total_return"] == pytest.approx(round(120 / 100 - 1, 4))


def test_latest_price_change_semantics(spark):
    """K1 compares with the last bar before the global max date (a ticker whose
    last bar is older compares with itself); K2 with its own previous bar."""
    from tickwise.plans.serving import latest_prices
    from tickwise.operators.latest import last_two
    a = series_df(spark, [10, 11, 12], "A")
    x = series_df(spark, [20, 22], "X")       # last bar one day before A's last
    b = a.unionByName(x).withColumn("volume", F.lit(1))
    k1 = {r["ticker"]: r["change_pct"] for r in latest_prices(b).collect()}
    assert k1["X"] == 0.0 and k1["A"] == pytest.approx(round((12 - 11) / 11 * 100, 2))
    k2 = {r["ticker"]: r["previous_close"] for r in last_two(b).collect()}
    assert k2["X"] == 20.0


def test_logistic_fit_matches_regularised_optimum():
    from tickwise.operators.models import fit_logistic
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3))
    y = (X[:, 0] + 0.5 * rng.normal(size=200) > 0).astype(float)
    beta = fit_logistic(X, y)
    p = 1 / (1 + np.exp(-(beta[0] + X @ beta[1:])))
    grad = np.concatenate([[np.sum(p - y)], X.T @ (p - y) + beta[1:]])
    assert np.max(np.abs(grad)) < 1e-8


def test_sentiment_placeholder_and_lexicon(spark):
    from tickwise.operators.sentiment import model_sentiment, neutral_sentiment
    df = spark.createDataFrame([(1, "Profits rise on record growth"), (2, "Shares plunge after loss"),
                                (3, "")], "doc_id long, text string")
    n = neutral_sentiment(df).collect()
    assert all(r["label"] == "neutral" and r["neutral"] == 1.0 for r in n)
    assert n[0]["text"] == "Profits rise on record growth"
    m = {r["doc_id"]: r for r in model_sentiment(df).collect()}
    assert m[1]["label"] == "positive" and m[1]["negative"] == 0.0
    assert m[2]["label"] == "negative" and m[3]["label"] == "neutral"
    named = model_sentiment(df.select(F.concat(F.lit("id-"), "doc_id").alias("key"), F.col("text").alias("head line")), id_col="key", text_col="head line")
    assert named.columns[:2] == ["key", "head line"] and {r.key for r in named.collect()} == {"id-1", "id-2", "id-3"}


def test_next_day_target_default_and_legacy(spark):
    from tickwise.operators.series import halo_blocks, home_only, number_rows
    from tickwise.operators.training import add_target
    layout = halo_blocks(number_rows(series_df(spark, [1, 2, 3])), halo=0, lead=1)
    default = [r["target"] for r in home_only(add_target(layout)).orderBy("timestamp").collect()]
    legacy = [r["target"] for r in home_only(add_target(layout, legacy_last_row=True)).orderBy("timestamp").collect()]
    assert default == [1, 1, None] and legacy == [1, 1, 0]


def test_paging_offset_keyset_and_unknown_ticker(spark):
    from tickwise.operators.latest import page_after, page_newest_first
    from tickwise.plans.serving import ticker_history
    b = series_df(spark, range(1, 121), "AAA").withColumn("open", F.col("close")) \
        .withColumn("high", F.col("close")).withColumn("low", F.col("close")).withColumn("volume", F.lit(1))
    p2 = [r["close"] for r in page_newest_first(b, 2, 50).collect()]
    assert p2 == [float(x) for x in range(70, 20, -1)]
    first = page_newest_first(b, 1, 50).collect()
    k2 = [r["close"] for r in page_after(b, first[-1]["timestamp"], 50).collect()]
    assert k2 == p2
    assert ticker_history(b, " aaa ", 3, 50).count() == 20
    assert ticker_history(b, "aaa", 4, 50).count() == 0
    with pytest.raises(LookupError):
        ticker_history(b, "zzz", 1, 50)


def test_prep_fixes_infinite_and_imputes(spark):
    from tickwise.operators.prep import prepare_folds
    inf = float("inf")
    xs = [1.0, inf, 3.0, None, 5.0, 6.0]
    rows = [("T", 0, "train", i, x, 0) for i, x in enumerate(xs)] + [("T", 0, "test", 6, None, 1)]
    df = spark.createDataFrame(rows, "ticker string, fold int, split string, rn long, x double, target int") \
        .withColumn("timestamp", F.timestamp_seconds(F.col("rn") * 86400))
    out, counts = prepare_folds(df, ["x"], cap=False, scale=False)
    got = {r["rn"]: r["x"] for r in out.collect()}
    # inf -> NULL, then forward fill (1 -> rn1, 3 -> rn3); the test split uses the train median
    assert [got[i] for i in range(6)] == [1.0, 1.0, 3.0, 3.0, 5.0, 6.0]
    assert got[6] == 3.0
    c = counts.collect()[0]
    assert c["imputed_values_train"] == 1 and c["imputed_values_test"] == 1
