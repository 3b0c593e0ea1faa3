"""Quality gates on both sides of their limits, the message contract, and the streaming ingest with failures."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

NOW = dt.datetime(2023, 5, 17, 12)


def frame(spark, n, nulls=0, age_hours=1.0, column="high"):
    rows = [{"ticker": f"Q{i % 3}", "timestamp": NOW - dt.timedelta(hours=age_hours, minutes=i), "open": 3.0, "high": 4.0, "low": 2.0, "close": 3.5,
             "volume": 10} for i in range(n)]
    for r in rows[:nulls]:
        r[column] = None
    return spark.createDataFrame([tuple(r.values()) for r in rows],
                                 "ticker string, timestamp timestamp, open double, high double, low double, close double, volume bigint")


@pytest.mark.parametrize("column", ["high", "ticker", "volume"])
@pytest.mark.parametrize("nulls,passed", [(4, True), (6, False)])
def test_null_rates_around_five_percent(spark, column, nulls, passed):
    from tickwise.operators import quality
    gate = quality.quality_gate(frame(spark, 100, nulls, column=column), NOW, min_rows=100).collect()
    failed = [r for r in gate if not r["passed"]]
    assert (not failed) == passed, failed


@pytest.mark.parametrize("hours,rows,passed", [(47.0, 30, True), (49.0, 30, False), (1.0, 30, True), (1.0, 29, False)])
def test_freshness_and_row_count_around_their_limits(spark, hours, rows, passed):
    from tickwise.operators import quality
    gate = quality.quality_gate(frame(spark, rows, age_hours=hours), NOW, min_rows=30).collect()
    assert all(r["passed"] for r in gate) == passed


def message(**change):
    m = {"ticker": " zq ", "timestamp": "2022-11-30T09:15:00+00:00", "open": 8.0, "high": 9.0, "low": 7.0, "close": 8.5, "volume": 12}
    m.update(change)
    return json.dumps({k: v for k, v in m.items() if v is not ...})


def test_contract_outcomes(spark):
    from tickwise.functions.cleaning import apply_contract
    cases = [(message(), None), (message(volume=0), "bad_volume"), (message(close=...), "missing_field"), ("[1, 2]", "any"), ("no json", "any"),
             (message(timestamp="yesterday"), "any"), (message(ticker="  "), "any")]
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, value string")
    got = {r.i: r for r in apply_contract(rows, "value").collect()}
    for i, (_, want) in enumerate(cases):
        assert (got[i].error is None) == (want is None), cases[i]
        assert want in (None, "any") or got[i].error == want
    assert got[0].ticker == "ZQ" and got[0].volume == 12


def batch_of(spark, values):
    rows = [(v, NOW, "p0", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, _arrived timestamp, _src string, _block bigint, _seq bigint")


def stored(spark, base):
    from tickwise.streaming import ingest
    prices = ingest.read_prices(spark, f"{base}/prices", f"{base}/stats")
    dead = ingest.read_dead_letters(spark, f"{base}/dead", f"{base}/stats")
    return (sorted((r.ticker, r.timestamp, r.close, r.ingest_epoch) for r in prices.collect()),
            sorted((r.raw, r.error, r.ingest_epoch) for r in dead.collect()), tuple(ingest.totals(spark, f"{base}/stats").first()))


EPOCHS = [[message(), message(close=8.7), message(ticker="b"), "broken"],
          [message(close=8.8), message(ticker="c"), message(volume=-1)], [message(ticker="c"), "broken"]]


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    from tickwise.streaming.ingest import IngestBatch
    base = tmp_path_factory.mktemp("whole")
    h = IngestBatch(f"{base}/prices", f"{base}/dead", f"{base}/stats")
    for e, values in enumerate(EPOCHS):
        h(batch_of(spark, values), e)
    return stored(spark, base)


def test_epochs_without_failure(undisturbed):
    prices, dead, totals = undisturbed
    assert [(t, c, e) for t, _, c, e in prices] == [("B", 8.5, 0), ("C", 8.5, 1), ("ZQ", 8.5, 0)]
    assert len(dead) == 3 and totals == (6, 3, 3)


@pytest.mark.parametrize("epoch", [0, 1])
@pytest.mark.parametrize("point", ["before prices", "after prices", "after dead letters", "after commit"])
def test_failure_between_any_two_writes(spark, tmp_path, monkeypatch, undisturbed, epoch, point):
    """An epoch fails at the point, readers see nothing of it (or all, once committed), and its replay completes it."""
    from tickwise.sources import commits
    from tickwise.streaming import ingest
    base = str(tmp_path)
    h = ingest.IngestBatch(f"{base}/prices", f"{base}/dead", f"{base}/stats")
    for e, values in enumerate(EPOCHS):
        if e == epoch:
            before = stored(spark, base)
            append, put = ingest.append_partitioned, commits.put_if_absent
            with monkeypatch.context() as m:
                if point == "before prices":
                    m.setattr(ingest, "append_partitioned", lambda *a, **k: 1 / 0)
                elif point == "after prices":
                    m.setattr(ingest, "append_partitioned", lambda *a, **k: (append(*a, **k), 1 / 0))
                elif point == "after dead letters":
                    m.setattr(commits, "put_if_absent", lambda *a: 1 / 0)
                else:
                    m.setattr(commits, "put_if_absent", lambda *a: (put(*a), 1 / 0))
                with pytest.raises(ZeroDivisionError):
                    h(batch_of(spark, values), e)
            assert point == "after commit" or stored(spark, base) == before
        h(batch_of(spark, values), e)
        h(batch_of(spark, values), e)       # a committed epoch is passed over
    assert stored(spark, base) == undisturbed


def test_first_arrival_is_by_file_time_and_line(spark, tmp_path):
    """Two files of one micro-batch, the later path arrived first; inside a file the earlier line wins."""
    from tickwise.streaming import ingest
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text(message(close=2.0) + "\n" + message(ticker="n", close=5.0) + "\n" + message(ticker="n", close=6.0) + "\n")
    (src / "z.txt").write_text("\n".join(message(ticker=f"f{i}") for i in range(300)) + "\n" + message(close=1.0) + "\n" + message(close=3.0) + "\n")
    os.utime(src / "z.txt", (1_600_000_000, 1_600_000_000))
    os.utime(src / "a.txt", (1_600_000_100, 1_600_000_100))
    base = str(tmp_path)
    q = ingest.run_ingest(ingest.file_source(spark, str(src)), f"{base}/prices", f"{base}/dead", f"{base}/stats", f"{base}/ckpt")
    q.awaitTermination()
    assert q.lastProgress is None or q.exception() is None
    got = {r.ticker: r.close for r in ingest.read_prices(spark, f"{base}/prices", f"{base}/stats").collect()}
    assert got["ZQ"] == 1.0 and got["N"] == 5.0 and len(got) == 302


def test_kafka_columns_are_read_in_offset_order(spark):
    """The Kafka source's columns (no broker here): bytes, message time, partition and offset."""
    from tickwise.streaming import ingest
    rows = [(bytearray(message(close=c).encode()), NOW + dt.timedelta(seconds=s), p, o) for c, s, p, o in [(4.0, 5, 0, 7), (2.0, 5, 0, 6), (3.0, 9, 1, 1)]]
    log = spark.createDataFrame(rows, "value binary, timestamp timestamp, partition int, offset bigint")
    from tickwise.sources.sinks import first_arrivals
    parsed = ingest.parse(ingest.from_kafka(log))
    assert [r.close for r in first_arrivals(parsed.drop("raw", "error"), ingest.KEYS, ingest.ARRIVAL).collect()] == [2.0]


def test_a_record_is_written_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    from tickwise.sources import commits
    path = f"{tmp_path}/log/r.json"
    assert commits.names(spark, f"{tmp_path}/log") == [] and not commits.exists(spark, path)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: commits.put_if_absent(spark, path, {"k": k}), range(8)))
    assert sum(won) == 1 and commits.read(spark, path) == {"k": won.index(True)}
    assert commits.names(spark, f"{tmp_path}/log") == ["r.json"]
    view = "viewfs://x/m/r.json"        # another scheme takes the rename of the file system's own API
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.x.link./m", f"file://{tmp_path}/log2")
    os.makedirs(f"{tmp_path}/log2")
    assert commits.put_if_absent(spark, view, {"a": 1}) and not commits.put_if_absent(spark, view, {"a": 2})
    assert commits.read(spark, view) == {"a": 1} and commits.names(spark, "viewfs://x/m") == ["r.json"]


def test_first_failed_critical_check_stops_a_job(spark):
    from tickwise.operators import quality
    with pytest.raises(quality.DataQualityError, match="null_rate:high"):
        quality.enforce(quality.quality_gate(frame(spark, 100, nulls=30), NOW, min_rows=50))
    with pytest.raises(quality.DataQualityError, match="freshness"):
        quality.enforce(quality.quality_gate(frame(spark, 100, age_hours=72), NOW, min_rows=50))
    kept = quality.enforce(quality.quality_gate(frame(spark, 100), NOW, min_rows=50))
    assert kept.filter(F.col("check") == "outliers").count() == 1
