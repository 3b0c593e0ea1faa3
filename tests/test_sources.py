"""Sources: vendor melt (A1, B1, B2), period filter (A2), macro loader (A3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F


def test_vendor_melt_cleans_and_skips(spark):
    from tickwise.sources.loaders import melt_vendor_frame
    cols = ["date"] + [f"AAPL__{f}" for f in ("Open", "High", "Low", "Close", "Volume")]
    d0 = dt.datetime(2024, 1, 1)
    rows = [(d0, 150.0, 155.0, 149.0, 154.0, 1_000_000.0),
            (d0 + dt.timedelta(days=1), math.nan, 156.0, 150.0, 155.0, 1_100_000.0),   # NaN open
            (d0 + dt.timedelta(days=2), 152.0, 157.0, 151.0, 156.0, 0.0),              # zero volume
            (d0 + dt.timedelta(days=3), None, None, None, None, None),                 # all null
            (d0 + dt.timedelta(days=4), 153.123456, 158.0, 152.0, 157.0, 1_300_000.0)]
    wide = spark.createDataFrame(rows, ", ".join(
        ["date timestamp"] + [f"`{c}` double" for c in cols[1:]]))
    out = melt_vendor_frame(wide, ["AAPL", "MISSING"]).orderBy("timestamp").collect()
    assert len(out) == 2
    assert str(out[1]["open"]) == "153.1235" and out[0]["volume"] == 1_000_000


def test_period_filter_validates(spark):
    from tickwise.sources.loaders import period_filter
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1)), ("A", dt.datetime(2024, 6, 1)),
                                ("A", dt.datetime(2024, 12, 31))], "ticker string, timestamp timestamp")
    assert period_filter(df, "1mo").count() == 1
    assert period_filter(df, "ytd").count() == 3
    assert period_filter(df, "max").count() == 3
    with pytest.raises(ValueError):
        period_filter(df, "7w")


def test_macro_loader(spark):
    from tickwise.sources.loaders import load_macro_series
    raw = spark.createDataFrame([("UNRATE", dt.datetime(2024, 1, 1), 3.5), ("UNRATE", dt.datetime(2024, 2, 1), 3.6),
                                 ("UNRATE", dt.datetime(2024, 3, 1), math.nan), ("GDP", dt.datetime(2019, 1, 1), 1.0),
                                 ("X", dt.datetime(2024, 1, 1), 1.23456789)],
                                "series_id string, timestamp timestamp, value double")
    names = spark.createDataFrame([("UNRATE", "Unemployment Rate"), ("GDP", "Gross Domestic Product"),
                                   ("X", "x")], "series_id string, name string")
    out = {(r["series_id"], r["timestamp"].month): r["value"] for r in
           load_macro_series(raw, names, "2020-01-01").collect()}
    assert out == {("UNRATE", 1): 3.5, ("UNRATE", 2): 3.6, ("X", 1): 1.234568}


def test_macro_loader_sends_no_series_to_one_task(spark):
    """Rows of three series stay in the tasks that read them: neither shuffled nor sorted; ids may repeat or be null."""
    from tickwise.sources.loaders import load_macro_series
    raw = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 10 != 3, F.concat(F.lit("S"), (F.col("id") % 3).cast("string"))).alias("series_id"),
        F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"), F.col("id").cast("double").alias("value"))
    names = spark.createDataFrame([("S0", "a"), ("S1", "b"), ("S1", "c"), (None, "d")], "series_id string, name string")
    out = load_macro_series(raw, names).withColumn("task", F.spark_partition_id())
    got = out.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("task").alias("tasks")).collect()
    assert {r["name"]: (r["n"], r["tasks"]) for r in got} == {"a": (1800, 6), "b": (1800, 6), "c": (1800, 6)}
