import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickwise.session import get_session
    s = get_session("local[4]", 4, extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def series_df(spark, closes, ticker="T", start="2020-01-01"):
    """A (ticker, timestamp, close) frame with one bar per day."""
    import pandas as pd
    ts = pd.date_range(start, periods=len(closes), freq="D")
    pdf = pd.DataFrame({"ticker": ticker, "timestamp": ts, "close": [float(c) for c in closes]})
    return spark.createDataFrame(pdf, "ticker string, timestamp timestamp_ntz, close double")
