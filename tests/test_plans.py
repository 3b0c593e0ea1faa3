"""Plan-shape guards: series operators never window a whole ticker in one task."""

import re

from tickwise.sources.tables import bars

SF = "/root/testdata/sf0.001"


def _window_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = []
    for line in plan.split("\n"):
        # "Window [exprs], [partition keys], [order keys]"
        m = re.search(r"Window \[.*\], \[([^\]]*)\], \[[^\]]*\]\s*$", line)
        if m:
            keys.append([k.split("#")[0].strip() for k in m.group(1).split(",") if k.strip()])
    return keys


def test_feature_windows_are_blocked(spark):
    from tickwise.operators.indicators import technical_features
    df = technical_features(bars(spark, SF), checkpoint=False)
    keys = _window_keys(df)
    assert keys, "expected window operators"
    for k in keys:
        # per-(ticker, block) or per-(ticker, year bucket); the only per-ticker
        # window runs over the small (ticker, bucket) count table
        assert ("_blk" in k or "_bkt" in k) or k == ["ticker"], k


def test_training_and_risk_have_no_whole_series_window(spark):
    from tickwise.operators.risk import recent_returns
    from tickwise.operators.training import training_frame
    plan = training_frame(bars(spark, SF), checkpoint=False)._jdf.queryExecution().executedPlan().toString()
    for ln in plan.split("\n"):
        if "Window [" in ln and "row_number()" in ln:
            assert "_bkt" in ln, ln
    # tails: at most days + 1 rows of a ticker leave a task, and only they are windowed
    plan = recent_returns(bars(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "253, Partial" in plan, plan


def test_no_cartesian_products(spark):
    from __spark_entry__ import queries
    q = queries()
    for name in ("K1_latest_prices", "K4_portfolio_risk", "K5_health_status", "D6_quality_gate",
                 "J18_backtest_rule"):
        plan = q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_halo_blocks_bound_partition_size(spark):
    """One ticker with 20k rows: every (ticker, block) partition holds at most
    block_rows + halo rows, and each row is home exactly once."""
    import numpy as np
    from pyspark.sql import functions as F
    from conftest import series_df
    from tickwise.operators.series import halo_blocks, number_rows
    n, block, halo = 20000, 1024, 806
    d = halo_blocks(number_rows(series_df(spark, np.arange(n) + 1.0, "HOT")), halo, block, lead=1)
    sizes = d.groupBy("ticker", "_blk").count()
    assert sizes.count() == -(-n // block)
    assert sizes.agg(F.max("count")).collect()[0][0] <= block + halo + 1
    home = d.filter("_home").agg(F.count(F.lit(1)), F.countDistinct("rn"), F.min("rn"), F.max("rn")).collect()[0]
    assert tuple(home) == (n, n, 0, n - 1)


def test_exponential_means_have_no_stage_by_key_alone(spark):
    """Runs are scanned by (key, group of blocks), then groups; the rows below are shuffled once."""
    import re
    from conftest import series_df
    from tickwise.operators.recurrence import Chain, Ewm, ewm_pass
    from tickwise.operators.series import halo_blocks, number_rows
    d = halo_blocks(number_rows(series_df(spark, [1.0 + i % 7 for i in range(500)])), 0, 64)
    out = ewm_pass(d, [Ewm("a", "close", 0.1), Ewm("b", "close", 0.05)], "ticker", 64, [Chain("c", "a", "b", 0.2)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    by = [[c.split("#")[0].strip() for c in m.split(",")] for m in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    scans = [k for k in by if any(c.startswith("_group") for c in k)]
    assert scans and all(len(k) >= 3 for k in scans)      # key, group, number of partitions
    assert plan.count("MapInPandas") >= 2


def test_auc_has_no_window_over_a_group(spark):
    from tickwise.operators.metrics import roc_auc
    df = spark.range(1000).selectExpr("CAST(id % 2 AS STRING) AS g", "id % 17 / 17.0 AS y_prob", "CAST(id % 3 = 0 AS INT) AS y_true")
    assert _window_keys(roc_auc(df, ["g"])) == [["_k0", "_range"]]
