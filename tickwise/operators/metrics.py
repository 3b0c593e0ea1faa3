"""Classification metrics per group (D12-D14), all grouped aggregates.

Any number of (ticker, fold, model) groups are scored in one ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b, F.lit(0))), F.lit(0.0))


def confusion_metrics(df: DataFrame, group: list[str], y_true: str = "y_true",
                      y_pred: str = "y_pred") -> DataFrame:
    """tp/fp/fn/tn, accuracy, precision, recall, F1 (zero division -> 0), win_rate."""
    t, p = F.col(y_true), F.col(y_pred)
    g = df.groupBy(*group).agg(
        F.count_if((p == 1) & (t == 1)).alias("tp"), F.count_if((p == 1) & (t == 0)).alias("fp"),
        F.count_if((p == 0) & (t == 1)).alias("fn"), F.count_if((p == 0) & (t == 0)).alias("tn"),
        F.count(F.lit(1)).alias("n"))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    acc = _ratio(F.col("tp") + F.col("tn"), F.col("n"))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, F.nullif(prec + rec, F.lit(0.0))), F.lit(0.0))
    return g.select(*group, "tp", "fp", "fn", "tn", "n", acc.alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    acc.alias("win_rate"))


RANGES = 200     # ranges of a group's scores


def roc_auc(df: DataFrame, group: list[str], y_true: str = "y_true",
            y_prob: str = "y_prob") -> DataFrame:
    """Rank-sum AUC with average ranks for ties; 0.5 if one class only.

    Equal scores are first collapsed to (score, count, positives). A sketch of each group's distinct
    scores cuts them into up to ``RANGES`` ranges of about equal size (any cuts give the right result); ranks
    run inside a range, and what lies in lower ranges is added from one row per range. So
    no task gets a whole group, and one group may hold all rows. Null scores are left out.
    """
    keys = [f"_k{i}" for i in range(len(group))] or ["_k0"]
    base = df.select(*([F.col(g).alias(k) for g, k in zip(group, keys)] or [F.lit(0).alias("_k0")]), F.col(y_prob).cast("double").alias("_p"),
                     (F.col(y_true) == 1).cast("int").alias("_y")).filter(F.col("_p").isNotNull())
    ties = base.groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_pos"))
    grid = F.array(*[F.lit(j / RANGES) for j in range(1, RANGES)])
    cuts = ties.groupBy(*keys).agg(F.percentile_approx("_p", grid, 10_000).alias("_cuts"))
    cuts = cuts.withColumnsRenamed({k: f"b{k}" for k in keys})
    same = ties[keys[0]].eqNullSafe(cuts[f"b{keys[0]}"])
    for k in keys[1:]:
        same = same & ties[k].eqNullSafe(cuts[f"b{k}"])
    # number of cuts below a score, equal scores alike
    placed = ties.join(cuts, same).select(*keys, "_p", "_c", "_pos", F.size(F.filter("_cuts", lambda c: c < F.col("_p"))).alias("_range"))
    w = Window.partitionBy(*keys, "_range").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.sum("_c").over(w) - (F.col("_c") - 1) / 2.0
    parts = placed.withColumn("_rank", rank).groupBy(*keys, "_range").agg(
        F.sum("_c").alias("n"), F.sum("_pos").alias("pos"), F.sum(F.col("_rank") * F.col("_pos")).alias("rs"))
    # at most RANGES rows for each group, added up in order
    whole = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_range", "n", "pos", "rs"))).alias("_parts"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("pos"), F.lit(0.0).alias("rs"))
    total = F.aggregate("_parts", start, lambda t, x: F.struct(
        (t["n"] + x["n"]).alias("n"), (t["pos"] + x["pos"]).alias("pos"), (t["rs"] + x["rs"] + t["n"] * x["pos"]).alias("rs")))
    g = whole.withColumn("_t", total)
    n1, n0 = F.col("_t.pos"), F.col("_t.n") - F.col("_t.pos")
    auc = F.when((n1 == 0) | (n0 == 0), F.lit(0.5)).otherwise((F.col("_t.rs") - n1 * (n1 + 1) / 2.0) / (n1 * n0))
    return g.select(*[F.col(k).alias(c) for c, k in zip(group, keys)], auc.alias("roc_auc"))


def mean_metrics(df: DataFrame, group: list[str], metrics: list[str],
                 status_col: str | None = None) -> DataFrame:
    """Average of metric columns per group (successful rows only if a status column)."""
    src = df.filter(F.col(status_col) == "success") if status_col else df
    return src.groupBy(*group).agg(F.count(F.lit(1)).alias("n_items"),
                                   *[F.avg(m).alias(f"avg_{m}") for m in metrics])
