"""Statistics helpers: exact grouped quantiles at scale, bias-corrected moments.

``exact_quantiles`` returns numpy/pandas-style linear-interpolated quantiles
(``h = p (n - 1)``, value = x[floor h] + frac * (x[ceil h] - x[floor h])).
Spark's ``percentile`` is exact but merges every distinct value of a group in
one task; here the wanted ranks are found by narrowing:

1. a mergeable sketch (``percentile_approx``) of each group gives ``GRID`` + 1 values
   at about equal ranks, whatever the values' distribution (its rank error, 1 / 10,000,
   is far below the two grid steps that are left on either side);
2. the interval of the grid that must hold the wanted ranks is kept, with the exact
   number of values below it; ``ROUNDS`` rounds leave some 0.1 % of a group;
3. equal values of the interval are collapsed (``groupBy(value).count()``) and a
   running count picks the values.

No task gets more than those, so neither a group with a third of all rows, nor a
value repeated a billion times, nor a few extreme values make a hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = 200
ROUNDS = 2


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: list[str] | None = None,
                    rounds: int = ROUNDS) -> DataFrame:
    """Rows (group..., p, quantile) with linear interpolation; NULL/NaN ignored."""
    gk = list(group or [])
    keys = [f"_k{i}" for i in range(len(gk))] or ["_k0"]
    v = F.col(value).cast("double")
    base = df.select(*([F.col(g).alias(k) for g, k in zip(gk, keys)] or [F.lit(0).alias("_k0")]), v.alias("_v"))
    base = base.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # one row for each group and probability: wanted ranks and the interval that holds them
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = stats.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    h = F.col("_p") * (F.col("_n") - 1)
    wanted = wanted.select(*keys, "_p", "_lo", "_hi", F.floor(h).alias("_r0"), F.ceil(h).alias("_r1"),
                           (h - F.floor(h)).alias("_frac"))   # ranks inside the interval

    def inside(w: DataFrame, *cols: str) -> DataFrame:
        w = w.select(*[F.col(k).alias(f"w{k}") for k in keys], "_p", "_lo", "_hi", *cols)
        same = [base[k].eqNullSafe(w[f"w{k}"]) for k in keys]
        on = same[0]
        for c in same[1:]:
            on = on & c
        return base.join(w, on).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"w{k}" for k in keys])

    grid = F.array(*[F.lit(j / GRID) for j in range(GRID + 1)])
    for _ in range(rounds):
        sketch = inside(wanted).groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_m"),
                                                          F.percentile_approx("_v", grid, 10_000).alias("_s"))
        j = _join(wanted, sketch, [*keys, "_p"])
        at = F.greatest(F.floor(F.col("_r0") * GRID / F.col("_m")) - 2, F.lit(0)).cast("int")
        to = F.least(F.ceil((F.col("_r1") + 1) * GRID / F.col("_m")) + 2, F.lit(GRID)).cast("int")
        lo = F.when(at > 0, F.element_at("_s", at + 1)).otherwise(F.col("_lo"))
        hi = F.when(to < GRID, F.element_at("_s", to + 1)).otherwise(F.col("_hi"))
        j = j.withColumns({"_lo2": lo, "_hi2": hi})
        below = inside(j, "_lo2").groupBy(*keys, "_p").agg(F.count_if(F.col("_v") < F.col("_lo2")).alias("_below"))
        wanted = _join(j, below, [*keys, "_p"]).select(
            *keys, "_p", F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"),
            (F.col("_r0") - F.col("_below")).alias("_r0"), (F.col("_r1") - F.col("_below")).alias("_r1"), "_frac")
    counts = inside(wanted, "_r0", "_r1", "_frac").groupBy(*keys, "_p", "_r0", "_r1", "_frac", "_v").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*keys, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_to", F.sum("_c").over(run))
    pick = lambda r: F.max(F.when((F.col(r) < F.col("_to")) & (F.col(r) >= F.col("_to") - F.col("_c")), F.col("_v")))
    res = upto.groupBy(*keys, "_p").agg(pick("_r0").alias("_x0"), pick("_r1").alias("_x1"), F.max("_frac").alias("_f"))
    return res.select(*[F.col(k).alias(g) for g, k in zip(gk, keys)], F.col("_p").alias("p"),
                      (F.col("_x0") + F.col("_f") * (F.col("_x1") - F.col("_x0"))).alias("quantile"))


def _join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    b = b.withColumnsRenamed({k: f"b{k}" for k in keys})
    on = a[keys[0]].eqNullSafe(b[f"b{keys[0]}"])
    for k in keys[1:]:
        on = on & a[k].eqNullSafe(b[f"b{k}"])
    return a.join(b, on).drop(*[f"b{k}" for k in keys])


def skew_unbiased(x: Column) -> Column:
    """pandas ``skew`` (G1) from Spark's population skewness; 0 for zero variance."""
    n = F.count(x)
    g1 = F.skewness(x)
    return F.when(n < 3, F.lit(None).cast("double")).when(F.stddev_pop(x) == 0, F.lit(0.0)) \
        .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_unbiased(x: Column) -> Column:
    """pandas ``kurt`` (G2, excess) from Spark's population kurtosis; 0 for zero variance."""
    n = F.count(x)
    g2 = F.kurtosis(x)
    return F.when(n < 4, F.lit(None).cast("double")).when(F.stddev_pop(x) == 0, F.lit(0.0)) \
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
