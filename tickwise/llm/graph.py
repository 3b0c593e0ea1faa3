"""Connected components of a link table as Spark jobs.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step
re-attaches neighbours to the smallest neighbour, until the links form stars.
Minima are aggregated on the mappers first, and the joins are plain equi-joins
that adaptive execution splits when one node has very many links. The links of
every round are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import scratch


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct links as (hi, lo), without loops."""
    return (df.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of its neighbours and itself."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return links.select(F.col("lo").alias("u"), "hi").join(least, "u").select(
        F.col("hi").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").select(F.col("lo").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("hi").alias("a"), F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row.n, row.x


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node that has a link, with the smallest node it reaches.

    Loops, repeated and reversed links are allowed; rows with a null end link
    nothing; no links give an empty result.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    links = scratch(_pairs(links), "links")
    before = _state(links)
    while before[0]:
        links = scratch(_pairs(_small_star(_pairs(_large_star(links)))), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return (links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
            .unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()))
