"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host. A line's ratio is the number of the host's pages that
contain it (once or more) divided by the host's pages; lines above ``ratio`` on
at least ``least_pages`` pages are boilerplate and are dropped from every page of
the host. Lines are compared trimmed, and kept lines are left as they are, in order.

Counting is a sum with map-side combination, so neither a hot host nor a line that
stands on all pages is gathered. The lines to drop of one host are few whatever
its size: every page adds its lines' shares, so at most (mean lines of a page /
ratio) lines of a host can exceed the ratio. They form one row for each host, which
is joined to the pages. Hosts with over 1 / ``HOT`` of all pages (fewer than ``HOT`` hosts) are
joined by broadcast, and their pages are dealt out by text in the join of the others.

Defined cases: null texts stay null and count as pages without lines; blank lines
are never counted nor dropped; pages without host (null) form one host of their own;
repeated pages count as often as they stand there; long texts keep all
their other lines; an empty table gives an empty result; all columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import fresh_name, quoted, scratch


BLANKS = " \t\r\x0b\x0c"


HOT = 1000


@dataclass(frozen=True)
class BoilerplateParams:
    ratio: float = 0.3           # share of the host's pages above which a line is boilerplate
    least_pages: int = 3         # pages that must contain it


def line_key(line: Column) -> Column:
    """96 bits that stand for a trimmed line."""
    return F.concat(F.hex(F.xxhash64(line)), F.hex(F.hash(line)))


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def drop_boilerplate(pages: DataFrame, host: Column, text_col: str = "text",
                     p: BoilerplateParams = BoilerplateParams()) -> DataFrame:
    """The input with boilerplate lines gone from ``text_col``, plus ``n_lines`` and ``n_dropped``
    (suffixed with underscores if the input has such columns)."""
    host_col, flags, hot_flags, is_hot, key, hot_host, other_host = (fresh_name(pages, n) for n in (
        "host_of_page", "boilerplate", "hot_boilerplate", "is_hot", "host_key", "hot_host", "other_host"))
    n_lines, n_dropped = fresh_name(pages, "n_lines"), fresh_name(pages, "n_dropped")
    hosted = pages.withColumn(host_col, F.coalesce(host, F.lit("")))
    text = quoted(text_col)
    keys = F.array_distinct(F.transform(
        F.filter(F.transform(_lines(text), trimmed), lambda x: x != ""), line_key))
    seen = (hosted.select(F.col(host_col).alias("h"), F.explode(keys).alias("k"))
            .groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= p.least_pages))
    totals = hosted.groupBy(F.col(host_col).alias("h")).agg(F.count(F.lit(1)).alias("pages"))
    boiler = scratch(totals.join(
        seen.join(totals, "h").where(F.col("n") > F.lit(p.ratio) * F.col("pages"))
        .groupBy("h").agg(F.collect_list("k").alias("lines")), "h", "left"), "boilerplate")
    n_pages = boiler.agg(F.sum("pages")).first()[0] or 0
    hot = boiler.where(F.col("pages") * HOT > n_pages).select(
        F.col("h").alias(hot_host), F.col("lines").alias(hot_flags), F.lit(True).alias(is_hot))
    others = boiler.where((F.col("pages") * HOT <= n_pages) & F.col("lines").isNotNull()).select(
        F.col("h").alias(other_host), F.col("lines").alias(flags))
    joined = hosted.join(F.broadcast(hot), F.col(host_col) == F.col(hot_host), "left")
    # a hot page matches no row of the others, wherever its key deals it
    joined = joined.withColumn(key, F.when(F.col(is_hot), F.concat_ws("\n", host_col, F.xxhash64(text).cast("string")))
                               .otherwise(F.col(host_col)))
    joined = joined.join(others, (F.col(key) == F.col(other_host)) & (F.col(host_col) == F.col(other_host)), "left")
    joined = joined.withColumn(flags, F.coalesce(flags, hot_flags))
    is_boiler = lambda x: (trimmed(x) != "") & F.array_contains(F.col(flags), line_key(trimmed(x)))
    kept = F.when(F.col(flags).isNull(), _lines(text)).otherwise(F.filter(_lines(text), lambda x: ~is_boiler(x)))
    out = joined.withColumn(flags, kept)
    return (out.withColumn(n_lines, F.coalesce(F.size(_lines(text)), F.lit(0)))
            .withColumn(n_dropped, F.when(text.isNull(), 0).otherwise(F.col(n_lines) - F.size(flags)))
            .withColumn(text_col, F.when(text.isNull(), text).otherwise(F.array_join(F.col(flags), "\n")))
            .select(*[quoted(c) for c in pages.columns], n_lines, n_dropped))
