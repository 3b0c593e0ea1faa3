"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
between stages the rows are written as Parquet to the shared checkpoint folder.
All but the last return the columns of ``documents``. Nulls follow the operators'
docstrings: rows with a null text go through every stage with an empty text.

The stages that compare documents decide row by row, whatever the ids: they write the rows
once with a key of their own, decide on narrow rows, and take the kept rows by their keys
through a shuffled hash join. Texts are in no sort and no aggregate, and rows with missing
or reused ids are treated like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import decontaminate, linededup, packing, quality, simhash
from tickwise.llm.common import fresh_name, prepare, quoted, scratch
from tickwise.llm.queries import MAX_BITS, SHINGLE_WORDS


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in like.columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    prepare(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.score(docs, model).where("predicted = 1"), docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in over 30 % of their source's documents; ``n_chars`` follows."""
    prepare(spark)
    out = linededup.drop_boilerplate(docs, F.col("source"))
    return _columns(out.withColumn("n_chars", F.length("text").cast("long")), docs)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written with a key that is unique among them, and its name."""
    key = fresh_name(docs, "row")
    return scratch(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def _kept(rows: DataFrame, key: str, keys: DataFrame, how: str, like: DataFrame) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) among ``keys``; the side of keys is hashed
    partition by partition, so the rows are never sorted."""
    return _columns(rows.join(keys.hint("shuffle_hash"), key, how), like)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id (missing ids come last)."""
    prepare(spark)
    rows, key = _keyed(docs)
    found = simhash.cluster(rows, SHINGLE_WORDS, MAX_BITS, id_col=key).select(F.col(key).alias("k"), "component")
    named = found.join(rows.select(F.col(key).alias("k"), F.col("doc_id").alias("id")), "k")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "k")).alias("first"))
    return _kept(rows, key, first.select(F.col("first.k").alias(key)), "left_semi", docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    prepare(spark)
    rows, key = _keyed(docs)
    leaks = decontaminate.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return _kept(rows, key, leaks.select(key).distinct(), "left_anti", docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the pieces of all remaining documents, with their token ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("line dedup", drop_boilerplate_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaked),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# A trained classifier, fingerprints and a tokenizer are outside SQL; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None
