"""Helpers shared by the training-data operators.

Texts are handled in Arrow batches: a batch is cut into slices of a bounded
number of bytes, split into words by Arrow's C++ kernels and dictionary
encoded, so that per-word Python work happens once per distinct word of a
slice.
"""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tickwise.session import apply_conventions, checkpoint_dir, ship_package

SLICE_BYTES = 8 << 20
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session options of these jobs: UTC, adaptive execution, small Arrow batches
    (a batch of long texts must fit in a worker's memory)."""
    apply_conventions(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends
    there, and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tickwise-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: it does so when the driver's JVM
    collects their plans, which could be long after the disks are full. Results are not affected
    (what is still needed is referenced, and written tables stay)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str):
    """Column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores added until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices with at most ``max_bytes`` of text each (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of a slice: document ``i`` has ``codes[offsets[i]:offsets[i+1]]`` into ``vocab``."""

    offsets: np.ndarray
    codes: np.ndarray
    vocab: list[str]

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, A-Z lower-cased on request; null is empty."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values
    full = pc.greater(pc.binary_length(values), 0)
    keep = full.to_numpy(zero_copy_only=False)
    if not keep.all():
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        values = values.filter(full)
    encoded = values.dictionary_encode()
    return Words(offsets, encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist())


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i]+lengths[i]-1`` of every ``i``, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def with_text_columns(df: DataFrame, text_col: str, new_fields: str,
                      compute: Callable[[pa.Array], list[pa.Array]],
                      keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus ``new_fields`` (DDL) computed from the text.

    A kept column with the name of a new one (in any case) gives way to it.
    ``compute`` gets one bounded slice of texts and returns one Arrow array per
    new field.
    """
    fields = list(_parse_datatype_string(new_fields).fields)
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    at = {c: i for i, c in enumerate(df.columns)}
    old = [StructField(f"k{i}", df.schema.fields[at[c]].dataType) for i, c in enumerate(kept)]
    src = df.select(*[quoted(c).alias(f"k{i}") for i, c in enumerate(kept)],
                    quoted(text_col).cast("string").alias("t"))
    # positions as names inside the job: any outer name is legal
    inner = [StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)]
    n_kept = len(kept)

    def run(batches):
        for part in text_slices(batches, "t"):
            made = compute(part.column(n_kept))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(n_kept)), *made],
                names=[*(f"k{i}" for i in range(n_kept)), *(f"n{i}" for i in range(len(made)))])

    out = src.mapInArrow(run, StructType([*old, *inner]))
    return out.toDF(*kept, *[f.name for f in fields])


def remainder(doc_id, divisor: int):
    """crc32 of the id as text modulo ``divisor`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(labels: DataFrame, target: str, divisor: int, held_out: int, max_docs: int) -> DataFrame:
    """At most ``max_docs`` labelled ids (doc_id, target) that are not held out.

    The order is a hash of the id, so the sample does not depend on files or
    partitions. Rows without id or label are left out; several labels of one id
    count as the largest.
    """
    return (labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
            .where(remainder(F.col("doc_id"), divisor) != held_out)
            .groupBy("doc_id").agg(F.max(target).cast("int").alias("target"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))


def training_texts(docs: DataFrame, sample: DataFrame, max_chars: int) -> list[tuple[str, int]]:
    """(text, label) of the sampled documents, ordered by id; texts above ``max_chars`` are no
    training rows (they are scored like all others), which bounds what the driver holds."""
    rows = (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .where(F.length("text") <= max_chars)
            .join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("target").alias("target")).collect())
    return [(r.text, int(r.target)) for r in sorted(rows, key=lambda r: r.doc_id)]


HASH_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ASCII_EDGE = re.compile(r"^\W+|\W+$")


def bare(word: str) -> str:
    """Lower-cased word without leading and trailing non-word characters."""
    return _ASCII_EDGE.sub("", word).lower()
