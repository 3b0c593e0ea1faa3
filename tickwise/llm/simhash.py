"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: one 64-bit XXH64 value per word shingle (repeats included); a bit of
the fingerprint is 1 if more than half of the values have it.

Candidates: bit positions get vectors of F_2^(r+1); table ``v`` keeps the bits
whose vector has an odd product with ``v`` (Pagh, 2016). Any ``r`` positions span
less than the whole space, so some ``v`` is orthogonal to all of them: every pair
within ``r`` bits agrees on the whole mask of that table. No link can be missed.

Work is done on distinct fingerprints. Table rows are sorted by (mask, masked
fingerprint) and walked in Arrow batches; a bucket gives a spanning forest of its
links, never all its pairs. A bucket above ``BUCKET`` fingerprints goes to a
further round, in which the still free bits are covered by a new set of masks;
buckets shrink with the free bits (at 12 free bits no bucket can be too large), so
the rounds end, and every pair stays in some bucket of every round.

Defined cases: null or blank texts have fingerprint zero and are linked like any
other; fewer words than a shingle form one shingle; repeated rows and ids share a
component; null ids are kept, linked through their fingerprint, and have a
component only if it holds some id; long texts are read whole, their shingles counted in
chunks; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import quoted, scratch, shuffle_partitions, with_text_columns
from tickwise.llm.graph import connected_components

BUCKET = 4096        # fingerprints compared with each other at most
NEAR = 64            # runs up to this length are compared for many buckets at once
_CHUNK = 1 << 16     # shingles whose bits are counted at a time


def fingerprint_bits(text: bytes, width: int, seed: int = 42) -> bytes:
    """Eight bytes, most significant bit first."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n = max(1, len(words) - width + 1)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        raw = b"".join([digest(joined[s:e], seed) for s, e in zip(starts[k:k + _CHUNK], stops[k:k + _CHUNK])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""
    def compute(texts: pa.Array) -> list[pa.Array]:
        raw = pc.fill_null(texts, "").cast(pa.binary()).to_pylist()
        value = np.frombuffer(b"".join(fingerprint_bits(t, width) for t in raw), ">i8").astype(np.int64)
        return [pa.array(value, pa.int64())]

    return with_text_columns(docs, text_col, "fp bigint", compute, [id_col])


def covering_masks(radius: int, level: int, bits: int = 64) -> list[int]:
    """Masks of a round: ``2**(radius+1) - 1`` signed numbers. Position vectors are the non-zero
    ones in turn, over an order of the positions that differs by round."""
    size = 1 << (radius + 1)
    order = np.random.default_rng(1000 + level).permutation(bits)
    vector = np.empty(bits, np.int64)
    vector[order] = 1 + np.arange(bits) % (size - 1)
    masks = []
    for v in range(1, size):
        odd = [i for i in range(bits) if (int(vector[i]) & v).bit_count() % 2]
        m = sum(1 << i for i in odd)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lowers ``label`` in place until linked rows agree."""
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
        still = label[i] != label[j]
        i, j = i[still], j[still]


def _forest(run: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Links (fingerprint, smallest row reached inside its run); runs are adjacent rows."""
    n = len(fp)
    label = np.arange(n)
    lengths = np.bincount(run)
    first = np.cumsum(lengths) - lengths
    short = (lengths <= NEAR)[run]
    for d in range(1, min(NEAR, int(lengths.max()))):
        at = np.flatnonzero(short[:-d] & (run[:-d] == run[d:]))
        if len(at) == 0:
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        _union(label, at, at + d)
    for r in np.flatnonzero(lengths > NEAR):
        s, e = first[r], first[r] + lengths[r]
        own = np.arange(lengths[r])
        for a in range(0, int(lengths[r]), 128):  # a block of rows against all of the run
            i, j = np.nonzero(np.bitwise_count(fp[s + a:min(e, s + a + 128), None] ^ fp[None, s:e]) <= radius)
            far = own[a + i] != own[j]
            _union(own, a + i[far], j[far])
        label[s:e] = s + own
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([fp[moved], fp[label[moved]]], axis=1)


def _bucket_walk(radius: int):
    """Arrow function over rows sorted by (mask, key): links as (0, a, b) and rows of oversized
    buckets as (1, mask, fp)."""
    def out(kind, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
            names=["kind", "a", "b"])

    def run(batches):
        held: list[np.ndarray] = []
        count = 0
        flooded = None       # (mask, key) of the bucket that is being passed on

        def work(rows, last):
            """Handles complete buckets of ``rows``; returns the rows of an open one."""
            nonlocal flooded
            made = []
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(rows)))
            head = tuple(rows[0, :2])
            large = size > BUCKET
            if flooded == head:
                large[0] = True
            stop = len(first) if last or large[-1] else len(first) - 1
            flooded = tuple(rows[-1, :2]) if large[-1] and not last else None
            big = np.repeat(large[:stop], size[:stop])
            done = rows[: int(size[:stop].sum())]
            if big.any():
                made.append(out(1, done[big, 0], done[big, 2]))
            few = np.repeat((size[:stop] > 1) & ~large[:stop], size[:stop])
            if few.any():
                part = done[few]
                name = np.cumsum(new[: len(done)][few]) - 1
                links = _forest(name, part[:, 2].copy(), radius)
                if len(links):
                    made.append(out(0, links[:, 0].copy(), links[:, 1].copy()))
            return rows[len(done):], made

        for b in batches:
            if b.num_rows == 0:
                continue
            held.append(np.stack([b.column(k).to_numpy().view(np.uint64) for k in range(3)], axis=1))
            count += b.num_rows
            if count >= 200_000:
                rest, made = work(np.concatenate(held), False)
                yield from made
                held, count = ([rest] if len(rest) else []), 0
        if held:
            yield from work(np.concatenate(held), True)[1]

    return run


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of distinct fingerprints (column ``fp``) that connect all that lie within
    ``radius`` bits, directly or through others."""
    spark = fps.sparkSession
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    links = None
    level = 0
    while True:
        masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius, level)])
        spread = (rows.select("mask", "fp", F.explode(masks).alias("more"))
                  .select(F.col("mask").bitwiseOR(F.col("more")).alias("mask"), "fp")
                  .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
        sorted_rows = (spread.repartition(shuffle_partitions(spark), "mask", "key")
                       .sortWithinPartitions("mask", "key", "fp"))
        found = scratch(sorted_rows.mapInArrow(_bucket_walk(radius), "kind int, a bigint, b bigint"), "buckets")
        part = found.where("kind = 0").select("a", "b")
        links = part if links is None else links.unionByName(part)
        rows = found.where("kind = 1").select(F.col("a").alias("mask"), F.col("b").alias("fp")).distinct()
        if found.where("kind = 1").isEmpty():
            return links
        level += 1


def cluster(docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links of at most
    ``radius`` differing bits."""
    fps = scratch(fingerprints(docs, width, id_col, text_col), "fingerprints")
    ids = quoted(id_col)
    classes = scratch(fps.groupBy("fp").agg(F.min(ids).alias("least")), "classes")
    comp = connected_components(near_links(classes.select("fp"), radius))
    joined = classes.join(comp, classes.fp == comp.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("group"), "least")
    least = joined.groupBy("group").agg(F.min("least").alias("component"))
    named = joined.select("fp", "group").join(least, "group").select("fp", "component")
    return fps.join(named, "fp").select(ids.alias(id_col), "fp", "component")
