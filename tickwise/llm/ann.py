"""Largest-inner-product search by multiprobe p-stable hashing.

Vectors are lifted so that the largest inner product is the smallest Euclidean
distance (one more coordinate, sqrt(M^2 - |x|^2); queries get
norm M and 0 there). M is the largest norm, or the 99.9th percentile of the norms where a
few are far larger: these few vectors form a bucket of their own that every query visits,
as they would push all others to one side of the sphere. Each of ``tables`` tables hashes with ``k`` functions
floor((a.x + b) / w), ``a`` Gaussian (2-stable). A query visits its own bucket and
perturbed ones: sets of -1/+1 steps in the order of their expected squared distance
(Lv et al., 2007), mapped to the query's own distances to its slots' borders.
Candidates of all tables are ranked by the exact inner product.

Fitting, on a sample of at most ``sample_rows`` vectors held against brute force: for
each ``k`` the smallest number of probes that reaches ``recall``, and of these the
``k`` of the least estimated cost for all vectors. Every vector is indexed.

Scale: equal vectors are one entry with its ``top + 1`` smallest ids (no other id of
such a class can be among ``top`` nearest); a bucket above ``block_rows`` entries
is salted into blocks, and its probes go to all of them. Blocks are dealt to bounded
parts; a part gets each query once, with the blocks it probes there. A query with
fewer than ``top`` results although there are more candidates is searched again in
all buckets.

Defined cases: vectors that are null, zero, or hold null or non-finite components,
and rows without id, take no part; shorter vectors count as padded with zeros; of
rows with the same id the smallest vector counts; equal scores go to the smaller
id; with fewer candidates than ``top`` all are returned; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwise.llm.common import quoted, scratch


@dataclass(frozen=True)
class AnnParams:
    top: int = 20
    tables: int = 4
    width: float = 2.0           # slot width in standard deviations of a projection
    bucket_rows: int = 64        # at least aimed at; bounds the number of functions
    probe_cost: float = 100.0    # of a probe row, in comparisons
    most_functions: int = 24
    recall: float = 0.95         # on the sample
    sample_rows: int = 8192      # bound of the fitting sample
    sample_queries: int = 200
    most_probes: int = 512       # of a table; beyond it the fit gives more tables
    block_rows: int = 4096
    part_rows: int = 60_000      # index entries of a part
    seed: int = 3


@dataclass(frozen=True)
class Index:
    """The hash functions: a few thousand numbers, whatever the table's size."""

    a: np.ndarray                # (tables, k, dims + 1)
    b: np.ndarray                # (tables, k)
    width: float
    norm: float
    steps: list                  # perturbation sets in order
    dims: int

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(tables, n, k) positions in slot widths."""
        length = np.linalg.norm(x, axis=1)
        if query:
            lifted = np.concatenate([x / np.maximum(length, 1e-300)[:, None] * self.norm, np.zeros((len(x), 1))], 1)
        else:
            rest = np.sqrt(np.maximum(self.norm ** 2 - length ** 2, 0))
            lifted = np.concatenate([x, rest[:, None]], 1)
        return (np.einsum("nd,tkd->tnk", lifted, self.a) + self.b[:, None, :]) / self.width

    def buckets(self, slots: np.ndarray, table: int) -> np.ndarray:
        """64-bit names of integer slots (..., k)."""
        h = np.full(slots.shape[:-1], table + 1, np.uint64)
        for j in range(slots.shape[-1]):
            h = (h ^ (slots[..., j].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        return h.view(np.int64)

    def own(self, x: np.ndarray) -> np.ndarray:
        """(n, tables) bucket of each indexed vector."""
        p = np.floor(self.project(x, False))
        out = np.stack([self.buckets(p[t], t) for t in range(len(p))], 1)
        out[self.beyond(x)] = LONG
        return out

    def beyond(self, x: np.ndarray) -> np.ndarray:
        return np.linalg.norm(x, axis=1) > self.norm * (1 + 1e-9)

    def probes(self, x: np.ndarray, count: int | None = None) -> np.ndarray:
        """(n, tables, probes) buckets that each query visits, in order."""
        steps = self.steps[:count]
        p = self.project(x, True)
        base = np.floor(p)
        out = np.empty((len(x), len(p), len(steps)), np.int64)
        k = p.shape[2]
        for t in range(len(p)):
            low = p[t] - base[t]
            border = np.argsort(np.concatenate([low, 1 - low], 1), axis=1)   # nearest border first
            for s, picked in enumerate(steps):
                slot = base[t].copy()
                for rank in picked:
                    side = border[:, rank - 1]
                    slot[np.arange(len(x)), side % k] += np.where(side < k, -1, 1)
                out[:, t, s] = self.buckets(slot, t)
        return out


LONG = -1            # bucket of the vectors beyond the norm


def probing_order(k: int, most: int) -> list[tuple[int, ...]]:
    """Sets of border ranks 1..2k (nearest first) by expected squared distance, the empty set first."""
    if k == 0:
        return [()]
    j = np.arange(1, 2 * k + 1)
    far = 2 * k + 1 - j
    cost = np.where(j <= k, j * (j + 1) / (4 * (k + 1) * (k + 2)),
                    1 - far / (k + 1) + far * (far + 1) / (4 * (k + 1) * (k + 2)))
    order, heap = [()], [(float(cost[0]), (1,))]
    while heap and len(order) < most:
        total, picked = heapq.heappop(heap)
        if all(2 * k + 1 - r not in picked for r in picked):   # not both borders of one slot
            order.append(picked)
        last = picked[-1]
        if last < 2 * k:
            heapq.heappush(heap, (total - cost[last - 1] + cost[last], (*picked[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last], (*picked, last + 1)))
    return order


def _visit_ranks(made: Index, queries: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """(queries, sample): number of the first probe that meets a vector in any table (large: none)."""
    never = len(made.steps) + 1
    own, visits = made.own(sample), made.probes(queries)
    ranks = np.full((len(queries), len(sample)), never)
    for t in range(own.shape[1]):
        for q in range(len(queries)):
            names, first = np.unique(visits[q, t], return_index=True)
            at = np.minimum(np.searchsorted(names, own[:, t]), len(names) - 1)
            met = names[at] == own[:, t]
            ranks[q, met] = np.minimum(ranks[q, met], first[at[met]])
    return ranks


def fit(sample: np.ndarray, n: int, norm: float, p: AnnParams) -> Index:
    """Functions and probing order for ``n`` vectors. Every number of functions that keeps
    ``bucket_rows`` in a bucket is tried on the sample: the probes it needs for the recall, and what they
    cost (rows for probes, comparisons for candidates); the cheapest is taken."""
    dims = sample.shape[1]
    rng = np.random.default_rng(p.seed)
    sample = sample[np.linalg.norm(sample, axis=1) <= norm * (1 + 1e-9)]
    lifted = np.concatenate([sample, np.sqrt(np.maximum(norm ** 2 - (sample ** 2).sum(1), 0))[:, None]], 1)
    direction = rng.normal(size=(64, dims + 1))
    width = max(p.width * float((lifted @ direction.T).std(0).mean()), 1e-12) if len(sample) else 1.0
    if n <= p.bucket_rows * 16:
        return Index(np.zeros((1, 0, dims + 1)), np.zeros((1, 0)), width, norm, [()], dims)
    slots = np.floor(lifted @ direction.T / width)
    entropy = np.mean([-(f * np.log(f)).sum() for f in (np.unique(c, return_counts=True)[1] / len(c) for c in slots.T)])
    most = int(np.clip(round(np.log(n / p.bucket_rows) / max(entropy, 0.05)), 1, p.most_functions))
    queries = sample[:: max(1, len(sample) // p.sample_queries)]
    near = queries @ sample.T
    # as many neighbours of the sample as stand for the nearest of all vectors
    m = int(np.clip(round((p.top + 1) * len(sample) / n), 2, len(sample)))
    nearest = np.argpartition(-near, m - 1, axis=1)[:, :m]
    tables = p.tables
    while True:
        choices = []
        for k in range(1, most + 1):
            made = Index(rng.normal(size=(tables, k, dims + 1)), rng.uniform(0, width, (tables, k)), width, norm,
                         probing_order(k, p.most_probes), dims)
            ranks = _visit_ranks(made, queries, sample)
            hit = np.sort(np.take_along_axis(ranks, nearest, 1).ravel())
            need = int(hit[int(np.ceil(p.recall * hit.size)) - 1]) + 1
            if need <= len(made.steps):
                cost = p.probe_cost * tables * need + float((ranks < need).mean()) * n
                choices.append((cost, k, Index(made.a, made.b, width, norm, made.steps[:need], dims)))
        if choices:
            return min(choices, key=lambda c: c[:2])[2]
        tables *= 2


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): usable vectors, one for each id."""
    v = F.transform(quoted(vec_col), lambda x: x.cast("double"))
    usable = (F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
              & F.exists("v", lambda x: x != 0))
    return (rows.select(quoted(id_col).cast("bigint").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & usable).groupBy("id").agg(F.min("v").alias("v")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = offsets - offsets[0]
    length = np.diff(offsets)
    if (length == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(length), dims))
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(flat)) - offsets[:-1][row]] = flat
    return out


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def index_rows(classes: DataFrame, index: Index) -> DataFrame:
    """(table, bucket, rep, v): one row for each vector and table."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), index.dims)
            own = shared.value.own(x)
            at, table = np.nonzero((own != LONG) | (np.arange(own.shape[1]) == 0))     # one row for a long vector
            yield pa.RecordBatch.from_arrays(
                [pa.array(table.astype(np.int32)), pa.array(own[at, table]), b.column(0).take(pa.array(at)), _lists(x[at])],
                names=["table", "bucket", "rep", "v"])

    return classes.select("rep", "v").mapInArrow(run, "table int, bucket bigint, rep bigint, v array<double>")


def probe_rows(queries: DataFrame, index: Index) -> DataFrame:
    """(bucket, q): buckets that each query visits."""
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = b.column(0).to_numpy()
            x = _matrix(b.column(1), index.dims)
            for s in range(0, len(x), 256):
                visits = shared.value.probes(x[s:s + 256]).reshape(len(x[s:s + 256]), -1)
                visits = np.concatenate([visits, np.full((len(visits), 1), LONG)], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(visits.ravel()), pa.array(np.repeat(ids[s:s + 256], visits.shape[1]))], names=["bucket", "q"])

    return queries.select("rep", "v").mapInArrow(run, "bucket bigint, q bigint")


def _rank_parts(top: int, dims: int):
    """Arrow function over rows sorted by (part, is_query): vectors of a part, then its queries with
    the blocks they probe; gives each query's ``top`` best of the part."""
    def best(vectors, reps, block_of, queries, q_ids, probes):
        """probes: (query row, block) pairs sorted by block."""
        order = np.argsort(block_of, kind="stable")
        vectors, reps, block_of = vectors[order], reps[order], block_of[order]
        who, block = probes
        order = np.argsort(block, kind="stable")
        who, block = who[order], block[order]
        names = np.unique(block)
        v0, v1 = np.searchsorted(block_of, names), np.searchsorted(block_of, names, "right")
        q0, q1 = np.searchsorted(block, names), np.searchsorted(block, names, "right")
        bar = np.full(len(queries), -np.inf)      # score of a query's top-th result so far
        got_q, got_v, got_s, size = [], [], [], 0

        def settle():
            nonlocal got_q, got_v, got_s, size
            q, v, s = np.concatenate(got_q), np.concatenate(got_v), np.concatenate(got_s)
            # a vector can come from several tables: once
            o = np.lexsort((reps[v], q))
            q, v, s = q[o], v[o], s[o]
            new = np.ones(len(q), bool)
            new[1:] = (q[1:] != q[:-1]) | (reps[v][1:] != reps[v][:-1])
            q, v, s = q[new], v[new], s[new]
            o = np.lexsort((reps[v], -s, q))
            q, v, s = q[o], v[o], s[o]
            first = np.searchsorted(q, q)
            keep = np.arange(len(q)) - first < top
            last = np.arange(len(q)) - first == top - 1
            bar[q[last]] = s[last] - 1e-9 * np.abs(s[last])
            got_q, got_v, got_s = [q[keep]], [v[keep]], [s[keep]]
            size = int(keep.sum())

        for k in range(len(names)):
            rows = who[q0[k]:q1[k]]
            if v0[k] == v1[k]:
                continue
            for at in range(0, len(rows), 512):
                part = rows[at:at + 512]
                score = queries[part] @ vectors[v0[k]:v1[k]].T
                i, j = np.nonzero(score >= bar[part][:, None])
                got_q.append(part[i])
                got_v.append(j + v0[k])
                got_s.append(score[i, j])
                size += len(i)
                if size > 60 * len(queries) + 500_000:
                    settle()
        if not got_q:
            return None
        settle()
        q, v = got_q[0], got_v[0]
        exact = np.einsum("ij,ij->i", queries[q], vectors[v])    # the same sum wherever a pair is met
        return pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(reps[v]), pa.array(exact)], names=["q", "rep", "score"])

    def run(batches):
        part, held = None, []
        waiting: list = []      # query rows of the part: (id, vector, blocks)

        def flush():
            if not waiting or not held:
                return
            vectors = np.concatenate([h[0] for h in held])
            reps = np.concatenate([h[1] for h in held])
            block_of = np.concatenate([h[2] for h in held])
            every = np.unique(block_of)
            waiting[:] = [(w[0], w[1], w[2] if len(w[2]) else every) for w in waiting]
            queries = np.stack([w[1] for w in waiting])
            q_ids = np.array([w[0] for w in waiting], np.int64)
            who = np.repeat(np.arange(len(waiting)), [len(w[2]) for w in waiting])
            made = best(vectors, reps, block_of, queries, q_ids, (who, np.concatenate([w[2] for w in waiting])))
            waiting.clear()
            if made is not None:
                yield made

        for b in batches:
            parts, is_query = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, (parts[1:] != parts[:-1]) | (is_query[1:] != is_query[:-1])))
            for s, e in zip(cuts, np.append(cuts[1:], len(parts))):
                if parts[s] != part:
                    yield from flush()
                    part, held = parts[s], []
                piece = b.slice(int(s), int(e - s))
                x = _matrix(piece.column(3), dims)
                ids, blocks = piece.column(2).to_numpy(), piece.column(4)
                if not is_query[s]:
                    held.append((x, ids, blocks.flatten().to_numpy()))
                else:
                    off = blocks.offsets.to_numpy() - blocks.offsets[0].as_py()
                    flat = blocks.flatten().to_numpy()
                    for i in range(len(ids)):
                        waiting.append((ids[i], x[i], flat[off[i]:off[i + 1]]))
                        if len(waiting) >= 2048:
                            yield from flush()
        yield from flush()

    return run


def _search(table: DataFrame, sizes: DataFrame, asked: DataFrame, parts: int, index: Index, top: int) -> DataFrame:
    """(q, rep, score): best results of ``asked`` (part, is_query, id, v, blocks) in the indexed vectors."""
    vectors = (table.join(sizes, "bucket")
               .withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
               .withColumn("block", _block())
               .select(_part(parts).alias("part"), F.lit(False).alias("is_query"), F.col("rep").alias("id"), "v",
                       F.array("block").alias("blocks")))
    both = vectors.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "is_query")
    found = both.mapInArrow(_rank_parts(top, index.dims), "q bigint, rep bigint, score double")
    return _best(found.groupBy("q", "rep").agg(F.max("score").alias("score")), "q", top, "rep")


def _block() -> Column:
    return F.xxhash64("bucket", "salt")


def _part(parts: int) -> Column:
    return F.pmod(F.col("block"), F.lit(parts)).cast("int")


def _probing(visits: DataFrame, sizes: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """Each query once for every part that holds blocks it visits."""
    return (visits.join(sizes, "bucket")
            .select("q", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("salt"))
            .withColumn("block", _block())
            .groupBy("q", _part(parts).alias("part")).agg(F.collect_set("block").alias("blocks"))
            .join(queries.select(F.col("rep").alias("q"), "v"), "q")
            .select("part", F.lit(True).alias("is_query"), F.col("q").alias("id"), "v", "blocks"))


def _everywhere(queries: DataFrame, parts: int) -> DataFrame:
    """Each query once for every part; no blocks stand for all of them."""
    return queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("is_query"),
                          F.col("rep").alias("id"), "v", F.array().cast("array<bigint>").alias("blocks"))


def _best(found: DataFrame, by: str, top: int, tie: str) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.col("score").desc(), F.col(tie))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def search(rows: DataFrame, is_query: Column, p: AnnParams = AnnParams(), id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): ``top`` nearest of each row for which ``is_query`` (an expression
    over ``id``) holds."""
    spark = rows.sparkSession
    vectors = scratch(valid_vectors(rows, id_col, vec_col), "vectors")
    by_vector = Window.partitionBy("v").orderBy("id")
    members = (vectors.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= p.top + 1)
               .withColumn("rep", F.min("id").over(Window.partitionBy("v"))))
    members = scratch(members.select("rep", "id", "v"), "members")
    classes = members.where("id = rep").select("rep", "v")
    asking = vectors.where(is_query).join(classes, "v").select("rep", F.col("id").alias("query_id"))
    asking = scratch(asking, "asking")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"),
                        F.max(square).alias("square"), F.percentile_approx(square, 0.999, 10_000).alias("usual")).first()
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(p.sample_rows).select("v").collect()
    dims = int(stats.dims or 1)
    matrix = np.zeros((len(sample), dims))
    for i, r in enumerate(sample):
        matrix[i, :len(r.v)] = r.v
    usual = float(stats.usual or 0.0)
    norm = float(np.sqrt(stats.square or 0.0)) if (stats.square or 0.0) <= 2 * usual else float(np.sqrt(usual))
    index = fit(matrix, stats.n, norm, p)
    table = scratch(index_rows(classes, index), "index")
    sizes = table.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / p.block_rows).alias("blocks"))
    queries = classes.join(asking.select("rep").distinct(), "rep", "left_semi")
    parts = max(8, -(-stats.n * len(index.a) // p.part_rows))
    asked = _probing(probe_rows(queries, index), sizes, queries, parts)
    found = scratch(_search(table, sizes, asked, parts, index, p.top + 1), "found")
    got = found.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(p.top + 1, stats.n))
    short = scratch(queries.join(got, queries.rep == got.q, "left_anti"), "short")
    if not short.isEmpty():     # too few in the buckets visited: against all vectors, part by part
        again = _search(table.where("table = 0"), sizes, _everywhere(short, parts), parts, index, p.top + 1)
        found = found.join(short.select(F.col("rep").alias("q")), "q", "left_anti").unionByName(again)
    ids = members.select("rep", "id")
    out = (asking.join(found.drop("rank").withColumnRenamed("rep", "hit"), asking.rep == F.col("q"))
           .select("query_id", "hit", "score").join(ids, F.col("hit") == ids.rep)
           .where("id <> query_id").select("query_id", "id", "score"))
    return _best(out, "query_id", p.top, "id").select("query_id", F.col("rank").cast("int").alias("rank"),
                                                      F.col("id").alias(id_col), "score")
