"""Probabilistic suffix tree over words, as a language model of whole texts.

Symbols are the words of a text (A-Z lower-cased) and an end symbol. Contexts are
the last ``d`` symbols, d = 0 .. ``depth``. The root is the add-0.5 distribution
over the training vocabulary and one unknown word. A longer context ``s`` that occurs at
least ``least`` times in the training texts is tested against the distribution ``q``
of its longest retained suffix: the leave-one-out divergence

    sum over x of N(sx) * ln( (N(sx) - 1 + m q(x)) / ((N(s) - 1 + m) q(x)) )

must reach ``divergence`` nats. Next-symbol distributions are smoothed towards the
suffix, P(x|s) = (N(sx) + m q(x)) / (N(s) + m), so every state sums to one. A
symbol is scored in the longest retained suffix of its history.

Contexts grow a word at a time, to ``depth`` words or until none is left that could grow. From two words on
only contexts that are *alive* are extended: with q the distribution in force after the
context's own test, an extension, however long, keeps n(x) <= N(sx) of the occurrences before x, n >= ``least`` in all.
For n from lo up to hi, each occurrence before x gains at most v(x) = ln( (c(x) - 1 + m q(x)) / ((lo - 1 + m) q(x)) ), c(x) = min(N(sx), hi),
so the extension gains at most what lo to hi occurrences of the largest v gain together, at most c(x) of them before x.
If that is below ``divergence`` for lo, hi = least, 2 least, 4 least, ... none can pass its test, and leaving them out changes nothing.

Jobs: texts become blocks of token numbers (some MB each, written once). A word's total and its number among words of
that total stand for it in later messages. All contexts that end in a word are extensions of it, so the first two levels
are one exchange: a block sends the distinct (word, word before it, next symbol) triples to the bucket of the word,
where both levels are counted and tested, and the counts go back, in the order asked. A triple is sent once for
each block that holds it, however frequent its contexts are: this grows as the text. Words with more tokens than
``hot_count`` (a share of all, or of a bucket, whichever is more) are spread: their pairs are counted first, in
buckets of pairs; then their triples go by both words, or, if these are hot too, by the next symbol as well, with tests summed over buckets
(at most 1 / hot_share hot contexts a level, which bounds what is broadcast). Then a block keeps only the tokens that
alive contexts still need, and asks level by level for the counts of its distinct (context, next symbol) pairs,
grouped by bucket (a hash of the context). Nothing grows on the driver.

Defined cases: null and empty texts are the end symbol alone; a null id counts as the
empty string for the fold; repeated rows are scored and counted row by row; texts are
never cut; no training text leaves one unknown symbol of probability 1; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import HASH_MUL, free_shuffles, mix64, quoted, scratch, shuffle_partitions, split_words, text_slices


@dataclass(frozen=True)
class PstParams:
    depth: int = 6               # longest context, in words
    least: int = 8               # occurrences of a context
    divergence: float = 4.0      # nats, in all
    mass: float = 1.0            # m: weight of the suffix's distribution
    hot_share: float = 1e-4
    block_bytes: int = 6 << 20   # text of a block
    bucket_tokens: int = 1_000_000


HEAD = 2                               # levels that all frequent contexts take part in, in one exchange

END = xxhash.xxh64_intdigest("\n")     # no word has white space

_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()    # a Python worker runs one task at a time


def _zip(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    raw = np.ascontiguousarray(a)
    return _PACK.compress(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes() if len(raw) else b"")


def _unzip(blob, dtype: str) -> np.ndarray:
    raw = np.frombuffer(_UNPACK.decompress(blob), np.uint8)
    dt = np.dtype(dtype)
    return np.ascontiguousarray(raw.reshape(dt.itemsize, -1).T).view(dt).ravel() if len(raw) else np.zeros(0, dt)


def _pair_name(parent: np.ndarray, following: np.ndarray) -> np.ndarray:
    return mix64(parent * HASH_MUL + following)


def _word_name(count: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A word's hash from its training count and its number among the words of that count."""
    return mix64(count.astype(np.uint64) * HASH_MUL + number)


def _base(count: np.ndarray, total: tuple[int, int]) -> np.ndarray:
    return (count + 0.5) / (total[0] + 0.5 * (total[1] + 1))


def hot_count(total: tuple[int, int], p: PstParams) -> float:
    """Contexts that occur more often are spread over the buckets."""
    return max(p.hot_share * total[0], p.bucket_tokens / 4)


_BLOCK = "block bigint, ids array<bigint>, lengths array<int>, train array<boolean>, codes binary, vocab binary, rank binary"


def token_blocks(docs: DataFrame, train: Column, p: PstParams, id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole documents: token numbers, the block's vocabulary of 64-bit word hashes, and the number of each."""
    src = docs.select(quoted(id_col).cast("bigint").alias("id"), train.alias("train"), quoted(text_col).cast("string").alias("t"))

    def block(name, ids, train_flags, lengths, hashes):
        vocab, codes, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")       # frequent words get small numbers
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[codes]
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([np.concatenate(lengths)], pa.list_(pa.int32())), pa.array([train_flags], pa.list_(pa.bool_())),
             pa.array([_zip(codes.astype("<u4"))], pa.binary()), pa.array([_zip(vocab.astype("<u8"))], pa.binary()),
             pa.array([_zip(rank.astype("<u4"))], pa.binary())],
            names=["block", "ids", "lengths", "train", "codes", "vocab", "rank"])

    def run(batches):
        name = TaskContext.get().partitionId() << 32
        ids, flags, lengths, hashes, held = [], [], [], [], 0
        for part in text_slices(batches, "t", p.block_bytes):
            w = split_words(part.column(2), lower=True)
            known = np.fromiter((xxhash.xxh64_intdigest(x) for x in w.vocab), np.uint64, len(w.vocab))
            counts = np.diff(w.offsets)
            flat = np.insert(known[w.codes], w.offsets[1:], np.uint64(END))
            ids += part.column(0).to_pylist()
            flags += part.column(1).to_pylist()
            lengths.append((counts + 1).astype(np.int32))
            hashes.append(flat)
            held += part.column(2).nbytes
            if held >= p.block_bytes:
                yield block(name, ids, flags, lengths, hashes)
                name, ids, flags, lengths, hashes, held = name + 1, [], [], [], [], 0
        if ids:
            yield block(name, ids, flags, lengths, hashes)

    return src.mapInArrow(run, _BLOCK)


@dataclass
class Block:
    ids: list
    lengths: np.ndarray
    train: np.ndarray            # per token
    codes: np.ndarray
    rank: np.ndarray             # code of each word, in the order of their hashes
    place: np.ndarray = field(default=None)  # position of a token in its document

    @staticmethod
    def read(t: pa.Table) -> "Block":
        lengths = np.array(t.column("lengths")[0].values, np.int64)
        first = np.cumsum(lengths) - lengths
        return Block(t.column("ids")[0].as_py(), lengths,
                     np.repeat(np.array(t.column("train")[0].as_py(), bool), lengths),
                     _unzip(t.column("codes")[0].as_buffer(), "<u4").astype(np.int64),
                     _unzip(t.column("rank")[0].as_buffer(), "<u4").astype(np.int64),
                     np.arange(int(lengths.sum())) - np.repeat(first, lengths))


KEPT, ALIVE, KEPT_WORD = 1, 2, 4       # outcome of a context's test, and of its last word's, as bits of a reply


@dataclass
class Level:
    """Distinct (context, next) pairs of a block at one depth, in the order of the request."""

    at: np.ndarray               # token positions that have such a pair
    pair: np.ndarray             # their pair
    context: np.ndarray          # context number of each pair (pair order)
    next: np.ndarray             # next token's code of each pair
    n_context: np.ndarray        # training count of each pair's context
    name: np.ndarray             # hash of each pair
    parent: np.ndarray           # hash of each pair's context
    order: np.ndarray            # pairs sorted by bucket
    cuts: np.ndarray             # of the buckets in ``order``
    hot: np.ndarray              # of each pair's context

    def answer(self, reply: dict[int, tuple], passed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the pairs, and of each pair's context: retained, alive. ``passed``: retained hot contexts."""
        count = np.empty(len(self.name), np.int64)
        count[self.order] = _joined(reply, 0, "<i8")
        flags = np.empty(len(self.name), np.uint8)
        flags[self.order] = _joined(reply, 1, "<u1")
        kept = np.where(self.hot, np.isin(self.parent, passed), (flags & KEPT) > 0)
        return count, kept, self.hot | ((flags & ALIVE) > 0)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _sorted_by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.int64), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def _hot_pairs(b: Block, words: np.ndarray, count: np.ndarray, buckets: int, hot_above: float, p: PstParams) -> Level:
    """Pairs of a hot word and the token after it. ``words``, ``count``: hashes and training counts of the block's words."""
    last = np.append(-1, b.codes[:-1])
    at = np.flatnonzero((b.place >= 1) & (p.depth >= 1))
    at = at[(count[last[at]] >= p.least) & (count[last[at]] > hot_above)]
    key, pair = np.unique(last[at] * len(words) + b.codes[at], return_inverse=True)
    context, following = key // len(words), key % len(words)
    parent = words[context]
    name = _pair_name(parent, words[following])
    order, cuts = _sorted_by_bucket(_bucket(name, buckets), buckets)
    return Level(at, pair, context, following, count[context], name, parent, order, cuts, np.ones(len(name), bool))


NO_WORD = (-1, 0)                      # count and number in place of a word before that no frequent context holds


@dataclass
class Triples:
    """Distinct (last word, word before it, next symbol) of a block, for the contexts of one and two words."""

    at: np.ndarray               # token positions that have such a triple
    triple: np.ndarray           # their triple
    context: np.ndarray          # number of each triple's context (triple order)
    next: np.ndarray             # next token's code of each triple
    known: np.ndarray            # training count of (last, next) where the last word is hot, or 0
    last: np.ndarray             # codes of each context's words
    before: np.ndarray           # len(words): none
    name: np.ndarray             # hash of each context
    n_hot: np.ndarray            # training count of each hot context, or 0
    order: np.ndarray            # triples sorted by bucket
    cuts: np.ndarray             # of the buckets in ``order``

    @staticmethod
    def of(b: Block, words: np.ndarray, count: np.ndarray, pairs: np.ndarray, buckets: int, hot_above: float, p: PstParams) -> "Triples":
        """``pairs``: training count of the pair of words that ends at each token, where its first one is hot (-1 elsewhere)."""
        none = len(words)
        at = np.flatnonzero((b.place >= 1) & (p.depth >= 1))
        at = at[count[b.codes[at - 1]] >= p.least]
        last, before = b.codes[at - 1], b.codes[at - 2]
        n = pairs[at - 1]
        before = np.where((b.place[at] >= 2) & (p.depth >= 2) & (count[before] >= p.least) & ((n < 0) | (n >= p.least)), before, none)
        wanted = (count[last] <= hot_above) | (before != none)       # pairs of hot words are known
        at, last, before, n = at[wanted], last[wanted], before[wanted], n[wanted]
        key, of = np.unique(last * (none + 1) + before, return_inverse=True)
        n_hot = np.zeros(len(key), np.int64)
        n_hot[of] = np.where((before != none) & (n > hot_above), n, 0)
        triples, triple = np.unique(of * none + b.codes[at], return_inverse=True)
        context, following = triples // max(none, 1), triples % max(none, 1)
        last, before = key // (none + 1), key % (none + 1)
        name = _pair_name(np.append(words, _no_word())[before], words[last])
        known = np.zeros(len(triples), np.int64)
        known[triple] = np.maximum(pairs[at], 0)
        by = np.where(count[last] > hot_above, name, words[last])
        by = np.where((n_hot > 0)[context], _pair_name(name[context], words[following]), by[context])
        order, cuts = _sorted_by_bucket(_bucket(mix64(by), buckets), buckets)
        return Triples(at, triple, context, following, known, last, before, name, n_hot, order, cuts)


def _no_word() -> np.ndarray:
    return _word_name(np.array([NO_WORD[0]]), np.array([NO_WORD[1]], np.uint64))


class Walk:
    """State of a block after the replies to its requests so far: words, pairs of hot words, triples."""

    def __init__(self, b: Block, replies: list[dict[int, tuple]], total: tuple[int, int], hot: list, buckets: int, p: PstParams):
        hot_above = hot_count(total, p)
        self.b = b
        count = np.empty(len(b.rank), np.int64)
        count[b.rank] = _joined(replies[0], 0, "<i8")
        number = np.empty(len(b.rank), np.uint64)
        number[b.rank] = _joined(replies[0], 1, "<u8")
        self.word_count, self.word_number = count, number
        words = _word_name(count, number)
        self.base = _base(count[b.codes], total)
        self.prob = self.base.copy()
        self.level = lv = _hot_pairs(b, words, count, buckets, hot_above, p)
        if len(replies) <= 1:
            return
        found, kept, _ = lv.answer(replies[1], hot[1])
        self._smooth(lv.at, found[lv.pair], lv.n_context[lv.pair], kept[lv.pair], p)
        pairs = np.full(len(b.codes), -1)
        pairs[lv.at] = found[lv.pair]
        self.triples = t = Triples.of(b, words, count, pairs, buckets, hot_above, p)
        if len(replies) <= 2:
            return
        found, flags, in_pairs, among = (np.empty(len(t.order), d) for d in ("<i8", "<u1", "<i8", "<i8"))
        for column, a in enumerate((found, flags, in_pairs, among)):
            a[t.order] = _joined(replies[2], column, a.dtype.str)
        n_last = count[t.last]
        self._smooth(t.at, in_pairs[t.triple], n_last[t.context][t.triple],
                     (((flags & KEPT_WORD) > 0) & (n_last <= hot_above)[t.context])[t.triple], p)
        is_hot = (t.n_hot > 0)[t.context]
        kept = np.where(is_hot, np.isin(t.name, hot[2])[t.context], (flags & KEPT) > 0)
        self._smooth(t.at, found[t.triple], np.where(is_hot, t.n_hot[t.context], among)[t.triple], kept[t.triple], p)
        self.gram_count = np.zeros(len(b.codes), np.int64)
        self.gram_count[t.at] = found[t.triple]
        self.alive = np.zeros(len(b.codes), bool)
        self.alive[t.at] = (is_hot | ((flags & ALIVE) > 0))[t.triple]

    def _smooth(self, at, found, among, use, p: PstParams) -> None:
        at, found, among = at[use], found[use], among[use]
        self.prob[at] = (found + p.mass * self.prob[at]) / (among + p.mass)


@dataclass
class Rest:
    """Tokens of a block that contexts of more than HEAD words need, in order: most of them by their word alone."""

    codes: np.ndarray
    word_count: np.ndarray       # of the words that ``codes`` names
    word_number: np.ndarray
    train: np.ndarray
    doc: np.ndarray              # number of the token's document in the block
    place: np.ndarray            # position in its document
    count: np.ndarray            # of the (HEAD + 1)-gram that ends here, at most ``least`` where neither context is alive
    alive: np.ndarray            # the context of HEAD words before it can grow
    prob: np.ndarray             # where alive

    TYPES = {"codes": "<u4", "word_count": "<i8", "word_number": "<u8", "train": "?", "doc": "<i4", "place": "<i4", "count": "<i8", "alive": "?",
             "prob": "<f4"}
    STEPS = ("doc", "place")     # written as differences

    @staticmethod
    def of(walk: Walk, doc: np.ndarray, p: PstParams) -> "Rest":
        """Tokens whose next longer context is frequent and can grow, and the words before them that still longer
        contexts reach: every (HEAD + 1)-gram in a frequent context is frequent, which ends most of them soon."""
        b = walk.b
        frequent = walk.gram_count >= p.least
        alive = walk.alive & np.append(False, frequent)[:len(frequent)]
        wanted, reaching = alive.copy(), alive
        for back in range(1, min(p.depth, len(alive) - 1) + 1):
            if back > HEAD + 1:
                reaching = reaching & np.append(np.zeros(back - HEAD, bool), frequent[:-(back - HEAD)])
            wanted[:-back] |= reaching[back:]
        at = np.flatnonzero(wanted)
        vocab, codes = np.unique(b.codes[at], return_inverse=True)
        exact = alive | np.append(alive[1:], False)[:len(alive)]
        count = np.where(exact, walk.gram_count, np.minimum(walk.gram_count, p.least))[at]
        return Rest(codes, walk.word_count[vocab], walk.word_number[vocab], b.train[at], doc[at], b.place[at], count, alive[at], walk.prob[at][alive[at]])

    def blobs(self) -> list[bytes]:
        steps = {c: np.diff(getattr(self, c), prepend=0) for c in self.STEPS}
        return [_zip(steps.get(c, getattr(self, c)).astype(t)) for c, t in self.TYPES.items()]

    @staticmethod
    def read(t: pa.Table) -> "Rest":
        rest = Rest(*(_unzip(t.column(c)[0].as_buffer(), d) for c, d in Rest.TYPES.items()))
        rest.doc, rest.place = (np.cumsum(getattr(rest, c), dtype=np.int64) for c in Rest.STEPS)
        return rest


class RestWalk:
    """State of a block's remaining tokens after the replies to levels HEAD + 1, HEAD + 2, ...

    A count is -1 where it is not known and 0 where the n-gram is known to be too rare for a context.
    A pair is asked for if its context is alive, for the test, or if the context of the next token is
    alive, whose extension needs the count; contexts of the latter kind ask without a test (``n_context`` 0).
    """

    def __init__(self, rest: Rest, replies: list[dict[int, tuple]], total: tuple[int, int], hot: list, buckets: int, p: PstParams):
        self.b, self.word_count, self.word_number = rest, rest.word_count, rest.word_number
        hot_above = hot_count(total, p)
        words = _word_name(rest.word_count, rest.word_number)[rest.codes.astype(np.int64)]
        linked = np.append(False, (rest.doc[1:] == rest.doc[:-1]) & (rest.place[1:] == rest.place[:-1] + 1))[:len(words)]
        prob = np.ones(len(words))
        prob[rest.alive] = rest.prob
        self.prob, self.before = prob, prob.copy()
        names, count, alive = words, rest.count.astype(np.int64), rest.alive
        for _ in range(HEAD):
            names = self._longer(names, words)
        for depth in range(HEAD + 1, p.depth + 1):
            parent, parent_count = np.roll(names, 1), np.where(linked, np.roll(count, 1), -1)
            test = alive & (rest.place >= depth) & (parent_count >= p.least)
            rare = (rest.place < depth) | ((parent_count >= 0) & (parent_count < p.least)) | ((count >= 0) & (count < p.least))
            following = np.append((alive & linked)[1:], False)[:len(words)]
            names = self._longer(names, words)
            self.level = lv = self._level(np.flatnonzero(test | (following & ~rare & (count >= p.least))), names, parent,
                                          np.where(test, parent_count, 0), buckets, hot_above)
            if len(replies) <= depth - HEAD - 1:
                return
            found, kept, growing = lv.answer(replies[depth - HEAD - 1], hot[depth])
            tested = lv.n_context[lv.pair] > 0
            use = kept[lv.pair] & tested
            at, pair = lv.at[use], lv.pair[use]
            prob[at] = (found[pair] + p.mass * prob[at]) / (lv.n_context[pair] + p.mass)
            alive = np.zeros(len(words), bool)
            alive[lv.at] = growing[lv.pair] & tested
            count = np.where(rare, 0, -1)
            count[lv.at] = found[lv.pair]

    @staticmethod
    def _longer(names: np.ndarray, words: np.ndarray) -> np.ndarray:
        return _pair_name(np.roll(names, 1), words)

    def _level(self, at, names, parent, n_context, buckets: int, hot_above: float) -> Level:
        _, first, pair = np.unique(names[at], return_index=True, return_inverse=True)
        first = at[first]
        _, context = np.unique(parent[first], return_inverse=True)
        together = np.argsort(context, kind="stable")       # pairs of a context stand together
        place = np.empty(len(together), np.int64)
        place[together] = np.arange(len(together))
        first, context, pair = first[together], context[together], place[pair]
        n = n_context[first]
        hot = n > hot_above
        order, cuts = _sorted_by_bucket(_bucket(np.where(hot, names[first], mix64(parent[first])), buckets), buckets)
        return Level(at, pair, context, self.b.codes[first].astype(np.int64), n, names[first], parent[first], order, cuts, hot)


def _joined(replies: dict[int, tuple], column: int, dtype: str) -> np.ndarray:
    return np.concatenate([_unzip(replies[k][column], dtype) for k in sorted(replies)] or [np.zeros(0, dtype)])


_REQUEST = ("block bigint, bucket int, word_count binary, word_number binary, counts binary, q binary, "
            "run binary, parents binary, hot binary, n_context binary")
_TRIPLES = ("block bigint, bucket int, word_count binary, word_number binary, counts binary, known binary, run binary, before_count binary, "
            "before_number binary, n_hot binary, contexts binary, last_count binary, last_number binary")
_REPLY = "block bigint, level int, bucket int, counts binary, marks binary, pairs binary, among binary, n bigint, v bigint, context bigint, gain double"


def vocab_requests(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, names, counts): words of a block and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                t = pa.Table.from_batches([batch.slice(i, 1)])
                b, vocab = Block.read(t), _unzip(t.column("vocab")[0].as_buffer(), "<u8")
                counts = np.bincount(b.codes[b.train], minlength=len(vocab))[b.rank]
                # buckets are ranges of hashes, so the order of hashes is that of buckets
                bucket = ((vocab >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                full = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
                parts = [slice(cuts[k], cuts[k + 1]) for k in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t.column("block")[0].as_py()] * len(full), pa.int64()), pa.array(full, pa.int32()),
                     pa.array([_zip(vocab[x]) for x in parts], pa.binary()),
                     pa.array([_zip(counts[x].astype("<i8")) for x in parts], pa.binary())],
                    names=["block", "bucket", "names", "counts"])

    return blocks.mapInArrow(run, "block bigint, bucket int, names binary, counts binary")


def _answers(blocks, level, bucket, counts, marks, extra=(), pairs=None, among=None):
    """Reply rows: one for each block, then ``extra`` rows (n, v, context, gain) for the driver."""
    m, e = len(blocks), len(extra)
    cols = [[*blocks, *[None] * e], [level] * (m + e), [bucket] * (m + e), *([*(x or [None] * m), *[None] * e] for x in (counts, marks, pairs, among)),
            *[[*[None] * m, *[x[i] for x in extra]] for i in range(4)]]
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    names = ["block", "level", "bucket", "counts", "marks", "pairs", "among", "n", "v", "context", "gain"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _buffers(t: pa.Table, column: str, dtype: str) -> list[np.ndarray]:
    return [_unzip(x.as_buffer(), dtype) for x in t.column(column)]


def count_words(requests: DataFrame, buckets: int) -> DataFrame:
    """Totals of every word to every block that asked, the number of words and tokens, and the largest total (as ``context``). With its total goes
    a word's number among the words of that total: both are small where words are common, the pair is unique over
    all buckets, and the total gives the base probability, so later requests carry it in place of a hash."""
    def run(t: pa.Table) -> pa.Table:
        names, counts = _buffers(t, "names", "<u8"), _buffers(t, "counts", "<i8")
        sizes = [len(x) for x in names]
        distinct, which = np.unique(np.concatenate(names), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, which, np.concatenate(counts))
        bucket = t.column("bucket")[0].as_py()
        by_total = np.argsort(total, kind="stable")
        _, first, same = np.unique(total[by_total], return_index=True, return_counts=True)
        number = np.empty(len(distinct), np.uint64)
        number[by_total] = (np.arange(len(distinct)) - np.repeat(first, same)) * buckets + bucket
        cuts = np.cumsum(sizes)[:-1]
        return _answers(t.column("block").to_pylist(), 0, bucket, [_zip(x) for x in np.split(total[which], cuts)],
                        [_zip(x) for x in np.split(number[which], cuts)], [(int(total.sum()), int((total > 0).sum()), int(total.max()), None)])

    return requests.groupBy("bucket").applyInArrow(run, _REPLY)


def _asked(name: int, walk: Walk | RestWalk, level: int, buckets: int) -> pa.Table:
    """Requests of a block's level: pairs by bucket, with training counts and the suffix's probability. At
    level 1 that is the word's own, which follows from its count, and a context is a word and goes by its number."""
    b, lv = walk.b, walk.level
    counts = np.bincount(lv.pair[b.train[lv.at]], minlength=len(lv.name))
    q = np.zeros(len(lv.name))
    if level > 1:
        q[lv.pair] = walk.prob[lv.at]
    parent = walk.word_number[lv.context] if level == 1 else lv.parent
    full = [k for k in range(buckets) if lv.cuts[k + 1] > lv.cuts[k]]
    rows: list[list] = [[name] * len(full), full, *([] for _ in range(8))]
    for x in (lv.order[lv.cuts[k]:lv.cuts[k + 1]] for k in full):
        # pairs of a context stand together: its values once, with its number of pairs
        first = np.flatnonzero(np.append(True, lv.context[x[1:]] != lv.context[x[:-1]]))
        run = np.diff(np.append(first, len(x)))
        for k, a in enumerate((walk.word_count[lv.next[x]], walk.word_number[lv.next[x]], counts[x].astype("<i4"),
                               q[x].astype("<f4"), run.astype("<i4"),
                               parent[x[first]], lv.hot[x[first]], lv.n_context[x[first]].astype("<i8")), 2):
            rows[k].append(_zip(a))
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 8]
    return pa.Table.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names=[
        "block", "bucket", "word_count", "word_number", "counts", "q", "run", "parents", "hot", "n_context"])


def _asked_triples(name: int, walk: Walk, buckets: int) -> pa.Table:
    """Requests of a block's triples by bucket: next symbols, with the words of their contexts once for each run."""
    b, t = walk.b, walk.triples
    counts = np.bincount(t.triple[b.train[t.at]], minlength=len(t.next))
    before_count, before_number = np.append(walk.word_count, NO_WORD[0]), np.append(walk.word_number, np.uint64(NO_WORD[1]))
    full = [k for k in range(buckets) if t.cuts[k + 1] > t.cuts[k]]
    rows: list[list] = [[name] * len(full), full, *([] for _ in range(11))]
    starts = lambda x: np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    for x in (t.order[t.cuts[k]:t.cuts[k + 1]] for k in full):
        first = starts(t.context[x])
        context = t.context[x[first]]
        of_last = starts(t.last[context])
        last = t.last[context[of_last]]
        for k, a in enumerate((walk.word_count[t.next[x]], walk.word_number[t.next[x]], counts[x].astype("<i4"), t.known[x],
                               np.diff(np.append(first, len(x))).astype("<i4"), before_count[t.before[context]],
                               before_number[t.before[context]], t.n_hot[context], np.diff(np.append(of_last, len(context))).astype("<i4"),
                               walk.word_count[last], walk.word_number[last]), 2):
            rows[k].append(_zip(a))
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 11]
    return pa.Table.from_arrays([pa.array(r, k) for r, k in zip(rows, types)], names=[
        "block", "bucket", "word_count", "word_number", "counts", "known", "run", "before_count", "before_number", "n_hot", "contexts",
        "last_count", "last_number"])


def head_requests(blocks: DataFrame, replies: DataFrame, level: int, total, hot, buckets: int, p: PstParams) -> DataFrame:
    """Requests of the first exchanges: pairs of hot words (level 1), triples (level 2)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        walk = Walk(Block.read(left), _replies(right, 0, level), total, hot, buckets, p)
        name = left.column("block")[0].as_py()
        return _asked(name, walk, 1, buckets) if level == 1 else _asked_triples(name, walk, buckets)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, _REQUEST if level == 1 else _TRIPLES)


def first_rest_requests(rests: DataFrame, total, hot, buckets: int, p: PstParams) -> DataFrame:
    """Requests of level HEAD + 1, for which a block needs no reply."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                t = pa.Table.from_batches([batch.slice(i, 1)])
                walk = RestWalk(Rest.read(t), [], total, hot, buckets, p)
                yield from _asked(t.column("block")[0].as_py(), walk, HEAD + 1, buckets).to_batches()

    return rests.mapInArrow(run, _REQUEST)


def rest_requests(rests: DataFrame, replies: DataFrame, level: int, total, hot, buckets: int, p: PstParams) -> DataFrame:
    """Requests of a level above HEAD + 1."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        walk = RestWalk(Rest.read(left), _replies(right, HEAD + 1, level - HEAD - 1), total, hot, buckets, p)
        return _asked(left.column("block")[0].as_py(), walk, level, buckets)

    return rests.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, _REQUEST)


def _replies(t: pa.Table, first: int, levels: int) -> list[dict[int, tuple]]:
    """Replies to the levels ``first`` .. ``first + levels - 1``, by bucket."""
    out: list[dict[int, tuple]] = [{} for _ in range(levels)]
    for level, bucket, *parts in zip(*(t.column(c) for c in ("level", "bucket", "counts", "marks", "pairs", "among"))):
        out[level.as_py() - first][bucket.as_py()] = tuple(x.as_buffer() for x in parts)
    return out


def _gains(count: np.ndarray, among: np.ndarray, q: np.ndarray, seen: np.ndarray, p: PstParams) -> np.ndarray:
    """Terms of the divergence, 0 where not ``seen``."""
    term, c, q = np.zeros(len(count)), count[seen], q[seen]
    term[seen] = c * np.log((c - 1 + p.mass * q) / ((among[seen] - 1 + p.mass) * q))
    return term


def _can_grow(at: np.ndarray, n: np.ndarray, count: np.ndarray, q: np.ndarray, seen: np.ndarray, p: PstParams) -> np.ndarray:
    """Of each context: whether an extension may still reach the divergence. ``at``: context of each pair, ``n``: counts
    of the contexts, ``count`` and ``q``: of the pairs."""
    alive = np.zeros(len(n), bool)
    lo = max(p.least, 1)
    while True:
        hi = 2 * lo - 1
        use = np.flatnonzero(seen & (n >= lo)[at] & ~alive[at])
        if not len(use):
            return alive
        each = np.minimum(count[use], hi)
        gain = np.log((each - 1 + p.mass * q[use]) / ((lo - 1 + p.mass) * q[use]))
        # what can be gained at all decides for most contexts
        most = np.bincount(at[use], each * np.maximum(gain, 0), len(n))
        few = (most >= p.divergence)[at[use]]
        use, each, gain = use[few], each[few], gain[few]
        order = np.lexsort((-gain, at[use]))
        of, each, gain = at[use][order], each[order], gain[order]
        before = np.cumsum(each) - each
        before -= before[np.searchsorted(of, of)]
        taken = np.clip(np.bincount(of, each * (gain > 0), len(n)), lo, np.minimum(n, hi))
        alive |= np.bincount(of, gain * np.clip(taken[of] - before, 0, each), len(n)) >= p.divergence - 1e-6
        lo = hi + 1


def count_triples(requests: DataFrame, total_words: tuple[int, int], passed_words: np.ndarray, p: PstParams) -> DataFrame:
    """Totals of every triple and its (last, next) pair and the outcome of the tests of contexts of one and two words,
    to every block that asked; partial test sums of hot contexts. ``passed_words``: retained hot words."""
    hot_above = hot_count(total_words, p)

    def run(t: pa.Table) -> pa.Table:
        joined = lambda c, d: np.concatenate(_buffers(t, c, d))
        word_counts = _buffers(t, "word_count", "<i8")
        cuts = np.cumsum([len(x) for x in word_counts])[:-1]
        word_count = np.concatenate(word_counts)
        following = _word_name(word_count, joined("word_number", "<u8"))
        contexts, last_count = joined("contexts", "<i4"), joined("last_count", "<i8")
        last = np.repeat(_word_name(last_count, joined("last_number", "<u8")), contexts)
        last_count = np.repeat(last_count, contexts)
        before = joined("before_count", "<i8")
        paired = before != NO_WORD[0]
        name = _pair_name(_word_name(before, joined("before_number", "<u8")), last)
        run = joined("run", "<i4")
        of_run = np.repeat(np.arange(len(run), dtype=np.int32), run)
        _, first, which = np.unique(_pair_name(name[of_run], following), return_index=True, return_inverse=True)
        total = np.bincount(which, joined("counts", "<i4")).astype(np.int64)
        known, n_hot = joined("known", "<i8")[first], joined("n_hot", "<i8")
        of_run, following, word_count = of_run[first], following[first], word_count[first]

        # one word
        is_hot = (last_count > hot_above)[of_run]
        _, first, pair = np.unique(_pair_name(last[of_run], following), return_index=True, return_inverse=True)
        in_pair = np.bincount(pair, total).astype(np.int64)
        words, word = np.unique(last[of_run][first], return_inverse=True)
        gain = np.bincount(word, _gains(in_pair, last_count[of_run][first], _base(word_count[first], total_words), in_pair > 0, p), len(words))
        kept_word = np.where(is_hot, np.isin(words, passed_words)[word][pair], (gain >= p.divergence)[word][pair])
        in_pair = np.where(is_hot, known, in_pair[pair])
        q = _base(word_count, total_words)
        q = np.where(kept_word, (in_pair + p.mass * q) / (last_count[of_run] + p.mass), q)

        # two words
        names, at = np.unique(name, return_inverse=True)
        n = np.zeros(len(names), np.int64)
        n[at] = n_hot
        hot = n > 0
        has_word = np.zeros(len(names), bool)
        has_word[at] = paired
        at = at[of_run]
        n = np.where(hot, n, np.bincount(at, total, len(names)).astype(np.int64))
        tested = has_word & (n >= p.least)
        seen = (total > 0) & tested[at]
        gain = np.bincount(at, _gains(total, n[at], q, seen, p), len(names))
        kept = (tested & (gain >= p.divergence))[at]
        in_force = np.where(kept, (total + p.mass * q) / (n[at] + p.mass), q)
        flags = (KEPT * kept + ALIVE * _can_grow(at, n, total, in_force, seen, p)[at] + KEPT_WORD * kept_word).astype(np.uint8)
        # what a block does not use is sent as 0
        told = (np.where(tested[at], total, 0), flags, np.where(kept_word & ~is_hot, in_pair, 0), np.where(kept & ~hot[at], n[at], 0))
        counts, marks, pairs, among = ([_zip(x) for x in np.split(a[which], cuts)] for a in told)
        return _answers(t.column("block").to_pylist(), HEAD, t.column("bucket")[0].as_py(), counts, marks,
                        [(None, None, int(c), float(g)) for c, g in zip(names[hot].view(np.int64), gain[hot])], pairs, among)

    return requests.groupBy("bucket").applyInArrow(run, _REPLY)


def count_pairs(requests: DataFrame, level: int, total_words: tuple[int, int], p: PstParams) -> DataFrame:
    """Totals of every pair and the outcome of its context's test, to every block that asked; partial
    test sums of hot contexts."""
    def run(t: pa.Table) -> pa.Table:
        following, sizes, q = [], [], []
        for row in zip(*(t.column(k) for k in ("word_count", "word_number", "q"))):
            c, number, given = (x.as_buffer() for x in row)
            c = _unzip(c, "<i8")
            following.append(_word_name(c, _unzip(number, "<u8")))
            sizes.append(len(c))
            q.append(_base(c, total_words) if level == 1 else _unzip(given, "<f4"))
        run = np.concatenate(_buffers(t, "run", "<i4"))
        of_run = np.repeat(np.arange(len(run)), run)
        parents = np.concatenate(_buffers(t, "parents", "<u8"))
        if level == 1:
            parents = _word_name(np.concatenate(_buffers(t, "n_context", "<i8")), parents)
        distinct, first, which = np.unique(_pair_name(parents[of_run], np.concatenate(following)), return_index=True, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, which, np.concatenate(_buffers(t, "counts", "<i4")))
        of_run = of_run[first]
        parent = parents[of_run]
        hot, n = (np.concatenate(_buffers(t, c, d))[of_run] for c, d in (("hot", "?"), ("n_context", "<i8")))
        q = np.concatenate(q)[first].astype(np.float64)
        seen = (total > 0) & (n > 0)

        term = _gains(total, n, q, seen, p)
        contexts, at = np.unique(parent, return_inverse=True)
        gain = np.bincount(at, term, len(contexts))
        is_hot = np.zeros(len(contexts), bool)
        is_hot[at] = hot
        kept = (gain >= p.divergence)[at] & (n > 0)
        in_force = np.where(kept, (total + p.mass * q) / (n + p.mass), q)
        of_context = np.zeros(len(contexts), np.int64)
        of_context[at] = n
        flags = (KEPT * kept + ALIVE * _can_grow(at, of_context, total, in_force, seen, p)[at]).astype(np.uint8)
        cuts = np.cumsum(sizes)[:-1]
        extra = [(None, None, int(c), float(g)) for c, g in zip(contexts[is_hot].view(np.int64), gain[is_hot])]
        return _answers(t.column("block").to_pylist(), level, t.column("bucket")[0].as_py(),
                        [_zip(x) for x in np.split(total[which], cuts)], [_zip(x) for x in np.split(flags[which], cuts)], extra)

    return requests.groupBy("bucket").applyInArrow(run, _REPLY)


_SCORES = ["ids", "lengths", "n_known", "base_score", "score"]
_REST = ("block bigint, ids array<bigint>, lengths array<bigint>, n_known array<bigint>, base_score array<double>, "
         "score array<double>, kept bigint, " + ", ".join(f"{c} binary" for c in Rest.TYPES))


def head_scores(blocks: DataFrame, replies: DataFrame, total, hot, buckets: int, p: PstParams) -> DataFrame:
    """A row per block: scores in log10 after the first levels, and the tokens that longer contexts need."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        walk = Walk(Block.read(left), _replies(right, 0, HEAD + 1), total, hot, buckets, p)
        b = walk.b
        doc = np.repeat(np.arange(len(b.lengths)), b.lengths)
        per_doc = lambda x: np.bincount(doc, x, len(b.lengths))
        rest = Rest.of(walk, doc, p)
        values = [b.ids, b.lengths, per_doc(walk.word_count[b.codes] > 0).astype(np.int64),
                  per_doc(np.log10(walk.base)), per_doc(np.log10(walk.prob))]
        lists = [pa.array([v], pa.list_(pa.float64() if i > 2 else pa.int64())) for i, v in enumerate(values)]
        return pa.Table.from_arrays(
            [left.column("block"), *lists, pa.array([len(rest.codes)], pa.int64()),
             *[pa.array([x], pa.binary()) for x in rest.blobs()]], names=["block", *_SCORES, "kept", *Rest.TYPES])

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, _REST)


def rest_scores(rests: DataFrame, replies: DataFrame, levels: int, total, hot, buckets: int, p: PstParams) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score): the scores of the first levels, moved by the ``levels`` after them."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        walk = RestWalk(Rest.read(left), _replies(right, HEAD + 1, levels), total, hot, buckets, p)
        cols = [left.column(c)[0].values for c in _SCORES]
        moved = np.bincount(walk.b.doc, np.log10(walk.prob) - np.log10(walk.before), len(cols[0]))
        cols[4] = pa.array(np.array(cols[4]) + moved)
        return pa.Table.from_arrays(cols, names=["id", "n_tokens", "n_known", "base_score", "score"])

    return rests.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        run, "id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def score(docs: DataFrame, train: Column, p: PstParams = PstParams(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; rows for which ``train``
    holds are learnt from."""
    blocks = scratch(token_blocks(docs, train, p, id_col, text_col), "blocks")
    tokens = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8, -(-tokens // p.bucket_tokens))
    replies = scratch(count_words(vocab_requests(blocks, buckets), buckets), "counts")
    row = replies.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.max("context").alias("most")).first()
    total = (row.n or 0, row.v or 0)
    free_shuffles(blocks.sparkSession)
    hot: list = [np.zeros(0, np.uint64)]

    tokens_only = blocks.drop("vocab")

    def counted(replied: DataFrame) -> DataFrame:
        more = scratch(replied, "counts")
        passed = (more.where("context IS NOT NULL").groupBy("context").agg(F.sum("gain").alias("gain"))
                  .where(F.col("gain") >= p.divergence).select("context").collect())
        hot.append(np.array([r.context for r in passed], np.int64).view(np.uint64))
        free_shuffles(blocks.sparkSession)
        return more.where("block IS NOT NULL")

    replies = replies.where("block IS NOT NULL")
    if (row.most or 0) > hot_count(total, p):
        replies = replies.unionByName(counted(count_pairs(head_requests(tokens_only, replies, 1, total, hot, buckets, p), 1, total, p)))
    else:
        hot.append(np.zeros(0, np.uint64))
    asked = head_requests(tokens_only, replies, HEAD, total, hot, buckets, p)
    replies = replies.unionByName(counted(count_triples(asked, total, hot[1], p)))
    rests = scratch(head_scores(tokens_only, replies, total, hot, buckets, p), "rests")
    free_shuffles(blocks.sparkSession)
    buckets = max(8, -(-(rests.agg(F.sum("kept")).first()[0] or 0) // p.bucket_tokens))
    # dealt by block once for all levels; what an executor loses is dealt again from the written table
    rests = rests.repartition(shuffle_partitions(blocks.sparkSession), "block").persist(StorageLevel.DISK_ONLY)
    replies, level = replies.limit(0), HEAD
    while level < p.depth:
        asked = (first_rest_requests(rests, total, hot, buckets, p) if level == HEAD
                 else rest_requests(rests, replies, level + 1, total, hot, buckets, p))
        more = counted(count_pairs(asked, level + 1, total, p))
        if more.isEmpty():       # no context can grow
            break
        replies, level = replies.unionByName(more), level + 1
    out = scratch(rest_scores(rests, replies, level - HEAD, total, hot, buckets, p), "scores")
    rests.unpersist()
    return out.withColumn("train_tokens", F.lit(total[0]).cast("long")).withColumnRenamed("id", id_col)
