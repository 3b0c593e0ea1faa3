"""Packing along a space-filling curve.

1. Token ids of every document (plus an end id), and its hashed vector (token
   counts) projected to ``dims`` Gaussian directions, averaged over the tokens.
2. The projections are quantised and turned into a Hilbert key; documents are
   range-sorted by it. Ties (exact copies share a key) are split by a hash of the
   id, so that a large group of copies does not fill one partition.
3. Each range packs its documents in order: token after token into sequences of
   ``size`` ids, cutting freely. What is left at a range's end is cut into
   sequences whose lengths are powers of two, which need no padding.

The pieces of a range depend on that range alone, so a lost task repeats just its
own work. The tokenizer file is read on the driver and broadcast (a vocabulary,
fixed size); tasks need no local file.

Defined cases: null and empty texts are the end id alone; documents longer than a
sequence span several; repeated and null ids are packed row by row; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import Words, scratch, shuffle_partitions, split_words, with_text_columns


@dataclass(frozen=True)
class PackParams:
    size: int = 4096             # ids of a sequence
    end_id: int = 2              # follows each document
    dims: int = 4                # of the projection
    bits: int = 8                # of each quantised dimension
    spread: float = 0.15         # of a projected mean; sets the quantiser's scale
    seed: int = 5


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_directions: dict[tuple, np.ndarray] = {}


def directions(p: PackParams, size: int) -> np.ndarray:
    """(dims, size) Gaussian directions: each id's share of the projections."""
    key = (p.seed, p.dims, size)
    if key not in _directions:
        _directions[key] = np.random.default_rng(p.seed).normal(0, 1, (p.dims, size)).astype(np.float32)
    return _directions[key]


def read_tokenizer(spark, path: str) -> str:
    """The tokenizer file's text, by Spark's reader when it lies in a store."""
    if "://" in path:
        return spark.read.option("wholetext", "true").text(path).first()[0]
    with open(path, encoding="utf-8") as f:
        return f.read()


def hilbert_key(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points ``x`` (n, dims), ``bits`` bits a dimension (Skilling, 2004)."""
    x = x.astype(np.uint64).T.copy()
    dims = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - np.uint64(1)
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint64)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - np.uint64(1)), t)
        q >>= np.uint64(1)
    x ^= t
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key


# Steps of the tokenizer that let a text be encoded word by word (fixed values of its file).
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A Latin letter, closing marks (no apostrophe) and the word's end.
_CLOSING = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([.,;:!?$*%&#\")\]}]+)([\t-\r ]|$)"
# Texts in which lower-casing A-Z first could change what is composed, or with special tokens.
_DELICATE = r"\p{M}|<\|"


class WordTokenizer:
    """Token ids of whole texts through the distinct words of a slice.

    White space always separates tokens of this tokenizer, and letters and the marks after
    them are different token groups; so marks that close a word are split off, A-Z are
    lower-cased, and each distinct word is encoded once. Words of letters are
    encoded many at a time (their last token is marked as a word end). A bounded
    table keeps words seen before. Texts with combining marks or special tokens, and all
    texts of a tokenizer with other steps, are encoded whole.
    """

    KEEP = 800_000

    def __init__(self, spec: str):
        import json
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_str(spec)
        steps = json.loads(spec)
        vocab = self.tok.get_vocab()
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.by_word = (
            [x.get("type") for x in (steps.get("normalizer") or {}).get("normalizers", [])] == _NORMALIZER
            and _SPLIT in json.dumps(steps.get("pre_tokenizer"), ensure_ascii=False).replace("\\\\", "\\")
            and steps["model"].get("end_of_word_suffix") == "</w>")
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # without the clean-up that such words do not need: ASCII letters; letters
        self.plain = Tokenizer.from_str(json.dumps({**steps, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))
        self.letters = Tokenizer.from_str(json.dumps({
            **steps, "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Lowercase"}]},
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}))
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encodes words that are not in the table."""
        alpha = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        self.known.update(zip(other, self._whole(other)))
        width = self.dtype.itemsize
        for tok, part in ((self.plain, [w for w in alpha if w.isascii()]), (self.letters, [w for w in alpha if not w.isascii()])):
            groups = [part[at:at + 1000] for at in range(0, len(part), 1000)]
            for group, got in zip(groups, tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
                flat = np.array(got.ids, self.dtype)
                stop = ((np.flatnonzero(self.ends[flat]) + 1) * width).tolist()
                if len(stop) != len(group):     # a letter of another Unicode version
                    self.known.update(zip(group, self._whole(group)))
                    continue
                raw = flat.tobytes()
                self.known.update(zip(group, [raw[i:j] for i, j in zip([0, *stop], stop)]))

    def encode(self, texts: pa.Array, end_id: int, each: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(ids with the end id as bytes, number of ids, sum of the columns of ``each`` (dims, ids) over the
        ids) of every text."""
        texts = pc.fill_null(texts, "")
        if self.by_word:
            delicate = pc.match_substring_regex(texts, _DELICATE)
            # one more space than the text has: found by the words, never encoded
            w = split_words(pc.replace_substring_regex(texts, _CLOSING, r"\1 \2\3"), lower=True)
            if len(self.known) > self.KEEP:
                self.known.clear()
            known = self.known
            if new := [x for x in w.vocab if x not in known]:
                self._learn(new)
            coded = [known[x] for x in w.vocab]
            rows = np.flatnonzero(delicate.to_numpy(zero_copy_only=False))
            if len(rows):       # these as one word each
                length = np.diff(w.offsets)
                keep = ~np.isin(w.doc_of, rows)
                length[rows] = 0
                first = np.cumsum(length) - length
                codes = np.insert(w.codes[keep], first[rows], len(coded) + np.arange(len(rows)))
                length[rows] = 1
                coded += self._whole(texts.take(pa.array(rows)).to_pylist())
                w = Words(np.concatenate([[0], np.cumsum(length)]), codes, w.vocab)
        else:
            w = Words(np.arange(len(texts) + 1), np.arange(len(texts)), [])
            coded = self._whole(texts.to_pylist())
        # one more word: the end id, after each document
        coded.append(np.array([end_id], self.dtype).tobytes())
        words = pa.array(coded, pa.binary())
        codes = np.insert(w.codes, w.offsets[1:], len(coded) - 1)
        ends = w.offsets[1:] + np.arange(1, len(w.offsets))
        placed = words.take(pa.array(codes))
        cuts = np.concatenate([[0], ends])
        offsets = np.frombuffer(placed.buffers()[1], np.int32, len(codes) + 1)[cuts]
        docs = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), placed.buffers()[2]])
        # sums by distinct word, then by document
        flat = np.frombuffer(b"".join(coded), self.dtype)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize
        owner = np.repeat(np.arange(len(coded)), size)
        sums = np.stack([np.add.reduceat(np.bincount(owner, row[flat], len(coded))[codes], cuts[:-1]) for row in each], 1)
        return docs, np.diff(offsets).astype(np.int64) // self.dtype.itemsize, sums


_tokenizers: dict[int, WordTokenizer] = {}


def _tokenizer(spec: str) -> WordTokenizer:
    """One per worker process."""
    key = hash(spec)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = WordTokenizer(spec)
    return _tokenizers[key]


def tokenised(docs: DataFrame, spec: str, p: PackParams, id_col: str, text_col: str) -> DataFrame:
    """(id, ids, n_ids, hilbert): ids as little-endian numbers of ``2`` or ``4`` bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def compute(texts: pa.Array) -> list[pa.Array]:
        tok = _tokenizer(shared.value)
        ids, n, sums = tok.encode(texts, p.end_id, directions(p, max(tok.size, p.end_id + 1)))
        grid = ((1 + np.tanh(sums / n[:, None] / (2 * p.spread))) / 2 * (1 << p.bits)).astype(np.int64)
        key = hilbert_key(np.clip(grid, 0, (1 << p.bits) - 1), p.bits).astype(np.int64)
        return [ids, pa.array(n), pa.array(key)]

    return with_text_columns(docs, text_col, "ids binary, n_ids bigint, hilbert bigint", compute, [id_col])


def _pack(size: int, id_type: pa.DataType):
    """Arrow function over the sorted documents of a range: pieces in order."""
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "hilbert"]

    def emit(rows):
        cols = list(zip(*rows))
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches):
        sequence = TaskContext.get().partitionId() << 40
        rows, held = [], 0      # held: bytes of the ids in rows
        open_, used = [], 0     # pieces of the sequence that is being filled
        for b in batches:
            for doc, blob, n, key in zip(*(b.column(k).to_pylist() for k in range(4))):
                ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype("<u4")
                at = 0
                while at < n:
                    take = min(size - used, n - at)
                    open_.append((doc, at, take, ids[at:at + take], n, key))
                    at += take
                    used += take
                    if used == size:
                        offset = 0
                        for d, s, k, part, total, h in open_:
                            rows.append((d, s, k, part.tobytes(), total, sequence, offset, h))
                            offset += k
                        held += 4 * size
                        sequence, open_, used = sequence + 1, [], 0
                        if held >= 4 << 20:
                            yield emit(rows)
                            rows, held = [], 0
        # the rest: sequences of powers of two, largest first
        room = offset = 0
        for d, s, k, part, total, h in open_:
            at = 0
            while at < k:
                if room == 0:
                    room, offset = 1 << (used.bit_length() - 1), 0
                    used -= room
                take = min(room, k - at)
                rows.append((d, s + at, take, part[at:at + take].tobytes(), total, sequence, offset, h))
                at, room, offset = at + take, room - take, offset + take
                if room == 0:
                    sequence += 1
        if rows:
            yield emit(rows)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, p: PackParams = PackParams(),
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (id, start, length, ids, doc_tokens, sequence_id, offset, hilbert); ``ids`` are the
    piece's token ids as little-endian unsigned 32-bit numbers."""
    spark = docs.sparkSession
    if p.size & (p.size - 1):
        raise ValueError("the sequence size must be a power of two")
    spec = read_tokenizer(spark, tokenizer or default_tokenizer())
    tokens = scratch(tokenised(docs, spec, p, id_col, text_col).toDF("id", "ids", "n_ids", "hilbert"), "tokens")
    parts = shuffle_partitions(spark)
    # the long ids first: a tie of keys is split by the hash of the id
    ordered = (tokens.withColumn("tie", F.xxhash64("id"))
               .repartitionByRange(parts, "hilbert", "tie")
               .sortWithinPartitions("hilbert", "tie", "id", "n_ids", F.crc32("ids"))
               .select("id", "ids", "n_ids", "hilbert"))
    id_type = docs.select(id_col).schema[0].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    ddl = (f"id {id_type.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, "
           "sequence_id bigint, offset bigint, hilbert bigint")
    return ordered.mapInArrow(_pack(p.size, to_arrow_type(id_type)), ddl).withColumnRenamed("id", id_col)
