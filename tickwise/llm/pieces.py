"""SentencePiece encoding and decoding of merge-type (BPE) models by backtracking.

The library's merges take the best-scored adjacent pair first, the leftmost of equals. A
sequence of pieces is a text's encoding exactly if each adjacent pair of them is
*compatible*: merging the pair's own characters again gives back these two pieces. (The first
merge across a border would also be the best one inside that pair alone.) So a prefix
of the text has one compatible sequence at most, and the encoding is found from left to
right: take the longest piece that starts here and is compatible with the one
before it, else the next shorter one; if none is left, note the position in a bitfield
as failed, take the last piece back and shorten it. No position fails twice, which bounds
the work by text length times pieces per position.

An Aho-Corasick automaton finds the longest piece at every position; whether two pieces
are compatible is remembered. Characters that no piece holds become byte pieces and end a
merge on both sides. Where no piece has a space after another character, a text falls into
independent chunks (spaces and what follows them), and equal chunks are encoded once; the
table of known chunks is bounded by bytes and only saves time.

Decoding gathers the pieces' bytes with numpy. Ids that need care (control or unknown ids, byte
pieces that form no character) take a step-by-step path for that row.

The model file is read on the driver and broadcast (a vocabulary, fixed size); tasks need no
local file, and a lost task repeats its own rows only. The sentencepiece package is
used to read the vocabulary and never to encode or decode.

Defined cases: null and empty texts have no ids and decode to the empty text; null id lists decode
as empty ones; repeated rows and ids are encoded row by row; long texts are encoded whole, in
bounded blocks; an empty table gives an empty result; a kept column with the name of a new
one (in any case) gives way to it.
"""

from __future__ import annotations

import codecs
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from tickwise.llm.common import quoted, ragged, with_text_columns

SPACE = "▁"                # stands for a space inside pieces (fixed value of the format)
BLOCK = 1 << 20                 # characters of a text that are cut into chunks at a time
WINDOW = 1 << 16                # characters searched for pieces at a time
KNOWN_BYTES = 128 << 20         # text and ids kept in the table of known chunks
SHORT = 64                      # longest chunk that is kept there
PAIRS = 1 << 19                 # remembered compatibility checks
NO_MERGE = float("-inf")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(spark, path: str) -> bytes:
    """The model file, by Spark's reader when it lies in a store."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


def _fields(message: bytes):
    """(number, value) of a protocol buffer message: integers, or bytes of longer fields."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, message[at:at + size]
            at += size


def _check_model(model: bytes) -> None:
    """Raises if the model's type or text rules are others than this module implements."""
    top = dict(_fields(model))          # of repeated fields (the pieces) the last one
    trainer, norm = dict(_fields(top.get(2, b""))), dict(_fields(top.get(3, b"")))
    # fixed field numbers of the format: trainer 3 model type (2: BPE), 24 suffix spaces, 35 byte fallback;
    # normaliser 2 character map, 3 leading space, 4 trimmed spaces, 5 escaped spaces
    plain = (trainer.get(3) == 2 and trainer.get(35) == 1 and not trainer.get(24, 0)
             and not norm.get(2) and norm.get(3, 1) == 1 and norm.get(4, 1) == 0 and norm.get(5, 1) == 1)
    if not plain:
        raise ValueError("only BPE models with byte fallback, identity normaliser and a leading space are supported")


def _each(error):
    """One replacement character for every byte that belongs to no character."""
    return "�" * (error.end - error.start), error.end


codecs.register_error("tickwise-each", _each)


class PieceModel:
    """Vocabulary of a model with its encoder and decoder."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        _check_model(model)
        sp = SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
        names = [sp.id_to_piece(i) for i in range(size)]
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        self.byte_id = {int(names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        merged = {names[i]: i for i in range(size) if not special[i]}
        self.score = {names[i]: sp.get_score(i) for i in merged.values()}
        self.alphabet = frozenset("".join(merged))
        # every character of the alphabet is a piece; one without an id stands for its bytes
        self.pieces = [*merged, *(c for c in sorted(self.alphabet) if c not in merged)]
        self.ids = [np.array([merged[p]] if p in merged else self._bytes(p), "<u4").tobytes() for p in self.pieces]
        self.index = {p: k for k, p in enumerate(self.pieces)}
        self.length = [len(p) for p in self.pieces]
        self.widest = max(self.length, default=1)
        self.shorter = [next((self.index[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.index), -1)
                        for p in self.pieces]
        self.search = ahocorasick.Automaton()
        for p, k in self.index.items():
            self.search.add_word(p, k)
        self.search.make_automaton()
        self.fits: dict[int, bool] = {}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.cuts = None if inner else re.compile(self._cutting())
        self.border = re.compile(rf"(?<=[^ {SPACE}])[ {SPACE}]")
        self.known: dict[str, bytes] = {}
        self.held = 0
        # decoding: bytes of each id; -1 ids take the careful path
        raw = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else
               b"" if special[i] else names[i].replace(SPACE, " ").encode() for i in range(size)]
        self.names, self.size = names, size
        self.is_byte = np.array([sp.is_byte(i) for i in range(size)])
        self.is_control = [sp.is_control(i) for i in range(size)]
        self.is_unknown = [sp.is_unknown(i) for i in range(size)]
        self.unknown = sp.decode([sp.unk_id()])
        self.careful = np.array([special[i] and not sp.is_byte(i) for i in range(size)])
        self.spaced = np.array([not special[i] and names[i].startswith(SPACE) for i in range(size)])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    def _cutting(self) -> str:
        """Pattern of the chunks: borders are where no piece goes on. That is before spaces, around ASCII
        characters that no piece holds, and between a letter and an ASCII sign that follows none in any piece."""
        letters = [chr(c) for c in range(256) if chr(c).isalpha()]
        inside = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        signs = [chr(c) for c in range(33, 127) if not chr(c).isalpha() and not any(x + chr(c) in inside for x in letters)]
        alone = [chr(c) for c in range(128) if chr(c) not in self.alphabet and c != 32]
        word, sign, lone = ("".join(re.escape(c) for c in x) for x in (letters, signs, alone))
        space = f"[ {SPACE}]"
        before = f"{space}*[{word}]+(?=[{sign}])|" if signs else ""
        return before + (f"[{lone}]+|" if alone else "") + f"{space}*[^ {SPACE}{lone}]+|{space}+"

    def _bytes(self, text: str) -> list[int]:
        return [self.byte_id[b] for b in text.encode()]

    def _merge(self, text: str) -> list[str]:
        """Merging from characters: the best-scored pair first, the leftmost of equals."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            scores = [score(a + b, NO_MERGE) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == NO_MERGE:
                break
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _compatible(self, before: int, piece: int) -> bool:
        """Whether merging both pieces' characters gives these two pieces (-1: nothing before); remembered."""
        want = [self.pieces[k] for k in (before, piece) if k >= 0]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        got = self.fits[before * len(self.pieces) + piece] = self._merge("".join(want)) == want
        return got

    def _longest(self, text: str):
        """Longest piece at each position, found window by window."""
        found, length = array("i", bytes(4 * len(text))), self.length
        for at in range(0, len(text), WINDOW):
            stop = at + WINDOW
            # matches come by their ends, so the last one kept for a start is the longest
            for end, k in self.search.iter(text, at, min(len(text), stop + self.widest)):
                start = end + 1 - length[k]
                if start < stop:
                    found[start] = k
        return found

    def _run(self, text: str) -> list[bytes]:
        """Ids of a text over the alphabet: backtracking over compatible pieces."""
        longest, length, shorter, n = self._longest(text), self.length, self.shorter, len(text)
        fits, size, ids = self.fits.get, len(self.pieces), self.ids
        failed = bytearray(n // 8 + 1)
        taken = array("i")
        at, last, piece = 0, -1, longest[0]
        while at < n:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fit = fits(last * size + piece)
                    if fit or fit is None and self._compatible(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at, last = end, piece
                piece = longest[at] if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= length[piece]
                last = taken[-1] if taken else -1
        return [ids[k] for k in taken]

    def _chunk(self, text: str) -> bytes:
        """Ids of a chunk (spaces escaped) as little-endian 32-bit numbers."""
        if self.alphabet.issuperset(text):
            return b"".join(self._run(text))
        out, start = [], 0
        for k, c in enumerate(text):
            if c not in self.alphabet:
                if start < k:
                    out += self._run(text[start:k])
                out.append(np.array(self._bytes(c), "<u4").tobytes())
                start = k + 1
        if start < len(text):
            out += self._run(text[start:])
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if not text:
            return b""
        text = " " + text
        if self.cuts is None:
            return self._chunk(text.replace(" ", SPACE))
        known, out, at = self.known, [], 0
        while at < len(text):
            border = self.border.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            stop = border.start() if border else len(text)
            for chunk in self.cuts.findall(text, at, stop):
                ids = known.get(chunk)
                if ids is None:
                    ids = self._chunk(chunk.replace(" ", SPACE))
                    if len(chunk) <= SHORT:
                        if self.held > KNOWN_BYTES:
                            known.clear()
                            self.held = 0
                        known[chunk] = ids
                        self.held += 200 + 4 * len(chunk) + len(ids)    # with the objects around them
                out.append(ids)
            at = stop
        return b"".join(out)

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """List of ids of each text."""
        coded = [self.encode(t) if t else b"" for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32)))

    def _decode_carefully(self, ids: list[int]) -> str:
        """One id after the other, as control and unknown ids and broken byte pieces need it."""
        out, held, leading, stripped = [], [], True, False
        for i in [*ids, None]:
            if i is not None and not 0 <= i < self.size:
                raise ValueError(f"id {i} is not in the model")
            if i is not None and self.is_byte[i]:
                held.append(int(self.names[i][3:5], 16))
                continue
            if held:
                out.append(bytes(held).decode("utf-8", "tickwise-each"))
                held = []
            if i is None:
                break
            if stripped or any(out):
                leading = False
            stripped = False
            if self.is_control[i]:
                continue
            if self.is_unknown[i]:
                out.append(self.unknown)
                continue
            piece = self.names[i]
            if leading and piece.startswith(SPACE):
                piece, stripped = piece[1:], True
            out.append(piece.replace(SPACE, " "))
        return "".join(out)

    def decode_all(self, lists: pa.Array) -> pa.Array:
        """Text of each list of ids."""
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        ends = np.cumsum(size)
        starts = ends - size
        if len(ids) == 0 or (ids.min() >= 0 and ids.max() < self.size and not self.careful[ids].any()):
            width = self.raw_size[ids]
            joined = self.raw[ragged(self.raw_start[ids], width)]
            upto = np.concatenate([[0], np.cumsum(width)])
            first = upto[starts]
            some = np.flatnonzero(size > 0)
            simple = ~self.is_byte[ids[starts[some]]]       # a leading byte piece takes the careful path
            if simple.all():
                first[some] += self.spaced[ids[starts[some]]]
                offsets = np.stack([first, upto[ends]], 1)
                whole = joined.tobytes()
                try:
                    return pa.array([whole[a:b].decode() for a, b in offsets.tolist()], pa.string())
                except UnicodeDecodeError:
                    pass
        return pa.array([self._decode_carefully(x or []) for x in lists.to_pylist()], pa.string())


_models: dict[int, PieceModel] = {}


def _model(blob: bytes) -> PieceModel:
    """One per worker process."""
    key = hash(blob)
    if key not in _models:
        _models.clear()
        _models[key] = PieceModel(blob)
    return _models[key]


def encode(docs: DataFrame, model: str | None = None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) with ``ids`` (array of int), without begin and end ids."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_model(spark, model or default_model()))
    return with_text_columns(docs, text_col, "ids array<int>", lambda texts: [_model(shared.value).encode_all(texts)], keep)


def decode(rows: DataFrame, model: str | None = None, ids_col: str = "ids", new_col: str = "decoded") -> DataFrame:
    """All columns with ``new_col``: the text of the ids."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(read_model(spark, model or default_model()))
    kept = [c for c in rows.columns if c.lower() != new_col.lower()]
    at = kept.index(ids_col)
    # positions as names inside the job: any outer name is legal
    inner = rows.select(*[quoted(c).alias(f"k{i}") for i, c in enumerate(kept)])
    names = [*inner.columns, "t"]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, _model(shared.value).decode_all(b.column(at))], names=names)

    schema = StructType([*inner.schema.fields, StructField("t", StringType())])
    return inner.mapInArrow(run, schema).toDF(*kept, new_col)
