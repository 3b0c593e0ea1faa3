"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers ``<num>``, capitalised words inside a
sentence ``<name>``, units after a number ``<unit>``; all others are lower-cased
without edge punctuation. A capitalised word at the start of a text, sentence or line can be
either, so its windows count with each choice; ``STARTERS`` are never names. Every ``window`` consecutive tokens of a benchmark item
and of a document give a template hash (shorter items: the whole item); template windows
with fewer than ``literals`` ordinary words are too general and not used. Beside them every
window gives the hash of its bare words, numbers and names included, so exact copies are found
in any letter case and without edge punctuation, items of any length included. Windows
are joined on the hash. The matches of a document and an item with the same
shift form one alignment; in it, each slot value of the item must stand for one
value of the document. An item that was re-parameterised (other numbers, names or
units, used consistently) thus matches, and a chance match of templates does not.
A document is contaminated by an item if consistent alignments cover
at least ``coverage`` of the item's tokens, or an exact alignment covers ``run`` tokens.

The documents are read once: two fixed-size bit tables (``TABLE_BITS``, broadcast), of the
benchmark's words and of its windows' hashes, let tasks leave out windows that match
nothing; the rest is joined exactly, so a full table costs time and no result.

Defined cases: null or empty texts match nothing, rows and items without id are left out (give rows
a key to search them all); items with fewer than ``shortest``
tokens or too few ordinary words match as exact copies only, and items with fewer than ``fewest`` words
only where they are the whole text (inside other text one or two words are no evidence); long texts are searched whole; equal
item texts count as one item, named by the smallest id; a document with repeated
ids matches if one of its rows does; empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import HASH_MUL, Words, bare, mix64, quoted, scratch, split_words, text_slices

TABLE_BITS = 23

# Units, as written after a number.
UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ml cl dl l "
    "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months "
    "year years km/h mph m/s hz khz mhz ghz b kb mb gb tb w kw v a j kj cal kcal pa kpa bar °c °f % "
    "dollar dollars cent cents euro euros pound pounds usd eur gbp percent degrees "
    "heures minuten stunden tage jahre jours ans horas días años metros metres meters litres liters grams "
    "kilograms kilometers kilometres".split())
# Words that often begin a sentence or question and are no names.
STARTERS = frozenset(
    "a an the this that these those it he she we you they i his her its our your their there here what which who whom whose "
    "when where why how is are was were do does did can could will would shall should may might must has have had if in on at "
    "by for from to of with and or but not no yes as after before during while because since although so then each every all "
    "some any one let given suppose".split())
_LINE_START = "\x01"
_NUMBER = re.compile(r"[($€£¥+\-]*\d[\d.,:/]*(?:st|nd|rd|th|%|€)?\W*$")
_NUMBER_UNIT = re.compile(r"[($€£¥+\-]*\d[\d.,]*([a-z°%/]+)\W*$", re.IGNORECASE)
# The same tests for Arrow (RE2): edge signs, words that may be numbers, capitalised words, closing words.
_EDGE = r"^[^\pL\pN_]+|[^\pL\pN_]+$"
_CAPITAL = r"(?s)^[\"'(\[{«“‘]*\p{Lu}.*\p{Ll}"
_CLOSES = r"[.!?:][\"')\]}»”’]*$"


@dataclass(frozen=True)
class LeakParams:
    window: int = 8
    shortest: int = 5            # tokens of the shortest item with template windows
    fewest: int = 3              # words of the shortest item that is found inside other text
    literals: int = 4            # ordinary words a template window needs
    run: int = 13                # tokens of an exact alignment that is a leak whatever the item's length
    coverage: float = 0.5        # of an item's tokens
    consistent: float = 0.8      # share of an alignment's slots that keep the mapping


NUM, NAME, UNIT, WORD = 1, 2, 3, 0
_UNIT_SET, _STARTER_SET = pa.array(sorted(UNITS)), pa.array(sorted(STARTERS))
_MARK = mix64(np.array([0, 101, 102, 103], np.uint64))


@dataclass
class Slice:
    """Token positions of a slice of texts, one text after the other."""

    words: Words
    doc: np.ndarray              # text of each position
    literal: np.ndarray          # hash of the bare word
    token: np.ndarray            # hash of the template token
    kind: np.ndarray             # slot type
    either: np.ndarray           # can be a name as well as a word


def _flags(x) -> np.ndarray:
    return x.to_numpy(zero_copy_only=False)


def _canonical(texts: pa.Array) -> Slice:
    """Template tokens of a slice. Words are classified once per distinct word, by Arrow's kernels."""
    w = split_words(pc.replace_substring_regex(texts, r"[\x09-\x0D ]*[\n\r][\x09-\x0D ]*([^\x09-\x0D ])", "\n" + _LINE_START + r"\1"))
    v = pa.array(w.vocab, pa.string())
    line = pc.and_(pc.starts_with(v, _LINE_START), pc.greater(pc.binary_length(v), 1))
    v = pc.if_else(line, pc.replace_substring_regex(v, "^" + _LINE_START, ""), v)
    b = pc.utf8_lower(pc.replace_substring_regex(v, _EDGE, ""))
    named = pc.if_else(pc.equal(pc.binary_length(b), 0), v, b)
    literal = np.fromiter((xxhash.xxh64_intdigest(x, 3) for x in named.to_pylist()), np.uint64, len(v))
    closes = _flags(pc.match_substring_regex(v, _CLOSES))
    unit = _flags(pc.or_(pc.is_in(b, _UNIT_SET), pc.is_in(v, _UNIT_SET)))
    capital = _flags(pc.and_(pc.match_substring_regex(v, _CAPITAL), pc.invert(pc.is_in(b, _STARTER_SET))))
    number = np.zeros(len(v), bool)
    for i in np.flatnonzero(_flags(pc.match_substring_regex(v, r"\pN"))).tolist():
        word = v[i].as_py()
        if any(c.isdigit() for c in word):
            m = _NUMBER_UNIT.match(word)
            number[i] = bool(_NUMBER.match(word)) or bool(m and m[1].lower() in UNITS)
            unit[i] = capital[i] = False
    line = _flags(line)
    codes = w.codes
    kind = np.zeros(len(codes), np.int8)
    either = np.zeros(len(codes), bool)
    if len(kind):
        start = np.zeros(len(kind), bool)
        start[w.offsets[:-1][np.diff(w.offsets) > 0]] = True
        opens = np.append(False, closes[codes][:-1]) | start | line[codes]
        before_number = np.append(False, number[codes][:-1]) & ~start
        capitals = capital[codes]
        kind[capitals & ~opens] = NAME
        kind[unit[codes] & before_number] = UNIT
        kind[number[codes]] = NUM
        either = capitals & opens & (kind == WORD)
    each = literal[codes]
    return Slice(w, w.doc_of, each, np.where(kind == WORD, each, _MARK[kind]), kind, either)


def _hash(token, at: np.ndarray, size: int, names: int = 0) -> np.ndarray:
    """Hash of the windows at ``at``; bits of ``names`` are positions taken as names."""
    h = np.full(len(at), size, np.uint64)
    for k in range(size):
        h = h * HASH_MUL + (_MARK[NAME] if names >> k & 1 else token[at + k])
    return mix64(h)


def _before(flags: np.ndarray) -> np.ndarray:
    """Number of set flags before each position (one more at the end)."""
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])


def _windows(c: Slice, sizes: list[int], p: LeakParams, known: np.ndarray | None = None):
    """(size, start positions, hashes, names) of the usable windows of ``sizes`` tokens inside one text: first
    the literal ones (names: None), then templates by the positions taken as names (bits).

    ``known`` tells of each position whether any item may hold its word: a window
    with another word can match none, so it is left out before it is hashed.
    """
    plain_before = _before(c.kind == WORD)
    if known is not None:
        foreign = _before(~known), _before(~(known | (c.kind != WORD) | c.either))
    for size in sizes:
        n = len(c.token) - size + 1
        if n <= 0:
            continue
        inside = c.doc[:n] == c.doc[size - 1:]
        literal, template = [inside if known is None else inside & (f[size:] == f[:-size]) for f in (foreign if known is not None else (0, 0))]
        at = np.flatnonzero(literal)
        yield size, at, _hash(c.literal, at, size), None
        if size < p.shortest:
            continue
        some = np.flatnonzero(template)
        plain = plain_before[some + size] - plain_before[some]
        least = min(p.literals, size - 1)
        # windows without a slot are literal ones
        at = some[(plain >= least) & (plain < size)]
        yield size, at, _hash(c.token, at, size), 0
        some, plain = some[plain > least], plain[plain > least]
        open_at = np.zeros(len(some), np.int64)
        for k in range(size):
            open_at |= c.either[some + k].astype(np.int64) << k
        some, plain, open_at = (x[open_at > 0] for x in (some, plain, open_at))
        order = np.argsort(open_at, kind="stable")
        some, plain = some[order], plain[order]
        values, first = np.unique(open_at[order], return_index=True)
        for bits, mine, words in zip(values.tolist(), np.split(some, first[1:]), np.split(plain, first[1:])):
            names = bits
            while names:                    # all choices among the positions
                at = mine[words - names.bit_count() >= least]
                if len(at):
                    yield size, at, _hash(c.token, at, size, names), names
                names = (names - 1) & bits


def _slots(c: Slice, at: np.ndarray, size: int, names: int | None) -> list[list[str]]:
    """Slot values of each window, in order."""
    if names is None:
        return [[]] * len(at)
    out = []
    for s in at.tolist():
        where = (s + k for k in range(size) if c.kind[s + k] or names >> k & 1)
        out.append([(bare(x) or x.removeprefix(_LINE_START)) for x in (c.words.vocab[c.words.codes[k]] for k in where)])
    return out


_HASHES = "id bigint, hash bigint, at int, slots array<string>"


def _batch(ids, hashes, at, slots):
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(hashes.view(np.int64)), pa.array(at.astype(np.int32)),
         pa.array(slots, pa.list_(pa.string()))], names=["id", "hash", "at", "slots"])


def _as_long(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).cast("string").alias("t"))


def _item_texts(items: DataFrame) -> DataFrame:
    return (_as_long(items, "item_id", "text").where("t IS NOT NULL AND id IS NOT NULL")
            .groupBy("t").agg(F.min("id").alias("id")).select("id", "t"))


def item_windows(items: DataFrame, p: LeakParams) -> DataFrame:
    """(id, hash, at, slots, n_tokens, size) of the items' windows."""
    def run(batches):
        for part in text_slices(batches, "t"):
            c = _canonical(part.column(1))
            w, counts = c.words, np.diff(c.words.offsets)
            ids = part.column(0).to_pylist()
            for size, at, h, names in _windows(c, list(range(1, p.window + 1)), p):
                doc = c.doc[at]
                mine = (counts[doc] >= p.window) if size == p.window else (counts[doc] == size)
                at, h, doc = at[mine], h[mine], doc[mine]
                b = _batch([ids[d] for d in doc], h, at - w.offsets[doc], _slots(c, at, size, names))
                yield (b.append_column("n_tokens", pa.array(counts[doc].astype(np.int32)))
                       .append_column("size", pa.array(np.full(len(at), size, np.int32))))

    return _item_texts(items).mapInArrow(run, _HASHES + ", n_tokens int, size int")


def item_words(items: DataFrame) -> DataFrame:
    """(hash) of the items' bare words."""
    def run(batches):
        for part in text_slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_canonical(part.column(1)).literal).view(np.int64))], names=["hash"])

    return _item_texts(items).mapInArrow(run, "hash bigint")


def hash_table(windows: DataFrame) -> np.ndarray:
    """Bit table of the hashes, ``2**TABLE_BITS`` bits: combined on the executors; the driver gets at
    most ``2**(TABLE_BITS-6)`` words."""
    slot = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    rows = (windows.groupBy(F.shiftright(slot, 6).alias("word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - TABLE_BITS}) & 63 as int)))").alias("bits"))
            .collect())
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for r in rows:
        table[r.word] = r.bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def document_windows(docs: DataFrame, table, words, sizes: list[int], p: LeakParams, id_col: str,
                     text_col: str) -> DataFrame:
    """(id, hash, at, slots) of the documents' windows whose words and hash may be an item's."""
    def may_be(held, h):
        return held.value[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]

    def run(batches):
        for part in text_slices(batches, "t"):
            c = _canonical(part.column(1))
            w, counts = c.words, np.diff(c.words.offsets)
            ids = part.column(0).to_pylist()
            for size, at, h, names in _windows(c, sizes, p, may_be(words, c.literal)):
                may = may_be(table, h)
                if size < p.fewest:         # too little evidence inside other text
                    may &= counts[c.doc[at]] == size
                at, h = at[may], h[may]
                doc = c.doc[at]
                if names is None and size < p.window and len(at):
                    # the whole item in one window: its first copy in a text tells all
                    order = np.lexsort((at, h, doc))
                    new = np.append(True, (np.diff(doc[order]) != 0) | (h[order][1:] != h[order][:-1]))
                    at, h, doc = at[order][new], h[order][new], doc[order][new]
                yield _batch([ids[d] for d in doc], h, at - w.offsets[doc], _slots(c, at, size, names))

    return _as_long(docs, id_col, text_col).where("t IS NOT NULL AND id IS NOT NULL").mapInArrow(run, _HASHES)


def find_leaks(docs: DataFrame, items: DataFrame, p: LeakParams = LeakParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, item_id, covered, n_tokens, exact): contaminated documents, a row for each item; ``exact``
    tells that all slots have the item's own values."""
    spark = docs.sparkSession
    windows = scratch(item_windows(items, p), "items")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    table, words = (spark.sparkContext.broadcast(hash_table(x)) for x in (windows, item_words(items)))
    found = document_windows(docs, table, words, sizes, p, id_col, text_col)
    item = windows.select("hash", "size", F.col("id").alias("item_id"), F.col("at").alias("item_at"),
                          F.col("slots").alias("item_slots"), "n_tokens")
    # at the same shift, windows of an item and a document that overlap share their slots
    hits = (found.join(item, "hash")
            .where(F.size("slots") == F.size("item_slots"))
            .select("id", "item_id", "n_tokens", "size", "item_at", (F.col("at") - F.col("item_at")).alias("shift"),
                    F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("pairs")))
    # literal windows are exact whatever the slots of the templates at the same shift
    aligned = hits.groupBy("id", "item_id", "shift", (F.size("pairs") == 0).alias("literal")).agg(
        F.first("n_tokens").alias("n_tokens"),
        F.collect_set(F.struct("item_at", "size")).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))  # an alignment is at most one item long
    values = F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"])))
    aligned = (aligned.withColumn("fixed", F.when(F.size("pairs") == 0, 1.0)
                                  .otherwise(values / F.size("pairs")))
               .where(F.col("fixed") >= p.consistent)
               .withColumn("same", F.forall("pairs", lambda x: x["a"] == x["b"])))
    tokens = F.array_distinct(F.flatten(F.transform("places", lambda x: F.sequence(x["item_at"], x["item_at"] + x["size"] - 1))))
    aligned = aligned.withColumn("run", F.when(F.col("literal"), F.size(tokens)).otherwise(0))
    covered = (aligned.select("id", "item_id", "n_tokens", "same", "run", F.explode("places").alias("place"))
               .select("id", "item_id", "n_tokens", "same", "run",
                       F.explode(F.sequence(F.col("place.item_at"),
                                            F.col("place.item_at") + F.col("place.size") - 1)).alias("token"))
               .groupBy("id", "item_id").agg(F.countDistinct("token").alias("covered"),
                                             F.first("n_tokens").alias("n_tokens"),
                                             F.min("same").alias("exact"), F.max("run").alias("run")))
    return (covered.where((F.col("covered") >= p.coverage * F.col("n_tokens")) | (F.col("run") >= p.run))
            .select(F.col("id").alias(id_col), "item_id", "covered", "n_tokens", "exact"))
