"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. The shorter word (either, at equal length) contributes two disjoint chunks of
half its length, one from each end; the other contributes its positional grams of
that size. One edit leaves one chunk whole, moved by at most one place, so both
words of a near pair share a (length, chunk, gram) key. Only grams within shift one of a
chunk's place can meet it, so only these are written. A hash join on the keys gives the
candidates, and each is verified by its edit distance.

Crowded keys (above ``CROWD`` grams: a very common half of a word) are no group of pairs:
their words are joined on a longer key, the key and what is left of the word outside
the gram, without one code point. It is still exact (the edit lies outside the
gram), and such a key holds at most one word for each letter of the alphabet.

Counts are aggregated on the mappers first. Tables between steps are written to the
shared checkpoint folder. Joins of tables that grow with the words carry a merge hint: Spark
sizes them by compressed files and takes no account of an explode, so it would broadcast a
table of hundreds of MB as one below its threshold. Only the keys above ``CROWD`` may be
broadcast (a number each, one for thousands of grams).

Defined cases: words are compared by code points, as they are; null words and words shorter
than 4 code points have no near words; repeated words count as one with their counts added; an empty
table gives an empty result; other columns are ignored; ties of counts go to the smallest
word in code-point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import quoted, scratch

CROWD = 2000        # grams of a key that are joined directly
SHORTEST = 4        # code points of the shortest word that is compared


def word_counts(docs: DataFrame, run: str = r"[A-Za-zÀ-ÿ]", least_length: int = 7, least_count: int = 2,
                noise: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): maximal runs of whole texts, A-Z lower-cased, with their number of occurrences.

    With ``noise``, a run whose crc32 of ``id:run`` is divisible by it loses the code point at
    that crc32 modulo its length: planted misspellings. A null text has no runs, a null id is empty.
    """
    az = "abcdefghijklmnopqrstuvwxyz"
    found = docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(quoted(text_col), F.lit(f"{run}{{{least_length},}}"), F.lit(0))).alias("run"))
    rows = found.select("id", F.translate("run", az.upper(), az).alias("run"))
    word = F.col("run")
    if noise is not None:
        rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        word = F.when(F.col("h") % noise == 0, cut).otherwise(word)
    return (rows.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def _part(start, length) -> tuple[Column, Column]:
    """Gram of a word at ``start`` (from 0), and the rest of the word."""
    w = F.col("word")
    return F.substring(w, start + 1, length), F.concat(F.substring(w, F.lit(1), start), F.substring(w, start + length + 1, F.length(w)))


def _keyed(words: DataFrame, side: str) -> DataFrame:
    """(key, word, n, rest, longer) of the chunks or of the grams that can meet them.

    ``longer`` is 1 where the gram's word is one code point longer than the chunk's.
    """
    size = F.length("word")
    entries = []
    for longer in (0, 1):
        short = size - longer if side == "gram" else size       # length of the word with the chunks
        q = F.floor(short / 2).cast("int")
        for chunk in (0, 1):
            place = F.lit(0) if chunk == 0 else short - q
            for shift in range(longer + 1 if side == "gram" else 1):
                gram, rest = _part(place + shift, q)
                entries.append(F.struct(F.xxhash64(short, F.lit(longer), F.lit(chunk), gram).alias("key"),
                                        rest.alias("rest"), F.lit(longer).alias("longer")))
    return words.select("word", "n", F.explode(F.array(*entries)).alias("e")).select("e.key", "word", "n", "e.rest", "e.longer")


def _without_one(side: str) -> Column:
    """Hashes of a crowded key and the rest without one code point. The chunk's word keeps its
    rest as it is when the gram's word is the longer one; at equal length both lose the same place."""
    place = F.sequence(F.lit(0), F.length("rest") - 1)
    cut = F.transform(place, lambda i: F.xxhash64("key", F.when(F.col("longer") == 0, i).otherwise(-1), F.concat(
        F.substring(F.col("rest"), F.lit(1), i), F.substring(F.col("rest"), i + 2, F.length("rest")))))
    if side == "gram":
        return cut
    return F.when(F.col("longer") == 0, cut).otherwise(F.array(F.xxhash64("key", F.lit(-1), "rest")))


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word_a, n_a, word_b, n_b): each pair of near words of (word, n) once."""
    long_enough = words.where(F.length("word") >= SHORTEST)
    chunks, grams = _keyed(long_enough, "chunk"), _keyed(long_enough, "gram")
    sizes = grams.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    crowded = scratch(sizes.where(F.col("size") > crowd).select("key"), "crowded")

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        a = a.select("key", F.col("word").alias("word_a"), F.col("n").alias("n_a"), "longer")
        b = b.select("key", F.col("word").alias("word_b"), F.col("n").alias("n_b"))
        return (a.join(b.hint("merge"), "key").where((F.col("longer") == 1) | (F.col("word_a") < F.col("word_b")))
                .where(F.levenshtein("word_a", "word_b", 1) == 1).select("word_a", "n_a", "word_b", "n_b"))

    common = [x.join(crowded, "key", "left_anti") for x in (chunks, grams)]
    split = [x.join(crowded, "key", "left_semi").withColumn("key", F.explode(_without_one(side)))
             for x, side in ((chunks, "chunk"), (grams, "gram"))]
    return meet(*common).unionByName(meet(*split)).distinct()


def follow(links: DataFrame) -> DataFrame:
    """(word, root) of acyclic links (word, form): the last of each chain, by pointer doubling."""
    up = links.select("word", F.col("form").alias("root"))
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch(up.join(step.hint("merge"), "root", "left").select("word", "root", "next"), "roots")
        up = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next IS NOT NULL").isEmpty():
            return up


def group(words: DataFrame, ratio: int = 10, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    ``form`` is the near word with the largest count if that is at least ``ratio`` times the
    word's own, ``root`` the end of the chain of forms (the word itself without one).
    """
    words = scratch(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "words")
    pairs = near_pairs(words, crowd)
    # each pair read from both ends; the best near word by count, then by name
    side = lambda w, a, b: F.struct(F.col(w).alias("word"), (-F.col(a)).alias("less"), F.col(b).alias("near"))
    ends = pairs.select(F.explode(F.array(side("word_a", "n_b", "word_b"), side("word_b", "n_a", "word_a"))).alias("e")).select("e.*")
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    chosen = -F.col("best.less") >= ratio * F.col("n")
    found = scratch(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")), "forms")
    roots = follow(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
