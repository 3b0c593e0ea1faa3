"""Registered queries of the training-data operators, with SQL twins where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (ann, chat, decontaminate, fim, licenses, linededup, packing, pieces, pst, quality, simhash,
                          spelling, toxicity)
from tickwise.llm.common import prepare, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_suffix_tree")
def op1(spark, sf_dir):
    """Log10 probability of every document; documents of the fold crc32 mod 5 = 1 are not learnt from."""
    held_out = remainder(F.col("doc_id"), 5) == 1
    return pst.score(_table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op2_packing")
def op2(spark, sf_dir):
    """Pieces of all documents along the curve; digest of each piece's ids."""
    return packing.pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op3_decontamination")
def op3(spark, sf_dir):
    """Documents that hold a benchmark item, exact or re-parameterised: one row for each item."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SHINGLE_WORDS, MAX_BITS = 3, 3


@register("op4_simhash")
def op4(spark, sf_dir):
    """Fingerprint and component of every document (3-word shingles, links at 3 bits)."""
    found = simhash.cluster(_table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def chat_events(rows: DataFrame) -> DataFrame:
    """Event log of given conversation rows, as a chat service would have written it.

    A user's or system's message arrives as a draft that an edit replaces; an
    assistant's is streamed in two deltas, broken off, regenerated and streamed
    again. Null roles and texts are empty. Rows that are equal throughout are
    messages of their own, told apart by a copy number.
    """
    cells = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # equal rows meet as counts, so a row repeated very often is no hot key
    copies = cells.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    numbered = copies.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    text = F.col("text")
    half = (F.length(text) / 2).cast("int")
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    streamed = F.array(event("message", F.lit("")), event("delta", rest), event("regenerate", F.lit("")),
                       event("delta", first), event("delta", rest))
    edited = F.array(event("message", first), event("edit", text))
    log = F.when(F.col("role") == "assistant", streamed).otherwise(edited)
    # rows with the same conversation and turn are different messages; the role's length keeps (role, text) unambiguous
    message = F.concat_ws("/", F.coalesce(F.col("turn").cast("string"), F.lit("")), F.md5(F.concat_ws("\n", "role", "text")),
                          F.length("role").cast("string"), F.col("copy").cast("string"))
    return (numbered.select("conv_id", "turn", "role", message.alias("message"), F.posexplode(log).alias("k", "e"))
            .select("conv_id", (F.coalesce("turn", F.lit(-1)) * 8 + F.col("k")).alias("seq"), "e.kind", "message", "role", "e.text"))


def files_of(docs: DataFrame) -> DataFrame:
    """(doc_id, path, text): documents as files of source trees, placed by their ids; every 20th file is
    its package's LICENSE, every 200th its library's."""
    part = lambda name, n: F.concat(F.lit(name), F.floor(F.col("doc_id") / n))
    library = F.concat_ws("/", F.coalesce("source", F.lit("")), part("vol", 20000), part("lib", 200))
    package = F.concat_ws("/", library, part("pkg", 20))
    path = (F.when(F.col("doc_id") % 200 == 0, F.concat(library, F.lit("/LICENSE")))
            .when(F.col("doc_id") % 20 == 0, F.concat(package, F.lit("/LICENSE")))
            .otherwise(F.concat(package, F.lit("/f"), F.col("doc_id"), F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


@register("op5_licence_scan")
def op5(spark, sf_dir):
    """Licence of every document as a file: its own by template, or that of the nearest directory above."""
    return licenses.scan(files_of(_table(spark, sf_dir, "documents")))


@register("op6_chat_format")
def op6(spark, sf_dir):
    """All conversations and one made of control strings: folded from their event log, rendered
    and read back from the output."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat.read_back(chat.format_chats(chat_events(rows.unionByName(probe))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


@register("op7_nearest_neighbours")
def op7(spark, sf_dir):
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


# html to lines: the same patterns in both languages
_DROP = r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->"
_BREAK = r"(?i)<(br|/p|/li|/h[1-6]|/div|/title|/nav|/ul|/article|/tr|/td)\b[^>]*>"
_TAG = r"(?s)<[^>]*>"


def html_lines(html):
    """Text of a page, one line for each block element."""
    x = F.regexp_replace(html, _DROP, "")
    x = F.regexp_replace(x, _BREAK, "\n")
    x = F.regexp_replace(x, _TAG, "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


_HTML_SQL = "regexp_replace(regexp_replace(regexp_replace(html, '{}', '', 'g'), '{}', chr(10), 'g'), '{}', '', 'g')".format(
    _DROP, _BREAK, _TAG)
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    _HTML_SQL = f"replace({_HTML_SQL}, '{_a}', '{_b}')"


@register("op8_line_dedup", rf"""
WITH p AS (SELECT page_id, coalesce(lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)), '') AS host,
                  string_split({_HTML_SQL}, chr(10)) AS ls FROM pages),
l AS (SELECT DISTINCT page_id, host, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
      FROM p, unnest(ls) AS u(x)),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
b AS (SELECT l.host, line FROM l JOIN t USING (host) WHERE line <> '' GROUP BY l.host, line, pages
      HAVING count(*) >= 3 AND count(*) > 0.3 * pages),
g AS (SELECT host, list(line) AS boiler FROM b GROUP BY host),
k AS (SELECT page_id, p.host, ls, list_filter(ls, lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) = ''
        OR boiler IS NULL OR NOT list_contains(boiler, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)))) AS kept
      FROM p LEFT JOIN g ON p.host = g.host)
SELECT page_id, host, array_to_string(kept, chr(10)) AS text, len(ls) AS n_lines, len(ls) - len(kept) AS n_dropped FROM k""")
def op8(spark, sf_dir):
    """All pages with the lines dropped that stand on over 30 % (and three or more) of their host's pages."""
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", F.coalesce(F.lower(F.regexp_extract("url", r"^[^:/]+://([^/?#]*)", 1)), F.lit("")).alias("host"),
        html_lines(F.col("html")).alias("text"))
    return linededup.drop_boilerplate(pages, F.col("host"))


@register("op9_toxicity")
def op9(spark, sf_dir):
    """Toxicity of every document; labels of the fold crc32 mod 5 = 0 are not learnt."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@register("op10_quality")
def op10(spark, sf_dir):
    """Quality of every document; labels of the fold crc32 mod 3 = 1 are not learnt."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@register("op11_fill_in_middle", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
             list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS g FROM t),
c AS (SELECT *, len(u) AS n, least(g[1] % (len(u) + 1), g[2] % (len(u) + 1)) AS a,
             greatest(g[1] % (len(u) + 1), g[2] % (len(u) + 1)) AS b,
             CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR g[3] % 100 >= 50 THEN 'plain'
                  WHEN g[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256 FROM p""")
def op11(spark, sf_dir):
    """Fill-in-the-middle form of every document, with digests of the output and of the text rebuilt from it."""
    out = fim.transform(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op12_spelling_variants")
def op12(spark, sf_dir):
    """Words of all documents (one letter planted out of some) grouped with their more frequent near words."""
    return spelling.group(spelling.word_counts(_table(spark, sf_dir, "documents"), noise=31))


@register("op13_sentencepiece")
def op13(spark, sf_dir):
    """Ids of every document and the text decoded from them, as digests."""
    coded = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents"), keep=["doc_id"]))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
