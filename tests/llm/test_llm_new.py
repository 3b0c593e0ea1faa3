"""Fill-in-the-middle, spelling variants and SentencePiece against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tickwise.llm import fim, pieces, queries, spelling
from tickwise.llm.common import prepare

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "A a A a"), (6, "A a A a"), (7, "\x1cx\x00y z\x0bw"),
       (8, "word " * 30_000), (None, "lost words here"), (9, "Ünï ß é 🙂🙂 一 "), (10, "a <P> b"), (11, "x <S <M y> $1 \\2"),
       (12, "  lead and trail  "), (13, "x" * 200_000), (14, "퟿  next\u0085line nb")]


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


def odd_docs(spark):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    return df.withColumns({"Ids": F.lit("x"), "n": F.lit(1), "my col.a": F.lit(2), "decoded": F.lit(0), "output": F.lit(0)})


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_fim(doc_id, text, sent=fim.SENTINELS, fim_pct=50, spm_pct=80):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in sent) or h3 % 100 >= fim_pct:
        return doc_id, n, "plain", text, None, None
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = sent
    if h4 % 100 < spm_pct:
        return doc_id, n, "spm", s + suf + p + pre + m + mid, len(pre), len(mid)
    return doc_id, n, "psm", p + pre + s + suf + m + mid, len(pre), len(mid)


@pytest.mark.parametrize("sent,rate,spm", [(fim.SENTINELS, 50, 80), (("<|pre|>", "<|suf$1|>", "<|\\mid|>"), 100, 50), (("[.", "(*", "{+"), 100, 0)])
def test_fill_in_middle(spark, sent, rate, spm):
    rnd = random.Random(3)
    more = [(100 + k, "".join(rnd.choice([" ", "a", "bc", "\n", "🙂", "<", ">", "<M", "$", "\\", "é", "\t"]) for _ in range(rnd.randint(0, 40))))
            for k in range(300)]
    docs = odd_docs(spark).select("doc_id", "text", "output").unionByName(
        spark.createDataFrame(more, "doc_id bigint, text string").withColumn("output", F.lit(0)))
    out = fim.transform(docs, rate, spm, sentinels=sent)
    assert out.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    got = out.withColumn("back", fim.restore(F.col("output"), F.col("form"), sent)).collect()
    want = [brute_fim(d, t, sent, rate, spm) for d, t in ODD + more]
    order = lambda r: (r[0] is None, r[0], r[3])
    assert sorted((tuple(r)[:6] for r in got), key=order) == sorted(want, key=order)
    assert Counter(r.back for r in got) == Counter(t or "" for _, t in ODD + more)
    assert fim.transform(docs.limit(0)).count() == 0
    assert {r.form for r in got} >= ({"plain", "spm", "psm"} if spm == 80 else {"plain", "psm"})


def test_fill_in_middle_rejects_sentinels_that_overlap():
    for bad in [("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P", "P>", "<M>"), ("<P>", "x<P>", "<M>")]:
        with pytest.raises(ValueError):
            fim._check(bad)


def test_fill_in_middle_query_is_one_pass(spark):
    df = queries.QUERIES["op11_fill_in_middle"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    want = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    rows = {brute_fim(*r) for r in want}
    assert {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in df.collect()} == {
        (d, n, f, p, m, sha(o), sha(t or "")) for (d, n, f, o, p, m), (_, t) in zip(map(lambda r: brute_fim(*r), want), want)}
    assert len(rows) > 1


# --- spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, noise=31, least=2):
    n = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(n, ratio=10):
    holes = {}
    for w in n:
        for k in range(len(w)):
            holes.setdefault((len(w), w[:k], w[k + 1:]), []).append(w)
    near = {w: set() for w in n}
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    for w in n:
        for k in range(len(w)):
            short = w[:k] + w[k + 1:]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    rows = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return rows


def as_rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: tuple(r)[1:] for r in got}


def test_spelling_query_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = brute_groups(brute_words(docs))
    assert as_rows(queries.QUERIES["op12_spelling_variants"](spark, SF)) == want
    assert sum(r[0] is not None for r in want.values()) >= 10


@pytest.mark.parametrize("crowd", [0, 3, 10_000])
def test_near_words_of_any_shape(spark, crowd):
    """Dense neighbourhoods, repeated letters, letters beyond the BMP, ties; all sizes of crowds."""
    rnd = random.Random(crowd)
    base = ["aaaaaaa", "abababab", "wörterbuch", "straßenbahn", "🙂🙂🙂🙂🙂🙂🙂", "internationally"]
    words = set(base)
    for _ in range(6):
        for w in rnd.sample(sorted(words), min(len(words), 60)):
            k, c = rnd.randrange(len(w)), rnd.choice("abz🙂é")
            words |= {w[:k] + c + w[k:], w[:k] + c + w[k + 1:], w + c, c + w, w[:k] + w[k + 1:]}
    n = {w: rnd.choice([2, 2, 3, 20, 30, 300, 4000]) for w in words if len(w) >= 5}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint").withColumn("Form", F.lit(1))
    pairs = spelling.near_pairs(df, crowd).collect()
    assert len(pairs) == len({frozenset((r.word_a, r.word_b)) for r in pairs})
    assert all(one_edit(r.word_a, r.word_b) and r.n_a == n[r.word_a] and r.n_b == n[r.word_b] for r in pairs)
    assert as_rows(spelling.group(df, crowd=crowd)) == brute_groups(n)


def test_spelling_edge_cases(spark):
    assert spelling.group(spark.createDataFrame([], "word string, n bigint")).count() == 0
    df = spark.createDataFrame([(None, 9), ("abc", 5), ("abd", 500), ("spelling", 100), ("speling", 1), ("speling", 1), ("", 3)], "word string, n bigint")
    assert as_rows(spelling.group(df)) == {
        "abc": (None, "abc", 5, 0, None), "abd": (None, "abd", 500, 0, None), "": (None, "", 3, 0, None),
        "spelling": (None, "spelling", 100, 1, None), "speling": ("spelling", "spelling", 2, 1, 100)}
    odd = odd_docs(spark)
    got = {r.word: r.n for r in spelling.word_counts(odd, least_length=3, least_count=1, noise=2).collect()}
    want = Counter()
    for d, t in ODD:
        for run in RUN.findall(t or ""):
            w = run.translate(LOWER)
            if len(w) >= 3:
                h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
                w = w[:h % len(w)] + w[h % len(w) + 1:] if h % 2 == 0 else w
                if len(w) >= 3:
                    want[w] += 1
    assert got == dict(want)


def test_chains_are_followed(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [("x", "w36")]
    got = {r.word: r.root for r in spelling.follow(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {**{f"w{k}": "w37" for k in range(37)}, "x": "w37"}


def test_tables_that_grow_with_the_words_are_not_broadcast(spark, monkeypatch):
    """Their files are far below Spark's threshold, what an explode makes of them is not."""
    plans, scratch = [], spelling.scratch

    def run(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df, rows

    monkeypatch.setattr(spelling, "scratch", lambda df, label: scratch(run(df)[0], label))
    n = {f"{c}spellin{d}": 2 + 50 * (c == "f") for c in "abcdefghi" for d in "gkmn"}
    n |= {"spellin": 9, "aspelling": 20_000, "internationally": 7, "internationaly": 700}
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = {r.word: tuple(r)[1:] for r in run(spelling.group(words, crowd=5))[1]}
    assert got == brute_groups(n)
    joins = {x for p in plans for x in re.findall(r"(\w+Join)\b.*? (Inner|LeftOuter|LeftAnti|LeftSemi)\b", p)}
    assert {("SortMergeJoin", "Inner"), ("SortMergeJoin", "LeftOuter")} <= joins
    assert {kind for name, kind in joins if name.startswith("Broadcast")} <= {"LeftAnti", "LeftSemi"}  # with the crowded keys


# --- SentencePiece

@pytest.fixture(scope="module")
def model():
    with open(pieces.default_model(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def ours(model):
    return pieces.PieceModel(model)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def ids_of(ours, text):
    return ours.encode_all(pa.array([text]))[0].as_py()


def test_encoding_equals_the_library(ours, library):
    rnd = random.Random(7)
    parts = [" ", "  ", "▁", "a", "b", "the", "ing", "\n", "\t", "é", "一", "梦", "🙂", "\0", "<s>", "<0x0A>", "</s>", "<unk>", "ab", "1",
             "==", "aaaa", "    ", "ß", "Ж", "́", "​", ".", ",", "ﬁ", "A", "Th", "'s", "-", "ł", "(", "\x7f", "http://"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(5000)]
    texts += [t or "" for _, t in ODD] + [" " * 5000, "ab" * 40_000, "梦一" * 2000, "x" * 70_000 + " " * 3000,
                                          "".join(rnd.choice("abcXYZ0189+/") for _ in range(150_000))]
    want = library.encode(texts, num_threads=1)
    got = ours.encode_all(pa.array(texts))
    assert got.to_pylist() == want
    assert ours.decode_all(got).to_pylist() == library.decode(want)


def test_long_texts_are_cut_into_blocks(ours, library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 50)
    monkeypatch.setattr(pieces, "WINDOW", 64)
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 5000)
    monkeypatch.setattr(pieces, "PAIRS", 100)
    rnd = random.Random(9)
    for _ in range(60):
        text = "".join(rnd.choice(["   ", " word", "internation", "ally", "\n", "🙂", " ▁", "aaaa", "."]) for _ in range(200))
        assert ids_of(ours, text) == library.encode(text)


def test_decoding_any_ids_equals_the_library(ours, library):
    rnd = random.Random(11)
    for _ in range(4000):
        ids = [rnd.randrange(32000) if rnd.random() < 0.4 else rnd.randrange(300) for _ in range(rnd.randint(0, 12))]
        assert ours.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py() == library.decode(ids)
    for bad in ([-1], [32000]):
        with pytest.raises(ValueError):
            ours.decode_all(pa.array([bad], pa.list_(pa.int32())))


def test_whole_text_is_one_chunk_if_spaces_stand_inside_pieces(ours, library, model):
    whole = pieces.PieceModel(model)
    whole.cuts = None
    for text in ["Hello  world, a text\nof two lines", " x", "a" * 500]:
        assert whole.encode(text) == ours.encode(text)


def test_other_models_are_refused(model):
    """The same model with another normaliser setting (a last field overrides)."""
    for spec in (b"\x1a\x02\x20\x01", b"\x1a\x02\x18\x00", b"\x12\x02\x18\x01", b"\x1a\x03\x12\x01x"):
        with pytest.raises(ValueError):
            pieces._check_model(model + spec)


def test_sentencepiece_frames(spark, library):
    docs = odd_docs(spark)
    coded = pieces.encode(docs)
    assert coded.columns == ["doc_id", "text", "n", "my col.a", "decoded", "output", "ids"]
    got = pieces.decode(coded).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(
        (d, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for d, t in ODD)
    assert pieces.decode(pieces.encode(docs.limit(0))).count() == 0
    lists = spark.createDataFrame([(1, None), (2, []), (3, [259, 5])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in pieces.decode(lists).collect()} == {1: "", 2: "", 3: library.decode([259, 5])}


def test_sentencepiece_query(spark, library):
    want = {(d, len(i), sha(",".join(map(str, i))), sha(library.decode(i)))
            for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall() for i in [library.encode(t or "")]}
    got = queries.QUERIES["op13_sentencepiece"](spark, SF).collect()
    assert {tuple(r) for r in got} == want
