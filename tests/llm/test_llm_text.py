"""Classifiers, fingerprints, packing and suffix tree against brute force."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tickwise.llm import packing, pst, quality, queries, simhash, toxicity
from tickwise.llm.common import prepare, remainder, split_words
from tickwise.llm.graph import connected_components

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "A a A a"), (6, "A a A a"), (7, "\x1cx\x00y z\x0bw"),
       (8, "word " * 30_000), (None, "lost"), (9, "Ünï ß é"), (10, "[INST] x </s>")]


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


def odd_docs(spark, extra=True):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    return df.withColumns({"Score": F.lit("x"), "fp": F.lit(1), "my col.a": F.lit(2), "component": F.lit(0)}) if extra else df


def test_words_are_the_pattern():
    texts = [t or "" for _, t in ODD]
    w = split_words(pa.array([t for _, t in ODD]))
    for i, t in enumerate(texts):
        assert [w.vocab[c] for c in w.codes[w.offsets[i]:w.offsets[i + 1]]] == WORD.findall(t)


@pytest.mark.parametrize("module,target,divisor,held", [(quality, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_held_out_accuracy(spark, module, target, divisor, held):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = module.score(docs, module.fit(docs, labels), keep=["doc_id"]).join(labels, "doc_id")
    out = got.where(remainder(F.col("doc_id"), divisor) == held).select("score", "predicted", target).collect()
    right = sum(r.predicted == r[target] for r in out) / len(out)
    common = max(Counter(r[target] for r in out).values()) / len(out)
    assert len(out) > 50 and right > max(0.9, common) and all(0 <= r.score <= 1 for r in out)


def brute_quality(text, model):
    """Score of one text from the fitted weights, word by word."""
    p, m64 = model.params, (1 << 64) - 1
    mul = int(quality.HASH_MUL)

    def mix(x):
        for shift, k in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * k & m64
        return x ^ x >> 31

    words = WORD.findall(text or "")
    whole = lambda w: mix(sum(ord(c) * pow(mul, k, 1 << 64) for k, c in enumerate(f"<{w}>")) & m64)
    found = []
    for w in words:
        found.append(whole(w))
        for n in p.n_grams:
            for k in range(len(w) + 3 - n):
                h = n
                for c in f"<{w}>"[k:k + n]:
                    h = (h * mul + ord(c)) & m64
                found.append(mix(h))
    pairs = list(zip(words, words[1:]))
    found += [mix((whole(a) * mul + whole(b)) & m64) for a, b in pairs]
    again = sum(x in pairs[max(0, i - p.recent):i] for i, x in enumerate(pairs))
    total = sum(float(model.logit[h >> (64 - p.bits)]) for h in found) + again * float(model.logit[quality.REPEAT])
    return 1 / (1 + math.exp(-(total / max(1, len(found) + again) + model.bias)))


def test_op10_score_is_the_average_of_word_gram_and_pair_vectors(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = docs.where("doc_id % 20 = 0 AND length(text) < 4000").select("doc_id", "text").unionByName(odd_docs(spark, False).where("doc_id <> 8"))
    rows = rows.unionByName(spark.createDataFrame([(-1, "buy now " * 50), (-2, "a b c a b c a d a a")], "doc_id bigint, text string"))
    got = quality.score(rows, model).collect()
    assert len(got) > 40 and all(abs(r.score - brute_quality(r.text, model)) < 1e-9 for r in got)


def test_repeated_phrases_are_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    phrases = ["buy ", "buy now ", "click here to win a prize ", "one two three four five six seven eight nine ten eleven twelve "]
    rows = spark.createDataFrame([(k, x * 100) for k, x in enumerate(phrases)], "doc_id bigint, text string")
    assert all(r.score < 0.1 for r in quality.score(rows, model).collect())


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edge_cases(spark, module):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 0, 1), (99, 1, 1), (None, 1, 1), (6, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    docs = odd_docs(spark)
    for lab in (labels, labels.limit(0)):
        model = module.fit(docs, lab)
        got = module.score(docs, model)
        assert got.columns == ["doc_id", "text", "fp", "my col.a", "component", "score", "predicted"]
        rows = got.collect()
        assert len(rows) == len(ODD) and all((r.score >= 0.5) == bool(r.predicted) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
        assert module.score(docs.limit(0), model).count() == 0


def test_counterfactual_penalty_lowers_identity_weights():
    rng = np.random.default_rng(0)
    filler = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        words = list(rng.choice(filler, 12))
        toxic = i % 2
        if toxic:
            words[3] = "vile"
        if rng.random() < (0.8 if toxic else 0.1):      # toxic texts mention the group more often
            words[6] = "immigrants"
        rows.append((" ".join(words), toxic))
    neutral = pa.array(["the immigrants came w1 w2 w3"])
    fair = toxicity.train(rows, toxicity.ToxicityParams(pair_weight=3.0))
    plain = toxicity.train(rows, toxicity.ToxicityParams(pair_weight=0.0))
    swap = pa.array(["the people came w1 w2 w3"])
    logit = lambda m, t: math.log(float(toxicity.score_words(split_words(t), m)[0]) / (1 - float(toxicity.score_words(split_words(t), m)[0])))
    gap_fair = abs(logit(fair, neutral) - logit(fair, swap))
    gap_plain = abs(logit(plain, neutral) - logit(plain, swap))
    assert gap_fair < 0.5 * gap_plain
    assert logit(fair, pa.array(["w1 vile w2"])) > logit(fair, pa.array(["w1 w5 w2"]))
    pairs = toxicity.counterfactual_pairs("Hello. The Women won! No one else.", toxicity.ToxicityParams())
    assert pairs and all(a[0] == "the" and b[1] != "women" for a, b in pairs)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_fingerprint(text, width=3):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            parent[root(i)] = root(j)
    least = defaultdict(lambda: math.inf)
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least[root(i)], d)
    return [None if least[root(i)] == math.inf else least[root(i)] for i in range(len(ids))]


def test_op4_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(d.text) for d in docs]
    want = brute_components([d.doc_id for d in docs], fps, 3)
    got = {r.doc_id: r for r in queries.QUERIES["op4_simhash"](spark, SF).collect()}
    for d, f, c in zip(docs, fps, want):
        assert got[d.doc_id].fingerprint == f"{f:016x}" and got[d.doc_id].component_id == c


def test_simhash_edge_cases(spark):
    docs = odd_docs(spark)
    got = simhash.cluster(docs)
    assert got.columns == ["doc_id", "fp", "component"]
    rows = got.collect()
    want = brute_components([i for i, _ in ODD], [brute_fingerprint(t) for _, t in ODD], 3)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component) for r in rows), key=key) == sorted(
        ((i, brute_fingerprint(t), c) for (i, t), c in zip(ODD, want)), key=key)
    assert simhash.cluster(docs.limit(0)).count() == 0


@pytest.mark.parametrize("level", [0, 1, 2])
def test_masks_cover_every_pair_within_the_radius(level):
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(3, level)]
    assert all(any(not (m & bits) for m in masks)
               for c in itertools.combinations(range(64), 3) for bits in [sum(1 << i for i in c)])


def test_oversized_buckets_lose_no_link(spark, monkeypatch):
    """A dense ball of fingerprints, forced through further rounds of masks."""
    rng = np.random.default_rng(1)
    center = int(rng.integers(1 << 62))
    fps = {center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False)) for _ in range(600)}
    fps |= {int(x) for x in rng.integers(1 << 62, size=200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    want = Counter(Counter(brute_components(list(range(len(fps))), fps, 3)).values())
    for bucket, near in ((4096, 64), (40, 8)):
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        monkeypatch.setattr(simhash, "NEAR", near)
        links = [(r.a, r.b) for r in _near_links_local(spark, df)]
        node = {f: i for i, f in enumerate(signed)}
        parent = list(range(len(fps)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i
        for a, b in links:
            parent[root(node[a])] = root(node[b])
        assert Counter(Counter(root(i) for i in range(len(fps))).values()) == want


def _near_links_local(spark, df):
    """The rounds of ``near_links`` with this process's module state (workers import their own)."""
    rows = [(0, r.fp) for r in df.collect()]
    level, links = 0, []
    while rows:
        spread = sorted({((m | k), f & (m | k), f) for m, f in rows for k in simhash.covering_masks(3, level)})
        batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in spread], pa.int64()) for i in range(3)], names=["mask", "key", "fp"])
        rows = []
        for out in simhash._bucket_walk(3)(iter([batch.slice(k, 700) for k in range(0, len(batch), 700)])):
            for kind, a, b in zip(*(c.to_pylist() for c in out.columns)):
                (links if kind == 0 else rows).append((a, b))
        rows = list(set(rows))
        level += 1
    from types import SimpleNamespace
    return [SimpleNamespace(a=a, b=b) for a, b in links]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def whole_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def check_pieces(pieces, docs, size=4096):
    """Exact round trip, no gap or overlap, padding only where allowed."""
    want = Counter()
    for (d, _), ids in zip(docs, whole_ids([t for _, t in docs])):
        want[(d, tuple(ids))] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length and p.length > 0
    got = Counter()
    for d, ps in by_doc.items():
        # repeated ids are told apart by what they hold
        open_ = sorted(ps, key=lambda p: (p.sequence_id, p.offset))
        ids, docs_of = [], []
        for p in open_:
            if p.start == 0:
                docs_of.append([])
            assert p.start == len(docs_of[-1])
            docs_of[-1] += np.frombuffer(p.ids, "<u4").tolist()
            ids.append(p.doc_tokens)
        for x in docs_of:
            got[(d, tuple(x))] += 1
        assert sum(set(ids)) >= 1
    assert got == want
    padding = 0
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        at = 0
        for p in ps:
            assert p.offset == at
            at += p.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0


def test_packing_round_trip(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_pieces(packing.pack(spark.read.parquet(f"{SF}/documents.parquet")).collect(), docs)


def test_packing_edge_cases(spark):
    docs = odd_docs(spark)
    check_pieces(packing.pack(docs).collect(), ODD)
    assert packing.pack(docs.limit(0)).count() == 0
    hard = ["don't it's. we'll!! A'S 12.5kg, ÀÉ.", "İstanbul, J̌ x<|endoftext|>. <|ENDOFTEXT|>, ΑΣ.", "ñ̃o… (a) \x1c b c", "!!!"]
    tok = packing.WordTokenizer(open(packing.default_tokenizer(), encoding="utf-8").read())
    assert tok.by_word
    for by_word in (True, False):
        tok.by_word = by_word
        ids, n, sums = tok.encode(pa.array(hard), 2, np.ones((1, tok.size)))
        assert [np.frombuffer(x, "<u2").tolist() for x in ids.to_pylist()] == whole_ids(hard)
        assert n.tolist() == sums[:, 0].tolist() == [len(x) for x in whole_ids(hard)]


def test_hilbert_neighbours_touch():
    grid = np.array(list(itertools.product(range(8), repeat=3)))
    key = packing.hilbert_key(grid, 3)
    assert sorted(key.tolist()) == list(range(512))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def brute_tree(docs, p):
    """Counts by dictionary, same tests and smoothing; log10 scores."""
    texts = [(d, [w for w in WORD.findall(ascii_lower(t or ""))] + ["\n"]) for d, t in docs]
    fold = [zlib.crc32(str(d if d is not None else "").encode()) % 5 for d, _ in texts]
    n = Counter()
    total = Counter()
    for (_, words), f in zip(texts, fold):
        if f == 1:
            continue
        for i in range(len(words)):
            for k in range(0, p.depth + 1):
                if i - k >= 0:
                    n[tuple(words[i - k:i + 1])] += 1
                    total[tuple(words[i - k:i])] += 1
    unigrams = {g[0]: c for g, c in n.items() if len(g) == 1}
    big, v = sum(unigrams.values()), len(unigrams)
    kept = set()

    def prob(history, x):
        q = (unigrams.get(x, 0) + 0.5) / (big + 0.5 * (v + 1))
        for k in range(1, p.depth + 1):
            s = tuple(history[len(history) - k:]) if len(history) >= k else None
            if s in kept:
                q = (n[s + (x,)] + p.mass * q) / (total[s] + p.mass)
        return q
    follow = defaultdict(list)
    for g in n:
        if len(g) > 1:
            follow[g[:-1]].append(g[-1])
    for k in range(1, p.depth + 1):
        now = [s for s in follow if len(s) == k and total[s] >= p.least
               and all(total[s[j:]] >= p.least for j in range(k))]
        passed = set()
        for s in now:
            gain = sum(n[s + (x,)] * math.log((n[s + (x,)] - 1 + p.mass * prob(s[1:], x)) / ((total[s] - 1 + p.mass) * prob(s[1:], x)))
                       for x in follow[s])
            if gain >= p.divergence:
                passed.add((s, round(gain, 6)))
        kept |= {s for s, _ in passed}
    out = []
    for d, words in texts:
        out.append((d, len(words), sum(unigrams.get(w, 0) > 0 for w in words), big,
                    sum(math.log10((unigrams.get(w, 0) + 0.5) / (big + 0.5 * (v + 1))) for w in words),
                    sum(math.log10(prob(words[:i], w)) for i, w in enumerate(words))))
    return out, kept, prob, unigrams


def same_scores(got, want):
    by_id = {r.doc_id: r for r in got}
    assert len(by_id) == len(want)
    for d, tokens, known, big, base, score in want:
        g = by_id[d]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (tokens, known, big)
        assert (g.base_score, g.score) == pytest.approx((base, score), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("hot_share, depth", [(1e-2, 12), (1e-4, 4), (1e-2, 2)])
def test_suffix_tree_against_brute_force(spark, hot_share, depth):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    p = pst.PstParams(depth=depth, hot_share=hot_share, block_bytes=60_000, bucket_tokens=20_000)
    want, kept, prob, words = brute_tree(docs, p)
    same_scores(pst.score(spark.read.parquet(f"{SF}/documents.parquet"), remainder(F.col("doc_id"), 5) != 1, p).collect(), want)
    assert {1, 2, min(depth, 3)} <= {len(s) for s in kept}
    for history in ([], ["the"], list(next(iter(kept)))):
        assert sum(prob(history, x) for x in words) + prob(history, "\r unknown") == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("hot_share", [1e-4, 1e-1])
def test_suffix_tree_follows_words_far_back(spark, hot_share):
    """The word after a passage depends on the word before it: contexts of up to eight words are retained,
    and copies with changed words give contexts that are frequent but cannot grow."""
    passages = ["one two three four five", "a b a b a b", "x", "red green", "p q r s t u v"]
    rows = []
    for i in range(400):
        k = i * 7 % 11 % len(passages)
        start, end = (("left", "up"), ("right", "down"), ("left", "down"))[i % 3]
        noise = f"n{i % 37} m{i % 5}" if i % 2 else ""
        copy = " ".join(f"c{j}" if (i * 31 + j * 17) % 43 else f"e{i}" for j in range(30))
        rows.append((i, f"{noise} {start} {passages[k]} {end} {copy} {start} {passages[k]} {end}"))
    rows += [(1000 + i, "same words in every copy and nothing else " * 3) for i in range(30)]
    p = pst.PstParams(depth=10, hot_share=hot_share, block_bytes=4000, bucket_tokens=3000)
    want, kept, *_ = brute_tree(rows, p)
    assert {3, 6, 8} <= {len(s) for s in kept}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same_scores(pst.score(docs, remainder(F.col("doc_id"), 5) != 1, p).collect(), want)


def test_suffix_tree_beats_the_unigrams_on_held_out_texts(spark):
    rows = queries.QUERIES["op1_suffix_tree"](spark, SF01).where("held_out").collect()
    assert len(rows) > 100 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_suffix_tree_edge_cases(spark):
    docs = odd_docs(spark)
    rows = pst.score(docs, remainder(F.col("doc_id"), 5) != 1).collect()
    want, *_ = brute_tree(ODD, pst.PstParams())
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-6, abs=1e-6)
    assert pst.score(docs.limit(0), F.lit(True)).count() == 0
    nothing = pst.score(docs, F.lit(False)).collect()
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def zipf_docs(n, seed=1):
    """Independent words of uneven frequency: more text makes more contexts frequent."""
    rng = np.random.default_rng(seed)
    at = np.minimum(rng.zipf(1.4, n * 100), 600).reshape(n, 100)
    return [(i, " ".join(f"w{x}" for x in row)) for i, row in enumerate(at)]


@pytest.mark.parametrize("bucket_tokens, depth", [(400, 4), (4000, 2), (400, 1), (400, 0)])
def test_suffix_tree_with_hot_words_and_pairs(spark, bucket_tokens, depth):
    rows = zipf_docs(150) + [(1000 + i, "w1 w1 w1 w2 odd" + str(i) + " w1 w1") for i in range(200)]
    p = pst.PstParams(depth=depth, hot_share=0.0, block_bytes=6000, bucket_tokens=bucket_tokens)
    want, *_ = brute_tree(rows, p)
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.split())
    assert max(counts.values()) > bucket_tokens / 4 > min(counts.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same_scores(pst.score(docs, remainder(F.col("doc_id"), 5) != 1, p).collect(), want)


def test_suffix_tree_messages_grow_as_the_text(spark, monkeypatch):
    """Contexts of two words that become frequent as the text grows must not make it send more for each token."""
    sent = []

    def told(count):
        def run(requests, *args):
            kinds = [c for c, t in requests.dtypes if t == "binary"]
            sent.append(requests.agg(F.sum(sum((F.length(c) for c in kinds), F.lit(0)))).first()[0] or 0)
            return count(requests, *args)
        return run

    for name in ("count_pairs", "count_triples"):
        monkeypatch.setattr(pst, name, told(getattr(pst, name, None)), raising=False)
    totals = []
    for n in (1000, 5000):
        docs = spark.createDataFrame(zipf_docs(n), "doc_id long, text string").coalesce(1)
        assert pst.score(docs, F.lit(True), pst.PstParams(depth=2, block_bytes=60_000)).count() == n
        totals.append(sum(sent))
        sent.clear()
    assert 0 < totals[1] < 6 * totals[0]


def test_suffix_tree_bound_holds_for_every_extension():
    """No extension of a context that is said not to grow passes its test."""
    rng = np.random.default_rng(4)
    p, grows = pst.PstParams(), 0
    for _ in range(400):
        k = int(rng.integers(1, 12))
        count, q = rng.choice([1, 1, 1, 2, 3, 8, 20, 70], k), rng.random(k) ** 3 * 0.3 + 1e-5
        alive = pst._can_grow(np.zeros(k, np.int64), np.array([count.sum()]), count, q, np.ones(k, bool), p)[0]
        grows += alive
        for _ in range(60):
            kept = np.minimum(rng.binomial(count, rng.random(k) ** 2), count)
            n, x = kept.sum(), kept > 0
            if n >= p.least and not alive:
                assert (kept[x] * np.log((kept[x] - 1 + p.mass * q[x]) / ((n - 1 + p.mass) * q[x]))).sum() < p.divergence
    assert 50 < grows < 390
