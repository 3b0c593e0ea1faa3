"""Quality classifier: supervised subword embeddings.

Every word contributes itself and its character n-grams (with word marks), and each
pair of adjacent words its word bigram, all hashed into ``2**bits`` learned vectors. A
pair that stood among the ``recent`` words before adds a mark of its own, so repeated words and
phrases have a feature whatever their words are. A document is the
average of all these vectors, and a softmax over two classes follows. Training is
plain stochastic gradient descent in numpy on a bounded labelled sample;
scoring runs over all documents in Arrow batches. As average and output layer
are both linear, scoring needs one number per bucket: its vector's share of
the difference of the two class logits.

Defined cases: a null or empty text has no feature and gets the score of the
class bias; texts are never cut, however long; repeated rows score alike; an
empty table gives an empty result; without labels of both classes every text
gets the share of class 1 among the labels (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickwise.llm.common import (HASH_MUL, Words, labelled_sample, mix64, ragged, split_words,
                                 training_texts, with_text_columns)


REPEAT = 0                       # bucket of the mark of a pair seen shortly before


@dataclass(frozen=True)
class QualityParams:
    bits: int = 16               # 2**bits hashed vectors
    dim: int = 16
    n_grams: tuple[int, ...] = (3, 4, 5)
    recent: int = 16             # words within which a pair counts as repeated
    epochs: int = 5
    rate: float = 0.5
    max_docs: int = 3000         # bound of the labelled sample
    max_chars: int = 50_000      # longer texts are not training rows
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    logit: np.ndarray            # per bucket, float32
    bias: float
    params: QualityParams


def _whole(cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of whole words: a polynomial over their code points."""
    power = np.ones(int(lengths.max()) + 1, np.uint64)
    power[1:] = HASH_MUL
    power = np.cumprod(power, dtype=np.uint64)
    at = np.arange(len(cp)) - np.repeat(starts, lengths)
    return mix64(np.add.reduceat(cp * power[at], starts))


def pair_buckets(w: Words, p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every pair of adjacent words, and of the marks of repeated pairs."""
    if len(w.codes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cp = np.frombuffer("".join(f"<{x}>" for x in w.vocab).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(x) + 2 for x in w.vocab), np.int64, len(w.vocab))
    whole = _whole(cp, np.cumsum(lengths) - lengths, lengths)
    doc = w.doc_of
    first = np.flatnonzero(doc[1:] == doc[:-1])
    hashed = mix64(whole[w.codes[first]] * HASH_MUL + whole[w.codes[first + 1]])
    pair = np.zeros(len(doc), np.uint64)        # by position; the last word of a document has none
    pair[first] = hashed | np.uint64(1)
    again = np.zeros(len(doc), bool)
    for d in range(1, min(p.recent, len(doc) - 1) + 1):
        again[d:] |= (pair[d:] == pair[:-d]) & (doc[d:] == doc[:-d])
    again &= pair > 0
    return (np.concatenate([doc[first], doc[again]]),
            np.concatenate([(hashed >> np.uint64(64 - p.bits)).astype(np.int64), np.full(int(again.sum()), REPEAT)]))


def subword_buckets(words: list[str], p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, bucket) of every feature, grouped by word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = "".join(f"<{w}>" for w in words)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    whole = _whole(cp, starts, lengths)
    owners, hashes = [np.arange(len(words))], [whole]
    for n in p.n_grams:
        if len(cp) < n:
            continue
        inside = owner[: len(cp) - n + 1] == owner[n - 1:]
        gram = np.full(len(cp) - n + 1, n, np.uint64)
        for k in range(n):
            gram = gram * HASH_MUL + cp[k: len(cp) - n + 1 + k]
        owners.append(owner[: len(cp) - n + 1][inside])
        hashes.append(mix64(gram[inside]))
    who, what = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(who, kind="stable")
    return who[order], (what[order] >> np.uint64(64 - p.bits)).astype(np.int64)


def _document_features(texts: list[str], p: QualityParams) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, share of the document's features) of each text."""
    out = []
    for at in range(0, len(texts), 200):
        w = split_words(pa.array(texts[at:at + 200], pa.string()))
        who, bucket = subword_buckets(w.vocab, p)
        count = np.bincount(who, minlength=len(w.vocab))
        first = np.cumsum(count) - count
        doc, pairs = pair_buckets(w, p)
        order = np.argsort(doc, kind="stable")
        upto = np.searchsorted(doc[order], np.arange(len(w.offsets)))
        for i in range(len(w.offsets) - 1):
            codes = w.codes[w.offsets[i]:w.offsets[i + 1]]
            feats = np.concatenate([bucket[ragged(first[codes], count[codes])], pairs[order[upto[i]:upto[i + 1]]]])
            ids, n = np.unique(feats, return_counts=True)
            out.append((ids, (n / max(1, len(feats))).astype(np.float32)))
    return out


def train(rows: list[tuple[str, int]], p: QualityParams = QualityParams()) -> QualityModel:
    """Stochastic gradient descent over the labelled rows; deterministic for given rows."""
    y = np.array([t for _, t in rows], np.int64)
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return QualityModel(np.zeros(1 << p.bits, np.float32), float(np.log(share / (1 - share))), p)
    feats = _document_features([t for t, _ in rows], p)
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1 / p.dim, 1 / p.dim, (1 << p.bits, p.dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (p.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, total = 0, p.epochs * len(rows)
    scale = np.float32(40.0)     # an average of many vectors is small: scaled before the output layer
    for _ in range(p.epochs):
        for i in rng.permutation(len(rows)):
            rate = np.float32(p.rate * (1 - steps / total))
            steps += 1
            ids, share = feats[i]
            mean = scale * (share @ vectors[ids])
            z = mean @ out + bias
            e = np.exp(z - z.max())
            error = e / e.sum()
            error[y[i]] -= 1
            back = out @ error
            out -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.1 * error
            vectors[ids] -= (rate * scale * share)[:, None] * back[None, :]
    direction = out[:, 1] - out[:, 0]
    return QualityModel((scale * vectors @ direction).astype(np.float32), float(bias[1] - bias[0]), p)


def fit(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> QualityModel:
    """Fit on ``labels.quality``; rows whose crc32(doc_id) mod 3 is 1 are held out."""
    sample = labelled_sample(labels, "quality", 3, 1, p.max_docs)
    return train(training_texts(docs, sample, p.max_chars), p)


def score_words(w: Words, model: QualityModel) -> np.ndarray:
    """Probability of class 1 of every document of a slice."""
    who, bucket = subword_buckets(w.vocab, model.params)
    per_word = np.bincount(who, model.logit[bucket], len(w.vocab))
    n_word = np.bincount(who, minlength=len(w.vocab))
    doc, n = w.doc_of, len(w.offsets) - 1
    owner, pairs = pair_buckets(w, model.params)
    total = np.bincount(doc, per_word[w.codes], n) + np.bincount(owner, model.logit[pairs], n)
    feats = np.bincount(doc, n_word[w.codes], n) + np.bincount(owner, minlength=n)
    z = total / np.maximum(feats, 1) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (score >= 0.5) to every row.

    The model is sent as a broadcast of ``2**bits`` floats, a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        s = score_words(split_words(texts), shared.value)
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]

    return with_text_columns(docs, text_col, "score double, predicted int", compute, keep)
