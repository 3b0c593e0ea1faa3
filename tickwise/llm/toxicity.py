"""Toxicity: counterfactual-regularised linear classifier.

A logistic model over the presence of hashed words and word beginnings (lower
case, without edge punctuation; the beginnings catch inflected forms). Sentences of the labelled sample
that mention an identity group are paired with copies in which the term is
swapped for others of the list and for a neutral word; the squared change of
the logit is added to the loss, so the model does not learn that a mere mention
of a group is toxic. Weights are fitted by FTRL-proximal steps (adaptive rates,
L1), which keeps the weights of uninformative words at zero.

Defined cases: a null or empty text gets the bias' score; texts are never cut;
repeated rows score alike; an empty table gives an empty result; without labels
of both classes the score is the share of toxic labels (0.5 without labels).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tickwise.llm.common import (Words, bare, labelled_sample, split_words, training_texts,
                                 with_text_columns)

# Identity terms that are exchanged for each other, by language, and a neutral word.
IDENTITY_TERMS = {
    "en": "women men girls boys muslims christians jews hindus buddhists atheists immigrants refugees "
          "foreigners gays lesbians transgender blacks whites asians africans europeans americans "
          "mexicans chinese arabs disabled elderly muslim christian jewish gay lesbian black white "
          "asian african immigrant refugee woman man".split(),
    "fr": "femmes hommes musulmans chrétiens juifs immigrés réfugiés étrangers arabes noirs blancs "
          "handicapés homosexuels femme homme musulman juif immigré".split(),
    "de": "frauen männer muslime christen juden einwanderer flüchtlinge ausländer araber schwarze "
          "weiße behinderte homosexuelle frau mann muslim jude".split(),
    "es": "mujeres hombres musulmanes cristianos judíos inmigrantes refugiados extranjeros árabes "
          "negros blancos discapacitados homosexuales mujer hombre musulmán judío inmigrante".split(),
}
NEUTRAL = {"en": "people", "fr": "gens", "de": "leute", "es": "gente"}


@dataclass(frozen=True)
class ToxicityParams:
    bits: int = 18
    beginnings: tuple[int, ...] = (4, 5)
    epochs: int = 6
    alpha: float = 0.5           # step size of the adaptive rates
    l1: float = 5.0
    l2: float = 0.1
    pair_weight: float = 1.0     # weight of the counterfactual penalty
    swaps: int = 3               # counterfactuals for each mention, besides the neutral one
    max_docs: int = 5000         # bound of the labelled sample
    max_chars: int = 50_000      # longer texts are not training rows
    seed: int = 11


@dataclass(frozen=True)
class ToxicityModel:
    weight: np.ndarray           # float32 per bucket
    bias: float
    params: ToxicityParams


def _buckets(words: list[str], p: ToxicityParams) -> np.ndarray:
    """(words, 1 + beginnings) bucket numbers; a beginning that is the whole word is the word itself."""
    shift, cuts = 64 - p.bits, p.beginnings
    out = np.empty((len(words), 1 + len(cuts)), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, w in enumerate(words):
        b = bare(w) or w
        whole = out[i, 0] = digest(b, 1) >> shift
        for j, n in enumerate(cuts, 1):
            out[i, j] = digest(b[:n], 2) >> shift if len(b) > n else whole
    return out


def _presence(words: Words, p: ToxicityParams, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every distinct bucket of a document; of ``live`` buckets only, if given."""
    table = _buckets(words.vocab, p)
    keys = []
    for column in table.T:
        if live is None:
            keys.append(words.doc_of * (1 << p.bits) + column[words.codes])
        else:  # a bucket without weight cannot change a score
            at = np.flatnonzero(live[column][words.codes])
            keys.append(words.doc_of[at] * (1 << p.bits) + column[words.codes[at]])
    key = np.unique(np.concatenate(keys))
    return key >> p.bits, key & ((1 << p.bits) - 1)


_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def counterfactual_pairs(text: str, p: ToxicityParams) -> list[tuple[list[str], list[str]]]:
    """(words of a sentence, words with one identity term swapped) for each mention."""
    pairs = []
    for sentence in _SENTENCE.findall(text):
        words = [bare(w) or w for w in sentence.split()]
        for lang, terms in IDENTITY_TERMS.items():
            for at, w in enumerate(words):
                if w in terms:
                    k = terms.index(w)
                    others = [terms[(k + 1 + j * 7) % len(terms)] for j in range(p.swaps)]
                    for other in [NEUTRAL[lang], *(o for o in others if o != w)]:
                        pairs.append((words, [*words[:at], other, *words[at + 1:]]))
    return pairs


class _Ftrl:
    """Per-coordinate adaptive steps with L1 and L2."""

    def __init__(self, size: int, p: ToxicityParams):
        self.z, self.n, self.p = np.zeros(size), np.zeros(size), p

    def weights(self, ids: np.ndarray) -> np.ndarray:
        z, n, p = self.z[ids], self.n[ids], self.p
        w = -(z - np.sign(z) * p.l1) / ((1.0 + np.sqrt(n)) / p.alpha + p.l2)
        return np.where(np.abs(z) <= p.l1, 0.0, w)

    def step(self, ids: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        n = self.n[ids]
        square = n + gradient * gradient
        self.z[ids] += gradient - (np.sqrt(square) - np.sqrt(n)) / self.p.alpha * w
        self.n[ids] = square


def train(rows: list[tuple[str, int]], p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Deterministic for given rows; the bias is the last coordinate, without L1."""
    y = np.array([t for _, t in rows], np.float64)
    size = 1 << p.bits
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(size, np.float32), float(np.log(share / (1 - share))), p)
    feats = []
    for at in range(0, len(rows), 500):
        part = [t for t, _ in rows[at:at + 500]]
        doc, bucket = _presence(split_words(pa.array(part, pa.string())), p)
        cuts = np.searchsorted(doc, np.arange(len(part) + 1))
        feats += [bucket[cuts[i]:cuts[i + 1]] for i in range(len(part))]
    pairs = []
    for text, _ in rows:
        for a, b in counterfactual_pairs(text, p):
            fa, fb = (np.unique(_buckets(x, p)) for x in (a, b))
            gone, come = np.setdiff1d(fa, fb), np.setdiff1d(fb, fa)
            if len(gone) or len(come):
                pairs.append((np.concatenate([gone, come]),
                              np.concatenate([np.ones(len(gone)), -np.ones(len(come))])))
    model = _Ftrl(size, p)
    bias = float(np.log(y.mean() / (1 - y.mean())))
    rng = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        order = rng.permutation(len(rows) + len(pairs))
        for i in order:
            if i < len(rows):
                ids = feats[i]
                w = model.weights(ids)
                error = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -50, 50))) - y[i]
                model.step(ids, w, np.full(len(ids), error))
                bias -= 0.01 * error
            else:
                ids, sign = pairs[i - len(rows)]
                w = model.weights(ids)
                model.step(ids, w, p.pair_weight * 2 * (sign @ w) * sign)
    return ToxicityModel(model.weights(np.arange(size)).astype(np.float32), bias, p)


def fit(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on ``labels.toxic``; rows whose crc32(doc_id) mod 5 is 0 are held out."""
    sample = labelled_sample(labels, "toxic", 5, 0, p.max_docs)
    return train(training_texts(docs, sample, p.max_chars), p)


def score_words(w: Words, model: ToxicityModel) -> np.ndarray:
    doc, bucket = _presence(w, model.params, model.weight != 0)
    z = model.bias + np.bincount(doc, model.weight[bucket], len(w.offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1, higher: toxic) and ``predicted`` to every row; the broadcast
    model has ``2**bits`` floats, a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        s = score_words(split_words(texts), shared.value)
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]

    return with_text_columns(docs, text_col, "score double, predicted int", compute, keep)
