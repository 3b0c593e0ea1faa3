"""Headline sentiment (L1 placeholder, L2 model-backed) over a text table.

L1 is a constant struct per row. L2's lexicon model (word lists below, or given ones)
is a few array functions on the JVM. A real model can be passed to ``model_sentiment``:
``scorer(list[str]) -> list[(label, score)]``, built once per Python worker and called
on batches of whole texts.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ("positive", "negative", "neutral")
BATCH = 32


POSITIVE_WORDS = {"gain", "gains", "growth", "profit", "profits", "rise", "rises", "rally",
                  "beat", "beats", "strong", "record", "up", "surge", "improve", "improves",
                  "good", "great", "positive", "bullish", "upgrade", "outperform"}
NEGATIVE_WORDS = {"loss", "losses", "fall", "falls", "drop", "drops", "decline", "weak",
                  "miss", "misses", "down", "crash", "plunge", "cut", "cuts", "bad", "poor",
                  "negative", "bearish", "downgrade", "underperform", "risk", "lawsuit"}
_WORD = re.compile(r"[a-z]+")


def neutral_sentiment(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """L1: every text gets label neutral and scores (0, 0, 1); text preserved."""
    return texts.select("*", F.lit(0.0).alias("positive"), F.lit(0.0).alias("negative"),
                        F.lit(1.0).alias("neutral"), F.lit("neutral").alias("label"))


def lexicon_sentiment(texts: DataFrame, positive=frozenset(POSITIVE_WORDS), negative=frozenset(NEGATIVE_WORDS),
                      text_col: str = "text") -> DataFrame:
    """L2: share of lexicon hits among the words; the larger side wins, ties are neutral."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    hits = lambda lexicon: F.size(F.filter(words, lambda w: w.isin(*sorted(lexicon))))
    p, q, n = F.col("_pos"), F.col("_neg"), F.greatest(F.col("_words"), F.lit(1))
    counted = texts.withColumns({"_words": F.size(words), "_pos": hits(positive), "_neg": hits(negative)})
    return counted.withColumns({
        "positive": F.when(p > q, p / n).otherwise(0.0), "negative": F.when(q > p, q / n).otherwise(0.0),
        "neutral": F.when(p == q, 1.0 - (p + q) / n).otherwise(0.0),
        "label": F.when(p > q, "positive").when(q > p, "negative").otherwise("neutral")}).drop("_words", "_pos", "_neg")


def lexicon_scorer(batch: list[str]) -> list[tuple[str, float]]:
    """Share of lexicon hits among words; the larger side wins, ties neutral."""
    out = []
    for text in batch:
        words = _WORD.findall((text or "").lower())
        pos = sum(w in POSITIVE_WORDS for w in words)
        neg = sum(w in NEGATIVE_WORDS for w in words)
        total = max(len(words), 1)
        if pos > neg:
            out.append(("positive", pos / total))
        elif neg > pos:
            out.append(("negative", neg / total))
        else:
            out.append(("neutral", 1.0 - (pos + neg) / total))
    return out


def model_sentiment(texts: DataFrame, scorer_factory=lambda: lexicon_scorer,
                    batch_size: int = BATCH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """L2: id and text as they are, the winning label's score in its column, the other two 0."""
    def run(batches):
        scorer = scorer_factory()
        for pdf in batches:
            texts_ = pdf[text_col].fillna("").tolist()
            res = []
            for i in range(0, len(texts_), batch_size):
                res.extend(scorer(texts_[i:i + batch_size]))
            labels = [r[0] for r in res]
            scores = [float(r[1]) for r in res]
            yield pd.DataFrame({
                id_col: pdf[id_col], text_col: pdf[text_col],
                **{lab: [s if lb == lab else 0.0 for lb, s in zip(labels, scores)] for lab in LABELS},
                "label": labels})
    src = texts.select(F.col(id_col), F.col(text_col))
    schema = ", ".join([f"`{c}` {t}" for c, t in src.dtypes] + [f"{lab} double" for lab in LABELS] + ["label string"])
    return src.mapInPandas(run, schema)
