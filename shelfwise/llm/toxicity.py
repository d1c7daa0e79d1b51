"""Toxicity scores by a counterfactually regularised classifier.

A logistic model on the presence of words and word beginnings.  Every identity term in
a labelled text is swapped for another of its kind and for a neutral word; besides the
loss on the labels, the fit is penalised for the change of the text's score (its log
odds) under each swap, so that naming a group does not by itself make a text toxic.

Spark counts every feature's texts by class in the labelled sample and keeps the
``VOCABULARY`` most telling ones; the fit runs on the presence of these in at most
``MAX_FIT`` labelled texts of a class.  Scoring is one narrow pass over all texts.

Defined results: null and empty texts have no features and get the score of the
intercept; without labels of both classes every score is the share of toxic ones
(0 without any); very long texts are scored whole; a text with several labels has the
largest; repeated rows and null ids get a row each; of features that tell alike the
first by name are kept; columns besides the two are not read; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import bound_batches, cut_lineage, held_out
from shelfwise.llm.labelled import MAX_FIT, fit_rows, sigmoid

#: Words that name groups, by kind; within a kind they are swapped.
IDENTITY_TERMS = {
    "gender": ("men", "women", "man", "woman", "male", "female", "transgender", "nonbinary"),
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"),
    "ethnicity": ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
    "age": ("young", "old", "elderly", "teenage"),
    "ability": ("disabled", "deaf", "blind", "autistic"),
    "origin": ("immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners"),
}
PUNCTUATION = ".,;:!?\"'()[]{}<>%*#$&|-_/\\"
BEGINNINGS = (4, 5, 6, 7, 8)
VOCABULARY = 1500
MIN_TEXTS = 4
RIDGE = 2e-4
#: Weight of the penalty on score changes under swaps.
COUNTERFACTUAL = 1.0
STEPS = 400
KNOWN_WORDS = 400_000
THRESHOLD = 0.7


def word_features(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings."""
    word = word.strip(PUNCTUATION)
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)] if word else []


class Presence:
    """Numbers of the vocabulary's features that a text holds."""

    def __init__(self, vocabulary: list[str]):
        self.number = {f: i for i, f in enumerate(vocabulary)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> list[int]:
        return self.of_words(set((text or "").lower().split()))

    def of_words(self, words: set[str]) -> list[int]:
        held, known, number = set(), self.known, self.number
        for w in words:
            ids = known.get(w)
            if ids is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                ids = known[w] = tuple(number[f] for f in word_features(w) if f in number)
            if ids:
                held.update(ids)
        return sorted(held)


def text_features(text: Column) -> Column:
    """The different features of a text."""
    @pandas_udf("array<string>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([list({f for w in set((t or "").lower().split()) for f in word_features(w)}) for t in texts], dtype=object)
    return made(text)


def telling_features(labelled: DataFrame, size: int = VOCABULARY, min_texts: int = MIN_TEXTS) -> list[str]:
    """The features of the labelled texts (text, y, weight) that tell most: by the
    log-likelihood ratio of feature and class."""
    held = labelled.select("y", "weight", F.explode(text_features(F.col("text"))).alias("feature"))
    side = lambda y: F.sum(F.when(F.col("y") == y, F.col("weight")).otherwise(0.0))
    counts = held.groupBy("feature").agg(F.count(F.lit(1)).alias("texts"), side(1).alias("a"), side(0).alias("b"))
    total = labelled.agg(side(1).alias("t1"), side(0).alias("t0")).first()
    t1, t0 = float(total["t1"] or 0), float(total["t0"] or 0)
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    has, c, a, b = F.col("a") + F.col("b"), t1 + t0, F.col("a"), F.col("b")
    tells = (part(a, has * t1 / c) + part(b, has * t0 / c) + part(F.lit(t1) - a, (F.lit(c) - has) * t1 / c)
             + part(F.lit(t0) - b, (F.lit(c) - has) * t0 / c))
    best = counts.where(F.col("texts") >= min_texts).withColumn("tells", F.round(tells, 9))
    return [r["feature"] for r in best.orderBy(F.desc("tells"), "feature").limit(size).collect()]


KIND_OF = {t: terms for terms in IDENTITY_TERMS.values() for t in terms}
#: What a term is swapped for besides another of its kind.
NEUTRAL = "person"


def swapped_words(words: set[str]) -> list[set[str]]:
    """The counterfactuals of a text's words: each identity term in it swapped for the
    next one of its kind, and for a neutral word."""
    out = []
    for w in sorted(words):
        term = w.strip(PUNCTUATION)
        if term in KIND_OF:
            kind = KIND_OF[term]
            rest = {x for x in words if x.strip(PUNCTUATION) != term}
            out += [rest | {kind[(kind.index(term) + 1) % len(kind)]}, rest | {NEUTRAL}]
    return out


class Rows:
    """Texts as lists of features."""

    def __init__(self, features: list[list[int]], n: int):
        self.n, self.size = n, len(features)
        self.cols = np.concatenate([np.array(f, dtype=np.int64) for f in features]) if features else np.zeros(0, np.int64)
        self.rows = np.repeat(np.arange(len(features)), [len(f) for f in features]).astype(np.int64)
        self.longest = max((len(f) for f in features), default=0)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=w[self.cols], minlength=self.size)

    def back(self, err: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, weights=err[self.rows], minlength=self.n)


def fit(features: list[list[int]], y: np.ndarray, weight: np.ndarray, n: int, pairs: list[tuple[int, list[int]]],
        counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and intercept: accelerated gradient steps on the weighted logistic loss,
    the ridge, and the mean squared change of the score (as log odds, so that it counts
    where the score is near 0 or 1, too) over ``pairs`` of a text's number and the
    features of a counterfactual of it."""
    share = float((weight * y).sum() / max(weight.sum(), 1e-9)) if len(y) else 0.0
    if len(set(y.tolist())) < 2:
        return np.zeros(n), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    texts = Rows(features, n)
    of = np.array([i for i, _ in pairs], dtype=np.int64)
    other = Rows([f for _, f in pairs], n)
    each = counterfactual / max(1, len(pairs))
    # classes weigh alike, so that few toxic texts count; the intercept is set to the true share afterwards
    g = np.where(y == 1, weight / (weight * y).sum(), weight / (weight * (1 - y)).sum()) / 2
    differ = max((len(set(features[i]) ^ set(f)) for i, f in pairs), default=0)
    rate = 1.0 / (0.25 * max(texts.longest, 1) * 0.2 + RIDGE + 2 * counterfactual * differ)
    w, v, b, vb, before = np.zeros(n), np.zeros(n), 0.0, 0.0, np.inf
    for step in range(STEPS):
        push = step / (step + 3)
        look, look_b = w + push * v, b + push * vb
        z = texts.dot(look) + look_b
        loss = (g * (np.logaddexp(0, z) - y * z)).sum() + RIDGE / 2 * look @ look
        err = g * (sigmoid(z) - y)
        slope, slope_b = texts.back(err) + RIDGE * look, err.sum()
        if len(pairs):
            gap = z[of] - other.dot(look) - look_b
            loss += each * (gap * gap).sum()
            slope += 2 * each * (texts.back(np.bincount(of, weights=gap, minlength=len(y))) - other.back(gap))
        if loss > before * 1.5:
            rate, v, vb = rate / 2, v * 0, vb * 0
        before = min(before, loss)
        new, new_b = look - rate * slope, look_b - rate * slope_b
        v, vb, w, b = new - w, new_b - b, new, new_b
    return w, float(b)


def scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
           max_fit: int = MAX_FIT, vocabulary_size: int = VOCABULARY, min_texts: int = MIN_TEXTS,
           counterfactual: float = COUNTERFACTUAL) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.  The model has at most
    ``vocabulary_size`` features besides the identity terms, each of ``min_texts``
    labelled texts or more."""
    bound_batches(docs.sparkSession)
    chosen = fit_rows(labels, label, max_rows=max_fit)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at most 2 * max_fit ids: a bounded table to broadcast; copies of a text count once,
    # by their largest label, whatever row comes first
    labelled = plain.join(F.broadcast(chosen), plain.doc_id == chosen.fit_id).groupBy("text").agg(
        F.max(F.struct("y", "weight")).alias("best"), F.min("doc_id").alias("doc_id"))
    labelled = cut_lineage(labelled.select("doc_id", "text", "best.y", "best.weight"))
    vocabulary = telling_features(labelled, vocabulary_size, min_texts)
    vocabulary += [t for terms in IDENTITY_TERMS.values() for t in terms if t not in set(vocabulary)]

    @pandas_udf("array<int>")
    def present(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Presence(vocabulary)
        for texts in batches:
            yield pd.Series([held(t) for t in texts], dtype=object)

    @pandas_udf("array<array<int>>")
    def swapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Presence(vocabulary)
        for texts in batches:
            yield pd.Series([[held.of_words(x) for x in swapped_words(set((t or "").lower().split()))] for t in texts], dtype=object)

    rows = labelled.select("doc_id", "y", "weight", present("text").alias("ids"), swapped("text").alias("swaps"),
                           F.xxhash64("text").alias("h")).orderBy("doc_id", "h").toPandas()
    pairs = [(i, list(x)) for i, found in enumerate(rows["swaps"]) for x in found]
    w, b = fit([list(i) for i in rows["ids"]], rows["y"].to_numpy(float), rows["weight"].to_numpy(float), len(vocabulary), pairs, counterfactual)
    weights = w.tolist()

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Presence(vocabulary)
        for texts in batches:
            yield pd.Series(sigmoid(np.array([sum(weights[i] for i in held(t)) + b for t in texts])))

    out = plain.select("doc_id", held_out("doc_id").alias("held_out"), scored("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
