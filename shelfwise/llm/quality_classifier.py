"""Quality scores by Bradley-Terry pairwise ranking.

Each text has a strength w . x of its features.  Of a good and a bad text the good
one wins with probability sigmoid(w . (x_good - x_bad)); w is fitted by Newton
steps to the logistic loss of such preference pairs, so only differences of
features count.  The score is the strength above a cut, squashed to 0..1; the cut
is a quantile of the labelled strengths: that of the share of bad texts.

Features are ratios of the whole text; they are written once (a few numbers a
document).  The fit uses every labelled row: rows are dealt into buckets of about
``BUCKET``, in which every good text meets every bad one; a Newton step sums over the
buckets, and only the sums reach the driver.  The cut is an exact order statistic of
all labelled strengths.

Defined results: null texts count as empty and get a score; with labels of one
class only, or none, every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import bound_batches, cut_lineage, held_out
from shelfwise.llm.labelled import labelled_ids, sigmoid
from shelfwise.llm.quality_rules import measures
from shelfwise.operators.selection import order_statistics

#: Labelled rows of a bucket, and how many of each class one has about at least.
BUCKET = 1024
LEAST = 64
RIDGE = 1e-3
STEPS = 30
#: A strength of so many spreads above the cut scores sigmoid(4).
SHARPNESS = 4.0

FEATURES = ("length", "short", "symbols", "many_symbols", "repeats", "many_repeats", "dup_lines", "many_dup_lines",
            "capitals", "many_capitals", "shouts", "bars", "word_length", "line_length", "digits")


def features(texts: list[str | None]) -> pd.DataFrame:
    """The features of some texts, a row each, every one between 0 and about 1."""
    texts = [t or "" for t in texts]
    m = measures(texts)
    n = m.n_words.clip(lower=1)
    out = pd.DataFrame(index=m.index)
    out["length"] = np.log1p(m.n_words) / 10
    out["short"] = (m.n_words < 10) * 1.0
    out["symbols"] = (m.n_symbols / n / 3).clip(upper=1)
    out["many_symbols"] = (m.n_symbols > 0.1 * n) * 1.0
    out["repeats"] = m.n_repeat_words / n
    out["many_repeats"] = (m.n_repeat_words > 0.2 * n) * 1.0
    out["dup_lines"] = m.n_dup_lines / m.n_lines.clip(lower=1)
    out["many_dup_lines"] = (m.n_dup_lines > 0.3 * m.n_lines) * 1.0
    out["capitals"] = m.n_capitals / m.n_letters.clip(lower=1)
    out["many_capitals"] = (m.n_capitals > 0.3 * m.n_letters) * 1.0
    out["shouts"] = (np.array([t.count("!") for t in texts]) / n / 2).clip(upper=1)
    out["bars"] = (np.array([t.count("|") for t in texts]) / n).clip(upper=1)
    out["word_length"] = (m.word_chars / n / 20).clip(upper=1)
    out["line_length"] = np.log1p(m.n_words / m.n_lines.clip(lower=1)) / 10
    out["digits"] = (np.array([sum(map(t.count, "0123456789")) for t in texts]) / m.word_chars.clip(lower=1)).clip(upper=1)
    return out[list(FEATURES)].astype(float)


def feature_columns(text: Column) -> Column:
    """The features of a text column as a struct of doubles."""
    @pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield features(list(texts))
    return made(text)


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, loss, slope and curvature of all pairs of a good and a bad row, summed;
    one after the other in one array."""
    margin = (good @ w)[:, None] - (bad @ w)[None, :]
    p = sigmoid(-margin)
    q = p * (1 - p)
    cross = good.T @ q @ bad
    slope = bad.T @ p.sum(axis=0) - good.T @ p.sum(axis=1)
    curve = (good.T * q.sum(axis=1)) @ good + (bad.T * q.sum(axis=0)) @ bad - cross - cross.T
    return np.concatenate([[margin.size, np.logaddexp(0, -margin).sum()], slope, curve.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Bradley-Terry weights by Newton steps on the mean logistic loss of the pairs whose
    ``pair_sums`` at some weights ``sums`` gives."""
    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        s = sums(w)
        mean = s[1:] / max(s[0], 1)
        return (float(mean[0] + RIDGE / 2 * w @ w), mean[1:1 + n] + RIDGE * w,
                mean[1 + n:].reshape(n, n) + RIDGE * np.eye(n))

    w = np.zeros(n)
    loss, slope, curve = at(w)
    for _ in range(STEPS):
        step, size = np.linalg.solve(curve, slope), 1.0
        new = at(w - step)
        while size > 1e-4 and new[0] > loss:
            size /= 2
            new = at(w - size * step)
        w = w - size * step
        loss, slope, curve = new
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit_strengths(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The weights from all pairs of some rows of good and of bad features."""
    return newton(lambda w: pair_sums(good, bad, w), good.shape[1])


def dealt(labelled: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """``bucket, good, bad``: every row of ``labelled`` (doc_id, features, y) in a bucket of
    about ``BUCKET`` rows, its features in a list of its class.  A class with fewer than
    ``LEAST`` rows for each bucket is dealt to several."""
    n = max(1, -(-(n_good + n_bad) // BUCKET))
    copies = {y: min(n, max(1, -(-LEAST * n // size))) for y, size in ((1, n_good), (0, n_bad))}
    turn = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1]).otherwise(copies[0]) - 1))
    rows = labelled.select("doc_id", "y", F.array(*FEATURES).alias("x"), turn.alias("turn"))
    rows = rows.withColumn("bucket", F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(n)) + F.col("turn"), F.lit(n)).cast("int"))
    lists = [F.sort_array(F.collect_list(F.when(F.col("y") == y, F.struct("doc_id", "x")))).alias(name) for name, y in (("good", 1), ("bad", 0))]
    return rows.groupBy("bucket").agg(*lists).select("bucket", F.flatten("good.x").alias("good"), F.flatten("bad.x").alias("bad"))


def fit(labelled: DataFrame) -> tuple[np.ndarray, float, float]:
    """Weights, cut and spread from all rows of ``labelled`` (doc_id, features, y)."""
    sizes = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(sizes) < 2:
        return np.zeros(len(FEATURES)), 0.0, 1.0
    buckets = cut_lineage(dealt(labelled, sizes[1], sizes[0]))

    def sums(w: np.ndarray) -> np.ndarray:
        def of_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = np.zeros(2 + len(w) + len(w) ** 2)
            for batch in batches:
                for good, bad in zip(batch["good"], batch["bad"]):
                    whole += pair_sums(*[np.asarray(x, dtype=float).reshape(-1, len(w)) for x in (good, bad)], w)
            yield pd.DataFrame({"sums": [whole.tolist()]})

        # a row of sums for each partition
        found = buckets.select("good", "bad").mapInPandas(of_part, "sums array<double>").collect()
        return np.sum([r["sums"] for r in found], axis=0)

    w = newton(sums, len(FEATURES))
    strengths = labelled.select(strength_of(w).alias("strength"))
    # as many strengths lie below the cut as there are bad texts
    ranks = [sizes[0] - 1, sizes[0]]
    found = order_statistics(strengths, "strength", ranks)
    spread = strengths.agg(F.stddev_pop("strength")).first()[0]
    return w, (found[ranks[0]] + found[ranks[1]]) / 2, max(spread, 1e-9)


def strength_of(w: np.ndarray) -> Column:
    return sum((F.col(f) * F.lit(float(x)) for f, x in zip(FEATURES, w)), F.lit(0.0))


def scores(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), feature_columns(F.col(text_col)).alias("f")).select("doc_id", "f.*")
    rows = cut_lineage(rows)
    chosen = labelled_ids(labels, label)
    labelled = rows.join(chosen, rows.doc_id == chosen.fit_id).select("doc_id", *FEATURES, "y")
    w, cut, spread = fit(cut_lineage(labelled.dropDuplicates()))
    score = 1 / (1 + F.exp(-F.lit(SHARPNESS / spread) * (strength_of(w) - F.lit(cut))))
    scored = rows.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
