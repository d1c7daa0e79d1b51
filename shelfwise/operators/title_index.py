"""An inverted list of character q-grams for fuzzy search.

A title can only reach a threshold if it shares enough q-grams with the query.  Let n
be the length of the shorter string, w that of the window it is compared with, and L
characters in common, so that the score is 200 L / (n + w).  Every one of the n - L
characters of the shorter string that find no partner spoils at most q of its n - q + 1
q-grams, and every one of the w - L characters of the window that stand between partners
at most q - 1.  The least that is left, over all windows whose score reaches the
threshold, is a number of q-grams that the two strings must share (counting repeats).

Where that number is large enough, the pairs come from an equi-join of the query's and the
titles' q-grams, counted per pair with partial sums; a very common q-gram is a skewed
join key, which adaptive execution splits.  Only pairs that share enough are scored, in
Arrow batches.  Short strings have no bound worth a join (``ENOUGH``): titles or queries of
such lengths are compared in blocks.  No match is lost either way.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import text

#: Lengths of q-grams that may be used; a query takes the first with a bound of at least ``ENOUGH``, else the last.
SIZES = (3, 2)
ENOUGH = 3
#: Lengths up to which bounds are tabulated; the bounds do not fall beyond.
LONGEST = 512


@cache
def shared_grams(length: int, threshold: int, q: int) -> int:
    """How many q-grams a shorter string of this length shares at least with whatever
    it scores ``threshold`` with."""
    least = length - q + 1
    for window in range(1, length + 1):
        # scores are rounded half to even: half a point below may do
        common = max(0, math.ceil((threshold - 0.5) / 200 * (length + window) - 1e-9))
        if common <= window:
            least = min(least, length - q + 1 - q * (length - common) - (q - 1) * (window - common))
    return least


def bound(length: Column, threshold: int, q: int) -> Column:
    """``shared_grams`` of a column of lengths."""
    table = F.from_json(F.lit(json.dumps([shared_grams(n, threshold, q) for n in range(LONGEST + 1)])), "array<int>")
    return F.element_at(table, F.least(length, F.lit(LONGEST)) + 1)


def shortest_indexed(threshold: int) -> int:
    """The least length from which on every length has a bound of at least ``ENOUGH``;
    beyond ``LONGEST`` if there is none."""
    return max((n + 1 for n in range(LONGEST + 1) if shared_grams(n, threshold, SIZES[-1]) < ENOUGH), default=0)


def grams(c: Column, q: int) -> Column:
    """The q-grams of a string that has any, as an array."""
    return F.transform(F.sequence(F.lit(1), F.length(c) - q + 1), lambda i: F.substring(c, i, q))


def _counted(rows: DataFrame, key: str, kept: list[str], q: int) -> DataFrame:
    """Every string's q-grams with their numbers."""
    long = rows.where(F.length("s") >= q).select(key, *kept, F.explode(grams(F.col("s"), q)).alias("gram"))
    return long.groupBy(key, *kept, "gram").agg(F.count(F.lit(1)).alias("n"))


def candidates(queries: DataFrame, titles: DataFrame, threshold: int, shortest: int) -> DataFrame:
    """Pairs (q_id, t_id) of which both strings have at least ``shortest`` characters
    and that share as many q-grams as they must.  ``queries``: (q_id, s); ``titles``: (t_id, s)."""
    asked = queries.where(F.length("s") >= shortest).withColumn("size", F.length("s"))
    found = None
    for q in SIZES:
        # a query uses one size: the longest grams that still bound it well
        own = bound(F.col("size"), threshold, q) >= ENOUGH
        taken = F.lit(False)
        for longer in SIZES[:SIZES.index(q)]:
            taken = taken | (bound(F.col("size"), threshold, longer) >= ENOUGH)
        mine = asked.where(~taken & own if q != SIZES[-1] else ~taken)
        left = _counted(mine, "q_id", ["size"], q)
        right = _counted(titles.where(F.length("s") >= shortest).withColumn("t_size", F.length("s")), "t_id", ["t_size"], q)
        met = left.join(right.withColumnRenamed("n", "t_n"), "gram").groupBy("q_id", "t_id", "size", "t_size").agg(
            F.sum(F.least("n", "t_n")).alias("shared"))
        need = bound(F.least("size", "t_size"), threshold, q)
        # a title shorter than its query may have no bound in these q-grams
        met = met.where((F.col("shared") >= need) & (need > 0)).select("q_id", "t_id")
        part = met
        if q != SIZES[-1]:
            # titles that the longer q-grams do not bound, but the shorter ones do
            weak = titles.where((F.length("s") >= shortest) & (bound(F.length("s"), threshold, q) <= 0)).withColumn("t_size", F.length("s"))
            low = SIZES[-1]
            again = _counted(mine, "q_id", ["size"], low).join(_counted(weak, "t_id", ["t_size"], low).withColumnRenamed("n", "t_n"), "gram")
            again = again.groupBy("q_id", "t_id", "size", "t_size").agg(F.sum(F.least("n", "t_n")).alias("shared"))
            short = F.col("t_size") < F.col("size")
            part = part.union(again.where(short & (F.col("shared") >= bound(F.col("t_size"), threshold, low))).select("q_id", "t_id"))
        found = part if found is None else found.union(part)
    return found


def scored(pairs: DataFrame, scorer: str, threshold: int) -> DataFrame:
    """The rows of ``pairs`` (q, t, ...) that score at least ``threshold``, with ``score``."""
    kind = pairs.withColumn("score", F.lit(0)).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = pd.Series(batch.column("q").to_pylist(), dtype=object)
            names = np.array(batch.column("t").to_pylist(), dtype=object)
            at, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for q, rows in asked.groupby(asked, sort=False).indices.items():
                hit, value = text.matches(scorer, q, text.Texts(names[rows].tolist()), threshold)
                at.append(rows[hit])
                scores.append(value)
            at = np.concatenate(at)
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.concatenate(scores), pa.int32())], names=[*kept.schema.names, "score"])

    return pairs.mapInArrow(score, kind)
