"""Exact order statistics by narrowing a histogram (A8): no sort, no shuffle of values.

A pass counts the values of the intervals that still hold a wanted rank in ``BINS`` equal
bins, with each bin's least and largest value.  A rank that is the first or last of its
bin, or whose bin has one value, is known; the others go on with their bin's own range.
A pass shuffles and returns at most ranks x BINS rows, whatever the number of values, and
a bin never holds both ends of its interval, so every pass makes progress: about one for
each factor BINS between the range and the gaps around the rank.

Nulls and NaN take no part; infinities are bins of their own.  Values are compared as
doubles.  No values: every statistic is null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

BINS = 4096


def _bin(v: Column, lo: float, hi: float, bins: int) -> Column:
    # halves keep the difference of the largest doubles finite
    part = (v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) if hi / 2 > lo / 2 else F.lit(0.0)
    inner = F.greatest(F.lit(0), F.least(F.floor(part * bins), F.lit(bins - 1)))
    return F.when(v <= lo, 0).when(v >= hi, bins - 1).otherwise(inner).cast("int")


def _numbers(values: DataFrame, col: str) -> DataFrame:
    # written once: every pass reads it
    c = F.col(col).cast("double")
    return cut_lineage(values.select(c.alias("v")).where(c.isNotNull() & ~F.isnan(c)))


def _settle(bins: list, start: int, wanted: Sequence[int], known: dict[int, float]) -> list[tuple]:
    """Enters the ranks that the bins (rows of bin, n, lo, hi) of the values from rank
    ``start`` on give away into ``known``; returns the bins that hold the others."""
    narrower = []
    for b in sorted(bins, key=lambda b: b.bin):
        inside, last = [], start + b.n - 1
        for k in wanted:
            if k == start or (b.lo == b.hi and start <= k <= last):
                known[k] = b.lo
            elif k == last:
                known[k] = b.hi
            elif start < k < last:
                inside.append(k)
        if inside:
            narrower.append((start, b.lo, b.hi, inside))
        start += b.n
    return narrower


def _select(data: DataFrame, ranks: Callable[[int], Sequence[int]], bins: int) -> tuple[int, dict[int, float]]:
    if bins < 2:
        raise ValueError("two bins at least")
    v, known = F.col("v"), {}
    about = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    kind = F.when(v == -math.inf, -1).when(v == math.inf, 1).otherwise(0)
    found = data.groupBy(kind.alias("bin")).agg(*about).collect()
    n = sum(b.n for b in found)
    open_ = _settle(found, 0, sorted(set(ranks(n))), known)
    while open_:
        interval, place = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (_, lo, hi, _) in enumerate(open_):
            inside = v.between(lo, hi)
            interval, place = F.when(inside, i).otherwise(interval), F.when(inside, _bin(v, lo, hi, bins)).otherwise(place)
        counted = (data.select("v", interval.alias("interval"), place.alias("bin")).where("interval is not null")
                   .groupBy("interval", "bin").agg(*about).collect())
        open_ = [narrower for i, (start, _, _, wanted) in enumerate(open_)
                 for narrower in _settle([b for b in counted if b.interval == i], start, wanted, known)]
    return n, known


def order_statistics(values: DataFrame, col: str, ranks: Sequence[int], bins: int = BINS) -> dict[int, float]:
    """The values at 0-based ``ranks`` of the sorted values of ``col``, by rank; ranks
    outside them are left out."""
    return _select(_numbers(values, col), lambda n: ranks, bins)[1]


def exact_quantiles(values: DataFrame, col: str, probabilities: Sequence[float], bins: int = BINS) -> DataFrame:
    """``probability, value``: quantiles interpolated between the two nearest values
    (the median of an even number is the mean of the middle two)."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    nearest = lambda n: [f(p * (n - 1)) for p in probabilities for f in (math.floor, math.ceil)]
    n, known = _select(_numbers(values, col), nearest, bins)

    def value(p):
        place = p * (n - 1)
        lo, hi = known[math.floor(place)], known[math.ceil(place)]
        return lo if lo == hi else lo + (hi - lo) * (place - math.floor(place))

    rows = [(float(p), value(p) if n else None) for p in probabilities]
    return values.sparkSession.createDataFrame(rows, "probability double, value double")
