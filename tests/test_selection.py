"""Order statistics by narrowing histograms, against sorting."""

import math
import random

import pytest

from shelfwise.operators.selection import exact_quantiles, order_statistics


def _table(spark, values):
    return spark.createDataFrame([(x,) for x in values], "x double").repartition(3)


CASES = {
    "small integers": [float(x) for x in [5, 1, 1, 2, 9, 9, 9, 0, 3]],
    "one value many times": [7.5] * 40,
    "exponents far apart": [10.0**e for e in range(-12, 13)] + [-(10.0**e) for e in range(-3, 4)],
    "infinities": [-math.inf, -math.inf, 1.0, 2.0, 3.0, math.inf],
    "largest doubles": [-1.7e308, -1.0, 0.0, 1.0, 1.7e308],
    "smallest doubles": [0.0, 5e-324, 1e-323, 1.5e-323],
}


@pytest.mark.parametrize("name", CASES)
def test_every_rank(spark, name):
    values = CASES[name]
    got = order_statistics(_table(spark, values + [None, math.nan]), "x", range(-1, len(values) + 2), bins=8)
    assert got == dict(enumerate(sorted(values)))


def test_many_values_few_bins(spark):
    rnd = random.Random(4)
    values = [rnd.gauss(0, 1) ** 5 for _ in range(3000)]
    ranks = [0, 1, 2, 749, 1499, 1500, 2998, 2999]
    ordered = sorted(values)
    assert order_statistics(_table(spark, values), "x", ranks, bins=16) == {k: ordered[k] for k in ranks}


def test_quantiles_are_interpolated(spark):
    got = {r.probability: r.value for r in exact_quantiles(_table(spark, [1.0, 2.0, 4.0, 8.0]), "x", [0, 0.25, 0.5, 1]).collect()}
    assert got == {0.0: 1.0, 0.25: 1.75, 0.5: 3.0, 1.0: 8.0}


def test_no_values(spark):
    assert exact_quantiles(_table(spark, [None, math.nan]), "x", [0.5]).first().value is None
    assert order_statistics(_table(spark, []), "x", [0]) == {}


def test_wrong_arguments(spark):
    with pytest.raises(ValueError):
        exact_quantiles(_table(spark, [1.0]), "x", [1.5])
    with pytest.raises(ValueError):
        order_statistics(_table(spark, [1.0]), "x", [0], bins=1)
