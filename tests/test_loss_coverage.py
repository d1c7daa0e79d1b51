"""The implicit loss by Gram matrices and coverage by bitmaps, against plain definitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import coverage_bitmaps as cb
from shelfwise.operators import evaluation as ev
from shelfwise.operators.implicit_loss import gram, implicit_loss

FACTOR = "{} bigint, features array<float>"
CELL = "item_id bigint, user_id bigint, rating double"


def _plain_loss(users, items, cells, alpha, reg):
    rated = {(u, i): r for i, u, r in cells if None not in (i, u, r)}
    dot = lambda a, b: math.fsum(x * y for x, y in zip(a, b))
    every_user, every_item = users.keys() | {u for u, _ in rated}, items.keys() | {i for _, i in rated}
    loss = 0.0
    for u in every_user:
        for i in every_item:
            s = dot(users[u], items[i]) if u in users and i in items else 0.0
            r = rated.get((u, i), 0.0)
            loss += (1 + alpha * abs(r)) * ((1.0 if r > 0 else 0.0) - s) ** 2
    for (u, i), r in rated.items():
        if r > 0:
            loss += reg * (dot(users.get(u, []), users.get(u, [])) + dot(items.get(i, []), items.get(i, [])))
    return loss


@pytest.mark.parametrize("seed", [1, 2])
def test_loss_equals_all_pairs(spark, seed):
    rnd = random.Random(seed)
    vector = lambda: [rnd.randint(-8, 8) / 8 for _ in range(5)]
    users, items = {u: vector() for u in range(9)}, {i: vector() for i in range(100, 113)}
    pairs = {(rnd.choice(list(items)), rnd.choice(list(users))) for _ in range(40)}
    cells = [(i, u, float(rnd.choice([-2, 0, 1, 5]))) for i, u in pairs]
    cells += [(100, 77, 3.0), (900, 1, 2.0), (None, 1, 1.0), (101, None, 1.0), (102, 1000, None)]
    got = implicit_loss(spark.createDataFrame(list(users.items()), FACTOR.format("user_id")).repartition(3),
                        spark.createDataFrame(list(items.items()), FACTOR.format("item_id")).repartition(4),
                        spark.createDataFrame(cells, CELL), 1.5, 0.2).collect()
    assert len(got) == 1 and (got[0].n_users, got[0].n_items) == (9, 13)
    assert got[0].loss == pytest.approx(_plain_loss(users, items, cells, 1.5, 0.2), rel=1e-9)


def test_loss_of_empty_tables(spark):
    users = spark.createDataFrame([], FACTOR.format("user_id"))
    items = spark.createDataFrame([(1, [1.0])], FACTOR.format("item_id"))
    r = implicit_loss(users, items, spark.createDataFrame([], CELL), 1.0, 1.0).first()
    assert (r.n_users, r.n_items, r.all_pairs, r.cells_part, r.penalty, r.loss) == (0, 1, 0.0, 0.0, 0.0, 0.0)
    r = implicit_loss(users, items, spark.createDataFrame([(1, 5, 2.0)], CELL), 1.0, 1.0).first()
    assert r.cells_part == 3.0  # a user without factors scores 0


def test_gram_leaves_null_rows_out(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])], FACTOR.format("user_id"))
    assert {(r.row, r.col): r.value for r in gram(rows).collect()} == {(0, 0): 10, (0, 1): 14, (1, 0): 14, (1, 1): 20}


REC = "recommender string, user_id bigint, rank bigint, item_id bigint"


def test_bitmap_coverage_equals_distinct_counts(spark):
    rnd = random.Random(3)
    recs = [(rnd.choice("ab"), u, k, rnd.choice([rnd.randrange(70_000), 5])) for u in range(200) for k in range(1, 9)]
    recs += [("a", 1, 1, None), ("a", 1, None, 3), ("a", 1, 2, 10**12)]  # null item, null rank, outside the catalog
    lists = spark.createDataFrame(recs, REC)
    places = spark.range(70_000).select(F.col("id").alias("matrix_idx"), F.col("id").alias("item_id"))
    ks = (1, 3, 8)
    bits = cb.item_bitmaps(lists, places, ks)
    got = {(r.recommender, r.k): (r.n_distinct, r.catalog_coverage) for r in cb.bitmap_coverage(bits, 70_000, ["a", "b", "c"], ks).collect()}
    for name in "abc":
        for k in ks:
            n = len({i for r, _, rank, i in recs if r == name and rank is not None and rank <= k and i is not None and i < 70_000})
            assert got[name, k] == (n, n / 70_000)
    known = lists.where("item_id < 70000 and rank is not null")
    plain = {r.recommender: r.catalog_coverage for r in ev.coverage(known, 70_000, 8, ["a", "b", "c"]).collect()}
    assert {name: got[name, 8][1] for name in "abc"} == plain


def test_bitmaps_of_runs_merge(spark):
    places = spark.range(40_000).select(F.col("id").alias("matrix_idx"), F.col("id").alias("item_id"))
    first = spark.createDataFrame([("a", 1, 1, 0), ("a", 1, 2, 39_999)], REC)
    second = spark.createDataFrame([("a", 2, 1, 0), ("a", 2, 2, 7)], REC)
    runs = cb.item_bitmaps(first, places, [2]).unionByName(cb.item_bitmaps(second, places, [2]))
    assert cb.bitmap_coverage(cb.merged_bitmaps(runs), 40_000, ["a"], [2]).first().n_distinct == 3


def test_bitmap_coverage_without_lists_or_catalog(spark):
    places = spark.createDataFrame([], "matrix_idx bigint, item_id bigint")
    bits = cb.item_bitmaps(spark.createDataFrame([], REC), places, [1])
    assert [tuple(r) for r in cb.bitmap_coverage(bits, 0, ["a"], [1]).collect()] == [("a", 1, 0, 0.0)]
    with pytest.raises(ValueError):
        cb.item_bitmaps(spark.createDataFrame([], REC), places, [])
