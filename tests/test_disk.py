"""What a query keeps on disk: blocks that are stored once, lines that are dealt once."""

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plan_guard import plan_of
from shelfwise import session
from shelfwise.operators import blocks, factorization, vector_knn
from shelfwise.operators import evaluation as ev
from shelfwise.operators import neighbors as nb
from shelfwise.sources import fixtures

CELL = "item_id bigint, user_id bigint, rating double"


def some_cells(seed=11, items=50, users=40):
    draw = random.Random(seed)
    return [(i, u, float(draw.randint(0, 5))) for i in range(items) for u in range(users) if draw.random() < 0.3]


def test_stored_lists_equal_shuffled_ones(spark, monkeypatch):
    """many ratings are written once; no rating is repeated for each block."""
    df = spark.createDataFrame(some_cells() + [(50, None, 3.0)], CELL)
    want = sorted(nb.item_neighbors(df, k=6).collect())
    monkeypatch.setattr(nb, "BLOCK_RATINGS", 100)
    monkeypatch.setattr(nb, "STORED_RATINGS", 90, raising=False)
    monkeypatch.setattr(blocks, "PART_QUERIES", 20, raising=False)
    assert sorted(nb.item_neighbors(df, k=6).collect()) == want
    assert "Generate" not in plan_of(nb.all_pairs_lists(nb.unit_ratings(df), 6))


def test_stored_vectors_are_not_repeated(spark, monkeypatch):
    """more seeds than a block has: the plan repeats neither side."""
    rows = [(i, "shelf", str((i * j) % 11), 1.0 + j) for i in range(40) for j in range(4)] + [(90, "shelf", "rare", 1.0)]
    feats = spark.createDataFrame(rows, "item_id bigint, block string, feature string, value double")
    catalog = feats.select("item_id").distinct()
    want = sorted(nb.content_neighbors(feats, catalog, catalog, k=5).collect())
    monkeypatch.setattr(vector_knn, "SEED_BLOCK", 7)
    monkeypatch.setattr(vector_knn, "CATALOG_BLOCK", 6)
    monkeypatch.setattr(vector_knn, "MOST_SENT", 3, raising=False)
    found = nb.content_neighbors(feats, catalog, catalog, k=5)
    assert sorted(found.collect()) == want
    assert "Generate" not in plan_of(found)


def test_lists_are_carried_from_block_to_block():
    """Equal scores: the lowest ids stay, whatever the order of the blocks."""
    def block(ids):
        n = len(ids)
        return pa.table({"item_id": pa.array(ids, pa.int64()), "keys": pa.array([[1]] * n, pa.list_(pa.int64())),
                         "values": pa.array([[1.0]] * n, pa.list_(pa.float64())), "scale": pa.array(np.ones(n))})

    seeds, found = block([5, 1, 12]), None
    for ids in ([9, 10, 11, 12], [4, 5, 6, 7], [1, 2, 3]):
        found = vector_knn.block_top_k(seeds, block(ids), 3, found)
    assert [tuple(r.values())[:2] for r in found.to_pylist()] == [(5, 1), (5, 2), (5, 3), (1, 2), (1, 3), (1, 4), (12, 1), (12, 2), (12, 3)]


def test_ratings_stay_where_few_seeds_are_sent(spark, monkeypatch):
    """a few seeds' ratings go to the others, which are not shuffled by user."""
    df = spark.createDataFrame(some_cells(12), CELL)
    seeds = spark.createDataFrame([(3,), (4,), (3,), (77,)], "item_id bigint")
    unit = session.cut_lineage(nb.unit_ratings(df))
    plan = plan_of(nb.seed_dots(unit, seeds))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(user_id" not in plan
    want = sorted(nb.item_neighbors(df, k=6, seeds=seeds).collect())
    monkeypatch.setattr(nb, "SEED_RATINGS", 0)
    assert sorted(nb.item_neighbors(df, k=6, seeds=seeds).collect()) == want


def test_a_long_cut_frees_earlier_shuffles(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(session, "free_shuffles", lambda s: freed.append(s))
    session.cut_lineage(spark.range(3))
    assert freed == []
    monkeypatch.setattr(session, "COLLECT_AFTER_S", 0.0)
    assert session.cut_lineage(spark.range(3)).count() == 3
    assert len(freed) == 1


@pytest.fixture
def tables(spark, tmp_path):
    """Part 1 has lines of an order that comes twice, of an unknown buyer and supplier and without
    figures; supplier 2 comes twice, part 2 has no known supplier, part 3 no line."""
    day = dt.datetime(1996, 12, 31, 23)
    rows = {
        "customer": ([(1, "BUILDING"), (2, None)], "c_custkey bigint, c_mktsegment string"),
        "orders": ([(1, 1, day, "1-URGENT"), (1, 1, day, "1-URGENT"), (2, 2, dt.datetime(1994, 1, 1), "5-LOW"), (3, 9, day, "5-LOW")],
                   "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 1, 1, 8.0), (2, 1, 2, None), (3, 1, 1, 5.0), (2, 2, 7, 3.0), (2, None, 1, 4.0)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double"),
        "supplier": ([(1, "one"), (2, "two"), (2, "zwei"), (None, "none")], "s_suppkey bigint, s_name string"),
        "part": ([(1, "a", "b", "t", 1), (2, "c", "b", "t", 2), (3, "d", "b", "t", 3)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("sent", [400_000, 1])
def test_records_from_lines_dealt_once(spark, tables, monkeypatch, sent):
    """lines are read, and dealt by order and by part, once."""
    monkeypatch.setattr(fixtures, "BROADCAST_SUPPLIERS", sent, raising=False)
    books = fixtures.raw_books(spark, tables)
    plan = plan_of(books)
    assert plan.count("ReadSchema: struct<l_orderkey") == 1
    got = {r.book_id: r for r in books.collect()}
    one = got["1"]
    assert (one.ratings_count, one.average_rating, one.publication_year) == ("3", "2.0", "1994")
    assert [(s["name"], s["count"]) for s in one.popular_shelves] == [(None, "1"), ("1-urgent", "2"), ("5-low", "1"), ("building", "2")]
    assert [(a["author_id"], a["name"]) for a in one.authors] == [("1", "one"), ("2", "two"), ("2", "zwei")]
    assert got["2"].ratings_count == "1" and got["2"].authors is None
    assert got["3"].ratings_count is None and got["3"].popular_shelves is None and got["3"].authors is None


def test_als_blocks_grow_with_the_cells(spark, monkeypatch):
    """A block has a bounded number of ratings."""
    cells = spark.createDataFrame(some_cells(13, 40, 30), CELL)
    used = []
    fit = factorization.ALS.fit
    monkeypatch.setattr(factorization.ALS, "fit", lambda self, data: used.append(self) or fit(self, data))
    factorization.train_als(cells, factors=4, iterations=2)
    monkeypatch.setattr(factorization, "BLOCK_RATINGS", 20, raising=False)
    trained = factorization.train_als(cells, factors=4, iterations=2)
    few, many = [(a.getNumUserBlocks(), a.getNumItemBlocks()) for a in used]
    assert few == (10, 10) and many == (-(-cells.count() // 20),) * 2
    assert used[1].getIntermediateStorageLevel() == "DISK_ONLY"
    shape = {r.side: r.n_rows for r in factorization.model_shape(trained).collect()}
    assert shape == {"user": cells.select("user_id").distinct().count(), "item": cells.select("item_id").distinct().count()}
    assert trained.item_factors().where(F.exists("features", F.isnan)).count() == 0


def test_features_of_unlisted_items_stay(spark, monkeypatch):
    """lists meet the features of their own items only."""
    rows = [(i, b, str((i * j) % 3), 0.5) for i in range(30) for b in ("shelf", "author") for j in range(1, 3)]
    features = spark.createDataFrame(list(dict.fromkeys(rows)), "item_id bigint, block string, feature string, value double")
    recs = spark.createDataFrame([("a", u, r, (u * 7 + r * 3) % 40) for u in range(4) for r in range(1, 6)] + [("a", 9, 1, None)],
                                 "recommender string, user_id bigint, rank bigint, item_id bigint")
    found = ev.list_diversity(recs, features, 4)
    assert "LeftSemi" in plan_of(found)
    want = sorted(found.collect())
    monkeypatch.setattr(ev, "MOST_SENT", 0)
    assert sorted(ev.list_diversity(recs, features, 4).collect()) == want and len(want) == 4
