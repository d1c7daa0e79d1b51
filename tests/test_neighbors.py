"""Collaborative and content KNN against brute force; padding; hot-user salting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import neighbors as nb
from shelfwise.operators import vector_knn
from shelfwise.operators.vector_knn import dense_cosine_topk

CELL = "item_id bigint, user_id bigint, rating double"


def brute(cells, k, seeds=None):
    """Padded cosine top-k over the whole catalog, rounded then id-ordered."""
    items = sorted({i for i, _, _ in cells})
    vec = {i: {} for i in items}
    for i, u, r in cells:
        vec[i][u] = vec[i].get(u, 0.0) + r
    def cos(a, b):
        na = sum(v * v for v in vec[a].values()) ** 0.5
        nb_ = sum(v * v for v in vec[b].values()) ** 0.5
        if na == 0 or nb_ == 0:
            return 0.0
        return sum(v * vec[b].get(u, 0.0) for u, v in vec[a].items()) / (na * nb_)
    out = {}
    for q in (seeds or items):
        ranked = sorted(((round(cos(q, j), 6), j) for j in items if j != q), key=lambda t: (-t[0], t[1]))[:k]
        out[q] = [(j, s) for s, j in ranked]
    return out


def as_lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r.rank)):
        out.setdefault(r.item_id, []).append((r.neighbor_id, pytest.approx(r.similarity, abs=1e-6)))
    return out


def random_cells(seed, n_items=30, n_users=25, p=0.2):
    rnd = random.Random(seed)
    return [(i, u, float(rnd.randint(0, 5))) for i in range(n_items) for u in range(n_users) if rnd.random() < p]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs_match_brute_force(spark, seed):
    cells = random_cells(seed)
    df = spark.createDataFrame(cells, CELL)
    assert as_lists(nb.item_neighbors(df, k=5)) == brute(cells, 5)


def test_hot_user_blocks_give_same_result(spark):
    cells = random_cells(3, n_items=40, n_users=10, p=0.6)
    df = spark.createDataFrame(cells, CELL)
    plain = as_lists(nb.item_neighbors(df, k=6))
    salted = as_lists(nb.item_neighbors(df, k=6, block_items=3))
    assert plain == salted == brute(cells, 6)


def test_seeded_lists_match_brute_force(spark):
    cells = random_cells(4)
    df = spark.createDataFrame(cells, CELL)
    seeds = spark.createDataFrame([(0,), (7,), (19,)], "item_id bigint")
    got = as_lists(nb.item_neighbors(df, k=8, seeds=seeds, block_items=2))
    assert got == brute(cells, 8, [0, 7, 19])


def test_padding_with_zero_similarity_by_id(spark):
    # item 3 shares no user with anyone; item 4 has only a zero rating
    cells = [(1, 10, 5.0), (2, 10, 4.0), (3, 11, 2.0), (4, 12, 0.0)]
    got = as_lists(nb.item_neighbors(spark.createDataFrame(cells, CELL), k=3))
    assert [j for j, _ in got[1]] == [2, 3, 4]
    assert [j for j, _ in got[3]] == [1, 2, 4]
    assert [j for j, _ in got[4]] == [1, 2, 3]
    assert got[3][0][1] == 0.0


def test_small_catalog_returns_fewer_rows(spark):
    cells = [(1, 10, 5.0), (2, 10, 4.0)]
    got = as_lists(nb.item_neighbors(spark.createDataFrame(cells, CELL), k=5))
    assert got == {1: [(2, pytest.approx(1.0))], 2: [(1, pytest.approx(1.0))]}


def test_content_neighbors_block_cosine(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(25):
        for blk, n in (("shelf", 6), ("author", 5), ("numeric", 4)):
            v = [rnd.random() if rnd.random() < 0.5 else 0.0 for _ in range(n)]
            if blk == "numeric":
                v = [x - 0.3 for x in v]  # negative entries allowed
            norm = sum(x * x for x in v) ** 0.5
            if i % 7 == 0 and blk != "numeric":
                continue  # some items lack blocks
            for j, x in enumerate(v):
                if x and norm:
                    rows.append((i, blk, str(j), x / norm))
    rows = [r for r in rows if r[0] != 24]  # item 24 has no features at all
    feats = spark.createDataFrame(rows, "item_id bigint, block string, feature string, value double")
    catalog = spark.createDataFrame([(i,) for i in range(25)], "item_id bigint")
    seeds = spark.createDataFrame([(0,), (5,), (24,)], "item_id bigint")
    got = as_lists(nb.content_neighbors(feats, catalog, seeds, k=25))
    vec = {i: {} for i in range(25)}
    for i, b, f, v in rows:
        vec[i][(b, f)] = v
    nblk = {i: len({b for b, _ in vec[i]}) for i in vec}
    def sim(a, b):
        if not nblk[a] or not nblk[b]:
            return 0.0
        return round(sum(v * vec[b].get(key, 0.0) for key, v in vec[a].items()) / (nblk[a] * nblk[b]) ** 0.5, 6)
    for q in (0, 5, 24):
        exp = sorted(((sim(q, j), j) for j in range(25) if j != q), key=lambda t: (-t[0], t[1]))
        assert got[q] == [(j, pytest.approx(s, abs=1e-6)) for s, j in exp]


def test_content_small_blocks_equal_one_block(spark, monkeypatch):
    rows = [(i, "numeric", str(j), float((i * 7 + j * 3) % 5) + 1.0) for i in range(12) for j in range(3)]
    feats = spark.createDataFrame(rows, "item_id bigint, block string, feature string, value double")
    catalog = feats.select("item_id").distinct()
    seeds = spark.createDataFrame([(i,) for i in range(12)], "item_id bigint")
    one = sorted(nb.content_neighbors(feats, catalog, seeds, k=4).collect())
    monkeypatch.setattr(vector_knn, "SEED_BLOCK", 3)
    monkeypatch.setattr(vector_knn, "CATALOG_BLOCK", 4)
    assert sorted(nb.content_neighbors(feats, catalog, seeds, k=4).collect()) == one
    outside = seeds.unionByName(spark.createDataFrame([(777,)], "item_id bigint"))
    assert sorted(nb.content_neighbors(feats, catalog, outside, k=4).collect()) == one


def test_dense_vectors(spark):
    rnd = np.random.default_rng(0)
    m = rnd.normal(size=(30, 8))
    m[3] = 0.0
    vecs = spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(30)], "item_id bigint, vector array<double>")
    seeds = spark.createDataFrame([(1,), (3,)], "item_id bigint")
    got = as_lists(dense_cosine_topk(vecs, seeds, 5))
    norms = np.linalg.norm(m, axis=1)
    for q in (1, 3):
        sims = [(round(float(m[q] @ m[j] / (norms[q] * norms[j])), 6) if norms[q] and norms[j] else 0.0, j)
                for j in range(30) if j != q]
        exp = sorted(sims, key=lambda t: (-t[0], t[1]))[:5]
        assert got[q] == [(j, pytest.approx(s, abs=1e-6)) for s, j in exp]


def test_small_sub_blocks_equal_one(spark, monkeypatch):
    from shelfwise.operators import vector_knn

    rows = [(i, "shelf", str((i * j) % 11), 1.0 + j) for i in range(20) for j in range(4)]
    feats = spark.createDataFrame(rows, "item_id bigint, block string, feature string, value double")
    catalog = feats.select("item_id").distinct()
    seeds = spark.createDataFrame([(i,) for i in range(0, 20, 3)], "item_id bigint")
    whole = sorted(nb.content_neighbors(feats, catalog, seeds, k=5).collect())
    monkeypatch.setattr(vector_knn, "DENSE_CELLS", 10)
    assert sorted(nb.content_neighbors(feats, catalog, seeds, k=5).collect()) == whole


def test_seeds_and_items_on_one_side_only(spark):
    entries = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (9, "b", 1.0)], "item_id bigint, key string, value double")
    scale = entries.select("item_id").distinct().withColumn("scale", F.lit(1.0))
    catalog = spark.createDataFrame([(1,), (2,), (3,)], "item_id bigint")  # 3 has no entries
    seeds = spark.createDataFrame([(9,), (9,), (3,), (1,)], "item_id bigint")  # 9 is not in the catalog, and asked twice
    got = as_lists(vector_knn.sparse_cosine_topk(entries, scale, catalog, seeds, 2))
    assert got == {9: [(2, 0.8), (1, 0.0)], 3: [(1, 0.0), (2, 0.0)], 1: [(2, 0.6), (3, 0.0)]}
    assert vector_knn.sparse_cosine_topk(entries, scale, catalog.limit(0), seeds, 2).count() == 0
    assert vector_knn.sparse_cosine_topk(entries, scale, catalog, seeds.limit(0), 2).count() == 0
    assert vector_knn.sparse_cosine_topk(entries.limit(0), scale.limit(0), catalog, seeds, 1).count() == 3


def test_tiles_meet_dense_columns_lists_and_ties(monkeypatch):
    """A block's best, where tiles cut seeds and items, some columns are in most
    vectors and others in few, and scores tie: those of all pairs."""
    import numpy as np
    import pyarrow as pa

    from shelfwise.operators import vector_knn

    draw = np.random.default_rng(3)

    def block(ids):
        keys = [[0, 1, *draw.choice(np.arange(2, 400), size=n, replace=False).tolist()] if n else [] for n in draw.integers(0, 6, len(ids))]
        values = [draw.integers(1, 4, len(x)).astype(float).tolist() for x in keys]
        scale = [1 / np.linalg.norm(v) if v else 0.0 for v in values]
        return pa.table({"item_id": pa.array(ids, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64())),
                         "values": pa.array(values, pa.list_(pa.float64())), "scale": pa.array(scale, pa.float64())})

    items = block(draw.permutation(300).tolist())
    seeds = items.slice(20, 90)
    vectors = {r["item_id"]: dict(zip(r["keys"], np.array(r["values"]) * r["scale"])) for r in items.to_pylist()}
    want = []
    for s in seeds.column("item_id").to_pylist():
        scored = [(-round(sum(x * vectors[i].get(c, 0.0) for c, x in vectors[s].items()), 9), i) for i in vectors if i != s]
        want += [(s, i) for _, i in sorted(scored)[:7]]
    for tile, cells, products in ((2048, 4_000_000, 4_000_000), (32, 32 * 25, 50), (32, 32 * 3, 1)):
        monkeypatch.setattr(vector_knn, "TILE", tile)
        monkeypatch.setattr(vector_knn, "DENSE_CELLS", cells)
        monkeypatch.setattr(vector_knn.products, "__defaults__", (products,))
        got = vector_knn.block_top_k(seeds, items, 7).to_pylist()
        assert sorted((r["seed_id"], r["neighbor_id"]) for r in got) == sorted(want)


def test_blocks_part_both_sides(spark, monkeypatch):
    """All pairs of many rows: an item is repeated for few blocks of seeds, with numbers for keys."""
    import pyarrow as pa

    from shelfwise.operators import blocks, vector_knn

    seen = []
    whole = blocks.query_blocks
    monkeypatch.setattr(vector_knn, "query_blocks", lambda q, *a, **kw: seen.append(q.schema["keys"].dataType.simpleString()) or whole(q, *a, **kw))
    feats = spark.createDataFrame([(i, "shelf", str(i % 7), 1.0) for i in range(2000)], "item_id bigint, block string, feature string, value double")
    catalog = feats.select("item_id")
    assert nb.content_neighbors(feats, catalog, catalog, k=2).count() == 4000
    assert seen == ["array<bigint>"]
    rows = spark.range(40_000).select(F.col("id").alias("item_id"))
    count = lambda q, r: pa.table({"n": pa.array([len(r)], pa.int64())})
    dealt = blocks.query_blocks(rows, "item_id", rows, "item_id", count, "n bigint", 32_768, 32_768, arrow=True)
    assert dealt.agg(F.sum("n")).first()[0] <= 40_000 * 9


def test_all_pairs_shuffle_no_pairs(spark, monkeypatch):
    """Blocks, seeds with more products than are held at a time, and the plan: ratings
    are grouped by blocks of items, pairs are not."""
    draw = random.Random(5)
    cells = [(i, u, float(draw.randint(0, 5))) for u in range(40) for i in draw.sample(range(60), 12)]
    cells += [(i, 99, 1.0) for i in range(60)]
    df = spark.createDataFrame(list({(i, u): (i, u, r) for i, u, r in cells}.values()), CELL)
    want = brute([tuple(r) for r in df.collect()], 5)
    assert as_lists(nb.item_neighbors(df, k=5)) == want
    items = nb.unit_ratings(df).groupBy("item_id").agg(F.collect_list("user_id").alias("users"), F.collect_list("w").alias("ws"))
    table = items.select(F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(True).alias("own"), "*").toArrow()
    whole = nb.block_pair_lists(table, 5).to_pylist()
    for limit in (200, 7):
        monkeypatch.setattr(nb, "PRODUCTS", limit)
        monkeypatch.setattr(nb.products, "__defaults__", (limit,))
        assert nb.block_pair_lists(table, 5).to_pylist() == whole
    plan = nb.all_pairs_lists(nb.unit_ratings(df), 5)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "FlatMapGroupsInArrow" in plan and "(i#" not in plan
    assert "Join" not in plan.split("FlatMapGroupsInArrow")[0]
