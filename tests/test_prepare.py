"""Activity filter, top-N, rating cells and matrix statistics."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import prepare

SCHEMA = "user_id bigint, item_id bigint, rating bigint"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# readers x books; book "c" and reader 4 are rare, reader 3 reads the rare book
READS = {1: "aab", 2: "abc", 3: "c", 4: "b"}
BOOKS = {"a": 70, "b": 80, "c": 90}


@pytest.fixture(scope="module")
def reads(spark):
    return spark.createDataFrame([(u, BOOKS[b], i) for u, bs in READS.items() for i, b in enumerate(bs)], SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_active_filter_against_its_rule(reads, n):
    """Both counts are of the input, repeated rows count, and a row stays only if
    its reader and its book both reach n."""
    per_book = {b: sum(bs.count(b) for bs in READS.values()) for b in BOOKS}
    want = sorted((u, BOOKS[b], i) for u, bs in READS.items() for i, b in enumerate(bs) if len(bs) >= n and per_book[b] >= n)
    assert rows(prepare.active_filter(reads, n), "user_id", "item_id", "rating") == want


def test_active_filter_drops_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 1), (5, None, 1), (5, 1, 1)], SCHEMA)
    assert rows(prepare.active_filter(df, 2), "user_id", "item_id") == [(5, 1)]


def test_top_n_ties_by_id(spark):
    df = spark.createDataFrame([(u, i, 1) for u, i in [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12)]], SCHEMA)
    assert [r.user_id for r in prepare.top_users(df, 2).collect()] == [1, 2]
    top = prepare.top_items(df, 2).collect()
    assert [(r.item_id, r.n_interactions) for r in top] == [(10, 2), (11, 2)]


def test_top_n_large_path_matches_small(spark, monkeypatch):
    from shelfwise.operators import ordering

    df = spark.range(0, 500).select((F.col("id") % 37).alias("user_id"), F.col("id").alias("item_id"),
                                    F.lit(1).cast("bigint").alias("rating"))
    small = [r.user_id for r in prepare.top_users(df, 20).collect()]
    monkeypatch.setattr(ordering, "TAKE_ORDERED_MAX", 1)
    big = prepare.top_users(df, 20).orderBy(F.col("n_interactions").desc(), "user_id").collect()
    assert [r.user_id for r in big] == small


def test_cells_sum_duplicates_and_keep_zeros(spark):
    df = spark.createDataFrame([(1, 100, 2), (1, 100, 3), (2, 100, 0)], SCHEMA)
    cells = prepare.rating_cells(df)
    assert rows(cells, "item_id", "user_id", "rating") == [(100, 1, 5.0), (100, 2, 0.0)]
    stats = prepare.matrix_stats(cells).collect()[0]
    assert stats.nnz == 2 and stats.n_nonzero_ratings == 1
    assert stats.density == pytest.approx(1.0) and stats.sparsity == pytest.approx(0.0)


def test_cells_first_needs_order(spark):
    df = spark.createDataFrame([(1, 100, 2, 2), (1, 100, 3, 1)], SCHEMA + ", ts bigint")
    with pytest.raises(ValueError):
        prepare.rating_cells(df, "first")
    assert prepare.rating_cells(df, "first", "ts").collect()[0].rating == 3.0


def test_index_ids_dense_and_sorted(spark):
    df = spark.createDataFrame([(u, 1, 1) for u in [50, 7, 7, 900, 3]], SCHEMA)
    idx = prepare.index_ids(df, "user_id").collect()
    assert sorted((r.matrix_idx, r.user_id) for r in idx) == [(0, 3), (1, 7), (2, 50), (3, 900)]


def test_md5_sample_deterministic(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("user_id"), F.col("id").alias("item_id"))
    a = prepare.sample_fraction(df, 0.3, 7, ["user_id", "item_id"])
    b = prepare.sample_fraction(df, 0.3, 7, ["user_id", "item_id"])
    assert rows(a, "user_id") == rows(b, "user_id")
    assert 400 < a.count() < 800
