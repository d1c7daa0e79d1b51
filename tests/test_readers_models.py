"""Readers/writers, matrix export, ordering, ALS invariants and the driver entry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import factorization, ordering, prepare
from shelfwise.sources import fixtures, readers

from conftest import SF


def test_interactions_csv_and_id_map(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(f"{d}/i.csv", "w") as f:
        f.write("user_id,book_id,is_read,rating\n1,10,1,5\n2,10,0,0\n")
    with open(f"{d}/m.csv", "w") as f:
        f.write("book_id_csv,book_id\n10,9001\n")
    got = readers.read_interactions(spark, f"{d}/i.csv").collect()
    assert [(r.user_id, r.item_id, r.rating, r.is_read) for r in got] == [(1, 10, 5, "1"), (2, 10, 0, "0")]
    assert readers.read_id_map(spark, f"{d}/m.csv").collect()[0].book_id == 9001


def test_simple_features_casts(spark):
    books = spark.createDataFrame([("1", "12.0", "true", " 7", "", "x")], "book_id string, work_id string, "
                                  "is_ebook string, num_pages string, ratings_count string, average_rating string")
    for c in readers.BOOK_STRING_FIELDS:
        if c not in books.columns:
            books = books.withColumn(c, F.lit(None).cast("string"))
    r = readers.simple_features(books).collect()[0]
    assert r.work_id is None and r.is_ebook == 1 and r.num_pages == 7 and r.ratings_count is None
    assert r.average_rating is None
    bad = readers.simple_features(books.withColumn("book_id", F.lit("x1"))).collect()[0]
    assert bad.book_id is None and readers.titles(books.withColumn("book_id", F.lit("x1"))).first().book_id == "x1"


def test_csv_sink_nested_as_json(spark):
    d = tempfile.mkdtemp(prefix="sink-") + "/out"
    df = spark.createDataFrame([(1, ["a", "b"])], "id bigint, tags array<string>")
    readers.write_csv(df, d)
    back = spark.read.option("header", True).csv(d).collect()[0]
    assert back.tags == '["a","b"]'


def test_matrix_export_roundtrip(spark):
    inter = fixtures.interactions(spark, SF)
    cells, item_map, user_map = prepare.rating_matrix(inter)
    path = tempfile.mkdtemp(prefix="mtx-")
    readers.save_matrix(cells, item_map, user_map, path)
    back, rows, columns = readers.load_matrix(spark, path)
    assert back.count() == cells.count()
    chk = readers.check_matrix(back, rows, columns).collect()[0]
    assert not readers.check_matrix(back, rows.union(rows.limit(1)), columns).collect()[0].consistent
    assert chk.consistent and chk.max_row_plus_one == chk.n_row_ids


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    idx = ordering.global_index(df, [F.col("k").desc()], "pos", partitions=7).collect()
    assert sorted((r.pos, r.k) for r in idx) == [(i, 999 - i) for i in range(1000)]


def test_als_invariants(spark):
    cells = prepare.rating_cells(fixtures.interactions(spark, SF))
    trained = factorization.train_als(cells, factors=8, iterations=5)
    shape = {r.side: r.n_rows for r in factorization.model_shape(trained).collect()}
    assert shape["user"] == cells.select("user_id").distinct().count()
    uf = trained.user_factors()
    assert uf.where(F.exists("features", lambda x: F.isnan(x))).count() == 0
    # held-in pairs score above the average random pair
    u = trained.user_factors().withColumnRenamed("features", "fu")
    i = trained.item_factors().withColumnRenamed("features", "fi")
    dot = F.aggregate(F.zip_with("fu", "fi", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    held = cells.where(F.col("rating") > 0).join(u, "user_id").join(i, "item_id").select(dot.alias("s"))
    rand = u.limit(50).crossJoin(i.limit(50)).select(dot.alias("s"))
    assert held.agg(F.avg("s")).first()[0] > rand.agg(F.avg("s")).first()[0]
    path = tempfile.mkdtemp(prefix="als-")
    factorization.save_als(trained, path)
    assert factorization.load_als(spark, path).model.rank == 8


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["item_id", "neighbor_id", "rank", "similarity"]
    assert out.count() > 0
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 40


def test_global_index_with_heavy_ties(spark):
    # 90% of rows share one count value; the order is total only through the id
    df = spark.range(0, 3000).select(F.col("id").alias("item_id"),
                                     F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(7)).alias("n"))
    idx = ordering.global_index(df, [F.col("n").desc(), F.col("item_id").asc()], "pos", partitions=13).collect()
    expected = sorted(((r.n, r.item_id) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    got = [(r.n, r.item_id) for r in sorted(idx, key=lambda r: r.pos)]
    assert got == expected and sorted(r.pos for r in idx) == list(range(3000))


def test_event_interactions_adapter(spark):
    ev = fixtures.event_interactions(spark, SF)
    raw = fixtures.table(spark, SF, "events")
    assert ev.count() == raw.where(F.get_json_object("props", "$.k").isNotNull()).count()
    assert ev.where(F.col("rating") != 1).count() == 0
