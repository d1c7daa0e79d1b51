"""Metadata flattening edge cases and hand-computed content features."""

import json
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as feat
from shelfwise.operators.metadata import flatten_metadata
from shelfwise.sources.readers import read_books

BOOKS = [
    {"book_id": "1", "title": "A" * 600, "authors": [{"author_id": "7", "name": "Ann"}, {"author_id": "", "name": ""},
                                                     {"author_id": "8", "name": "Bo"}],
     "popular_shelves": [{"count": "5", "name": "to-read"}, {"count": "9", "name": "fantasy"},
                         {"count": "9", "name": ""}, {"count": "5", "name": "20th-century"}],
     "publication_year": "", "num_pages": "310", "average_rating": "4.10", "ratings_count": "12",
     "language_code": "eng-long-code"},
    {"book_id": "2", "title": "Short", "authors": [], "popular_shelves": [], "num_pages": "x12"},
    {"book_id": "3", "title": "Not in catalog"},
]


@pytest.fixture(scope="module")
def books(spark):
    path = tempfile.mkdtemp(prefix="books-") + "/books.json"
    with open(path, "w") as f:
        for b in BOOKS:
            f.write(json.dumps(b) + "\n")
    return read_books(spark, path)


@pytest.fixture(scope="module")
def meta(spark, books):
    catalog = spark.createDataFrame([(1,), (2,), (4,)], "item_id bigint")
    return {r.item_id: r for r in flatten_metadata(books, catalog, top_n_shelves=3).collect()}


def test_catalog_filter(meta):
    assert set(meta) == {1, 2}


def test_truncation_and_defaults(meta):
    assert len(meta[1].title) == 500
    assert meta[1].language_code == "eng-long-c"
    assert meta[1].publication_year == 0 and meta[1].num_pages == 310
    assert meta[2].num_pages == 0 and meta[2].average_rating == 0.0 and meta[2].ratings_count == 0


def test_authors_skip_empty(meta):
    assert meta[1].authors == "Ann, Bo" and meta[1].author_ids == "7,8" and meta[1].num_authors == 2
    assert meta[2].num_authors == 0 and meta[2].authors == ""


def test_shelves_stable_top_then_drop_empty(meta):
    # counts 9, 9, 5, 5 -> stable by position: fantasy, '', to-read (top 3), then '' dropped
    assert meta[1].shelves == "fantasy,to-read"
    assert meta[1].shelf_counts == "9,9,5"
    assert meta[1].num_shelves == 2


def test_id_map_bridge(spark, books):
    id_map = spark.createDataFrame([(101, 1), (102, 2)], "book_id_csv bigint, book_id bigint")
    catalog = spark.createDataFrame([(101,)], "item_id bigint")
    got = flatten_metadata(books, catalog, id_map=id_map).collect()
    assert [(r.item_id, r.num_authors) for r in got] == [(101, 2)]


META = "item_id bigint, title string, shelves string, author_ids string, num_authors bigint, " \
       "ratings_count bigint, average_rating double, publication_year bigint, num_pages bigint"


def test_tfidf_tokens_idf_and_norm(spark):
    rows = [(1, "t", "20th-century,sci-fi", "a1", 1, 0, 0.0, 0, 0), (2, "t", "sci-fi,sci-fi", "a1,a2", 2, 0, 0.0, 0, 0),
            (3, "t", "sci-fi", "a2,a2", 1, 0, 0.0, 0, 0), (4, "t", "th-century,x", "", 0, 0, 0.0, 0, 0)]
    md = spark.createDataFrame(rows, META)
    catalog = spark.createDataFrame([(i,) for i in range(1, 6)], "item_id bigint")  # item 5: no metadata
    tf, vocab = feat.shelf_vocabulary(md, catalog, min_df=2)
    v = {r.term: r for r in vocab.collect()}
    # "20th-century" tokenises to "th-century"; "x" is too short
    assert set(v) == {"sci-fi", "th-century"}
    assert v["sci-fi"].idf == pytest.approx(math.log(6 / 4) + 1)
    assert v["th-century"].idf == pytest.approx(math.log(6 / 3) + 1)
    shelf = {(r.item_id, r.feature): r.value for r in feat.shelf_block(md, catalog, min_df=2).collect()}
    a, b = 1 * (math.log(6 / 3) + 1), 1 * (math.log(6 / 4) + 1)
    assert shelf[(1, "th-century")] == pytest.approx(a / math.hypot(a, b))
    assert shelf[(2, "sci-fi")] == pytest.approx(1.0)


def test_author_block_min_items_and_weights(spark):
    rows = [(1, "t", "", "a1,a2,a3", 3, 0, 0.0, 0, 0), (2, "t", "", "a1,a2", 2, 0, 0.0, 0, 0),
            (3, "t", "", "a9", 1, 0, 0.0, 0, 0)]
    md = spark.createDataFrame(rows, META)
    catalog = md.select("item_id")
    got = {(r.item_id, r.feature): r.value for r in feat.author_block(md, catalog).collect()}
    assert got == {(1, "a1"): pytest.approx(1 / math.sqrt(2)), (1, "a2"): pytest.approx(1 / math.sqrt(2)),
                   (2, "a1"): pytest.approx(1 / math.sqrt(2)), (2, "a2"): pytest.approx(1 / math.sqrt(2))}


def test_numeric_block(spark):
    rows = [(1, "t", "", "", 0, 99, 4.0, 1850, 0), (2, "t", "", "", 0, 0, 0.0, 0, 0)]
    md = spark.createDataFrame(rows, META)
    got = {(r.item_id, r.feature): r.value for r in feat.numeric_block(md, md.select("item_id")).collect()}
    raw = [math.log1p(99), 4.0 / 5, (1850 - 1900) / 100, 0.0]
    n = math.sqrt(sum(x * x for x in raw))
    assert got[(1, "log_ratings_count")] == pytest.approx(raw[0] / n)
    assert got[(1, "year_offset")] == pytest.approx(raw[2] / n) and got[(1, "year_offset")] < 0
    assert (1, "log_pages") not in got and not any(k[0] == 2 for k in got)


def test_a_tasks_share_of_a_shuffle_does_not_grow_with_the_tables(spark):
    """Shuffles of the features have many partitions, whatever number the session sets."""
    import re

    from conftest import SF
    from shelfwise.plans.content import book_metadata

    plan = book_metadata(spark, SF)._jdf.queryExecution().executedPlan().toString()
    sizes = [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan)]
    assert sizes and min(sizes) >= 1024
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 << 20


def test_features_are_dealt_by_number_of_items(spark, monkeypatch):
    """A task's items are set by their number, and the aligned metadata is not joined with
    the catalog again; repeated and null items and items without metadata count as before."""
    import re

    rows = [(i, "t", f"fantasy,shelf-{i % 3}", f"{i % 4}", 1, i, 4.0, 2000, 100) for i in range(40)]
    rows += [(5, "other", "fantasy,fantasy", "1", 1, 3, 2.0, 1990, 50), (None, "none", "fantasy", "1", 1, 1, 1.0, 1990, 10)]
    meta = spark.createDataFrame(rows, "item_id bigint, title string, shelves string, author_ids string, num_authors bigint,"
                                 "ratings_count bigint, average_rating double, publication_year bigint, num_pages bigint")
    catalog = spark.createDataFrame([(i,) for i in [*range(42), 3, None]], "item_id bigint")
    blocks = feat.shelf_block(meta, catalog), feat.author_block(meta, catalog), feat.numeric_block(meta, catalog)
    want = sorted((*r[:3], round(r.value, 9)) for b in blocks for r in b.collect())
    monkeypatch.setattr(feat, "ITEMS_OF_TASK", 10)
    made = feat.content_features(meta, catalog)
    assert sorted((*r[:3], round(r.value, 9)) for r in made.collect()) == want
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # 42 catalog items, item 5 twice, the null item
    assert set(re.findall(r"RepartitionByExpression \[item_id#\d+L\], (\d+)", plan)) == {"5"}
    assert "LeftOuter" not in plan
