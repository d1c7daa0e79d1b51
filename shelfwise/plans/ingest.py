"""Registered queries: the ingest projections and casts over the raw book
records, title lookups of the prepared catalog, catalog alignment,
holdout positives and the processed-text search (B3, B5, B6, B8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.operators import evaluation as ev
from shelfwise.operators import features as feat
from shelfwise.operators import analytics, matrix_blocks, metadata, prepare, search
from shelfwise.plans.content import book_metadata, catalog_of
from shelfwise.plans.evaluation import HOLDOUTS_SQL, MIN_INTERACTIONS, N_USERS, SEED
from shelfwise.plans.registry import register
from shelfwise.plans.search import _TITLES, _WORDS, title_words
from shelfwise.plans.sql_common import CELLS, FEATURES, INTERACTIONS, META, weighted_ctes
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources import fixtures, readers

TOP_ITEMS = 1500
MIN_READS = 10


@register("simple_features", "P3 P6 Q10", f"""
WITH inter AS ({INTERACTIONS}), {META}
SELECT p.p_partkey AS book_id, p.p_partkey AS work_id, CAST(st.first_year AS BIGINT) AS publication_year,
       CAST(CASE WHEN p.p_size % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_ebook, CAST(p.p_size AS BIGINT) AS num_pages,
       CAST(st.n_lines AS BIGINT) AS ratings_count, CAST(st.n_lines AS BIGINT) AS text_reviews_count,
       CAST(st.avg_rating AS DOUBLE) AS average_rating
FROM part p LEFT JOIN lstats st ON st.item_id = p.p_partkey
""")
def q_simple_features(spark, sf_dir):
    return readers.simple_features(fixtures.raw_books(spark, sf_dir))


@register("book_titles", "P2", """
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_name AS title_without_series FROM part
""")
def q_book_titles(spark, sf_dir):
    return readers.titles(fixtures.raw_books(spark, sf_dir))


@register("extra_features_csv", "P1 P7 Q40", f"""
WITH inter AS ({INTERACTIONS}), {META},
aj AS (SELECT a.item_id,
              CAST(to_json(list({{'author_id': CAST(a.l_suppkey AS VARCHAR), 'name': s.s_name}} ORDER BY a.l_suppkey))
                   AS VARCHAR) AS authors
       FROM auth a JOIN supplier s ON a.l_suppkey = s.s_suppkey GROUP BY a.item_id)
SELECT CAST(p.p_partkey AS VARCHAR) AS book_id, p.p_type || ' ' || p.p_brand AS description, p.p_type AS format, p.p_name AS title,
       p.p_name AS title_without_series, lower(p.p_type) || '-' || lower(p.p_brand) AS language_code,
       aj.authors, CAST(NULL AS VARCHAR) AS country_code
FROM part p LEFT JOIN aj ON aj.item_id = p.p_partkey
""")
def q_extra_features_csv(spark, sf_dir):
    return readers.csv_ready(readers.extra_features(fixtures.raw_books(spark, sf_dir)))


@register("top_item_titles", "J3 L2", f"""
WITH inter AS ({INTERACTIONS}),
f AS (SELECT * FROM inter
      WHERE user_id IN (SELECT user_id FROM inter GROUP BY user_id HAVING COUNT(*) >= {MIN_READS})
        AND item_id IN (SELECT item_id FROM inter GROUP BY item_id HAVING COUNT(*) >= {MIN_READS})),
ti AS (SELECT item_id FROM f GROUP BY item_id ORDER BY COUNT(*) DESC, item_id LIMIT {TOP_ITEMS})
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_name AS title_without_series FROM part
WHERE p_partkey IN (SELECT item_id FROM ti)
""")
def q_top_item_titles(spark, sf_dir):
    top = prepare.top_items(prepare.active_filter(fixtures.interactions(spark, sf_dir), MIN_READS), TOP_ITEMS)
    titles = readers.titles(fixtures.raw_books(spark, sf_dir))
    return titles.join(top.select(F.col("item_id").cast("string").alias("book_id")), "book_id", "left_semi")


@register("catalog_alignment", "J9 A11", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES},
fi AS (SELECT DISTINCT item_id FROM features)
SELECT CAST((SELECT COUNT(*) FROM catalog) AS BIGINT) AS n_collab,
       CAST((SELECT COUNT(*) FROM fi) AS BIGINT) AS n_content,
       CAST((SELECT COUNT(*) FROM catalog JOIN fi USING (item_id)) AS BIGINT) AS n_aligned,
       CAST((SELECT COUNT(*) FROM catalog JOIN meta USING (item_id)) AS BIGINT) AS n_with_metadata,
       ROUND(100.0 * (SELECT COUNT(*) FROM catalog JOIN fi USING (item_id)) / (SELECT COUNT(*) FROM catalog), 6)
         AS pct_aligned,
       ROUND(100.0 * (SELECT COUNT(*) FROM catalog JOIN meta USING (item_id)) / (SELECT COUNT(*) FROM catalog), 6)
         AS pct_with_metadata
""")
def q_catalog_alignment(spark, sf_dir):
    catalog = catalog_of(spark, sf_dir)
    meta = book_metadata(spark, sf_dir)
    feats = feat.content_features(meta, catalog)
    return feat.catalog_alignment(catalog, feats, meta)


@register("holdout_positives", "T3 E8", f"""
WITH {HOLDOUTS_SQL}
SELECT c.user_id, c.item_id FROM cells c JOIN holdouts h USING (user_id) WHERE c.item_id <> h.seed_item
""")
def q_holdout_positives(spark, sf_dir):
    cells = prepare.rating_cells(fixtures.interactions(spark, sf_dir))
    return ev.holdout_positives(cells, ev.sample_holdouts(cells, N_USERS, MIN_INTERACTIONS, SEED))


_PROC = "trim(lower(regexp_replace(regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g'), '[^\\pL\\pM\\pN_]', ' ', 'g')))"


@register("smart_search", "F4 L5", f"""
WITH RECURSIVE {_TITLES}, {_WORDS},
spairs AS (SELECT w.query, {_PROC.format(x="w.query")} AS a, t.title, t.item_id, {_PROC.format(x="t.title")} AS b
           FROM words w, titles t),
{weighted_ctes("spairs", "sscored", 70)},
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, item_id) AS rank FROM sscored)
SELECT query, CAST(rank AS BIGINT) AS rank, title, item_id, score FROM ranked WHERE rank <= 10
""")
def q_smart_search(spark, sf_dir):
    words = title_words(spark, sf_dir)
    res = search.smart_search(fixtures.title_table(spark, sf_dir), words, 70, 10)
    return res.join(words, "query_id").select("query", "rank", "title", "item_id", "score")


_SIMPLE = """SELECT {id} AS book_id, p.p_partkey AS work_id, CAST(st.first_year AS BIGINT) AS publication_year,
       CAST(CASE WHEN p.p_size % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_ebook, CAST(p.p_size AS BIGINT) AS num_pages,
       CAST(st.n_lines AS BIGINT) AS ratings_count, CAST(st.n_lines AS BIGINT) AS text_reviews_count,
       CAST(st.avg_rating AS DOUBLE) AS average_rating
FROM part p LEFT JOIN lstats st ON st.item_id = p.p_partkey"""


def _folder(spark, kind):
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


@register("malformed_ids", "P4 Q11", f"""
WITH inter AS ({INTERACTIONS}), {META}
{_SIMPLE.format(id="CASE WHEN p.p_partkey % 10 <> 3 THEN p.p_partkey END")}
""")
def q_malformed_ids(spark, sf_dir):
    """A record id that is no number becomes null instead of ending the job."""
    books = fixtures.raw_books(spark, sf_dir)
    bad = F.when(F.col("book_id").cast("bigint") % 10 == 3, F.concat(F.lit("x"), "book_id")).otherwise(F.col("book_id"))
    return readers.simple_features(books.withColumn("book_id", bad))


@register("titles_with_features", "J4", f"""
WITH inter AS ({INTERACTIONS}), {META},
simple AS ({_SIMPLE.format(id="p.p_partkey")} WHERE p.p_partkey % 10 <> 3)
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_name AS title_without_series, s.* EXCLUDE (book_id)
FROM part LEFT JOIN simple s ON s.book_id = p_partkey
""")
def q_titles_with_features(spark, sf_dir):
    books = fixtures.raw_books(spark, sf_dir)
    return analytics.titles_with_features(readers.titles(books), readers.simple_features(books).where("book_id % 10 <> 3"))


@register("books_ndjson_gz", "S1 P3", f"""
WITH inter AS ({INTERACTIONS}), {META}
{_SIMPLE.format(id="p.p_partkey")}
""")
def q_books_ndjson_gz(spark, sf_dir):
    """The records written as gzipped NDJSON and read with the fixed schema."""
    folder = _folder(spark, "books")
    fixtures.raw_books(spark, sf_dir).write.option("compression", "gzip").json(folder)
    return readers.simple_features(readers.read_books(spark, f"{folder}/*.json.gz"))


@register("catalog_scan", "S2 P9", f"""
WITH inter AS ({INTERACTIONS}), {META}
SELECT item_id, title, num_shelves FROM meta
""")
def q_catalog_scan(spark, sf_dir):
    """Gzipped records restricted to the catalog and flattened."""
    folder = _folder(spark, "books")
    fixtures.raw_books(spark, sf_dir).write.option("compression", "gzip").json(folder)
    books = readers.read_books(spark, f"{folder}/*.json.gz")
    return metadata.flatten_metadata(books, catalog_of(spark, sf_dir)).select("item_id", "title", "num_shelves")


@register("interactions_csv", "S3 P5", f"""
SELECT user_id, item_id, rating FROM ({INTERACTIONS})
""")
def q_interactions_csv(spark, sf_dir):
    folder = _folder(spark, "interactions")
    readers.write_csv(fixtures.interactions(spark, sf_dir).withColumnRenamed("item_id", "book_id"), folder)
    return readers.read_interactions(spark, folder)


@register("extra_features_file", "S6 P7 Q40", """
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_type || ' ' || p_brand AS description, p_name AS title FROM part
""")
def q_extra_features_file(spark, sf_dir):
    """The CSV file itself, read again."""
    folder = _folder(spark, "extra")
    readers.write_csv(readers.extra_features(fixtures.raw_books(spark, sf_dir)), folder)
    return spark.read.option("header", True).csv(folder).select("book_id", "description", "title")


@register("top_items_parquet", "S4 S5 L2", f"""
WITH inter AS ({INTERACTIONS})
SELECT item_id, CAST(COUNT(*) AS BIGINT) AS n_interactions FROM inter GROUP BY item_id ORDER BY 2 DESC, 1 LIMIT {TOP_ITEMS}
""")
def q_top_items_parquet(spark, sf_dir):
    folder = _folder(spark, "top")
    readers.write_parquet(prepare.top_items(fixtures.interactions(spark, sf_dir), TOP_ITEMS), folder)
    return readers.read_parquet(spark, folder)


_MATRIX_SQL = """SELECT CAST(COUNT(DISTINCT item_id) AS BIGINT) AS max_row_plus_one, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS max_col_plus_one,
       CAST(COUNT(*) AS BIGINT) AS nnz, CAST(COUNT(DISTINCT item_id) + {extra} AS BIGINT) AS n_row_ids,
       CAST(COUNT(DISTINCT user_id) AS BIGINT) AS n_col_ids, {same} AS consistent FROM cells"""


def _saved_matrix(spark, sf_dir):
    folder = _folder(spark, "matrix")
    cells, rows, cols = prepare.rating_matrix(fixtures.interactions(spark, sf_dir))
    readers.save_matrix(cells, rows, cols, folder)
    return readers.load_matrix(spark, folder)


@register("matrix_round_trip", "S7 S8", f"""
WITH {CELLS} {_MATRIX_SQL.format(extra=0, same="TRUE")}
""")
def q_matrix_round_trip(spark, sf_dir):
    return readers.check_matrix(*_saved_matrix(spark, sf_dir))


@register("matrix_spare_id", "S8", f"""
WITH {CELLS} {_MATRIX_SQL.format(extra=1, same="FALSE")}
""")
def q_matrix_spare_id(spark, sf_dir):
    """A map with one id more than the matrix has rows is inconsistent."""
    cells, rows, cols = _saved_matrix(spark, sf_dir)
    return readers.check_matrix(cells, rows.union(spark.sql("SELECT -1L, -1L")), cols)


def _stored_blocks(spark, sf_dir):
    folder = _folder(spark, "matrix-blocks")
    cells, rows, _ = prepare.rating_matrix(fixtures.interactions(spark, sf_dir))
    matrix_blocks.write_blocks(matrix_blocks.to_blocks(cells), folder)
    return matrix_blocks.read_blocks(spark, folder), rows


_PLACED = """items AS (SELECT item_id, ROW_NUMBER() OVER (ORDER BY item_id) - 1 AS row_idx FROM (SELECT DISTINCT item_id FROM cells)),
people AS (SELECT user_id, ROW_NUMBER() OVER (ORDER BY user_id) - 1 AS col_idx FROM (SELECT DISTINCT user_id FROM cells))"""


@register("matrix_block_cells", "S7 A3", f"""
WITH {CELLS}, {_PLACED}
SELECT row_idx, col_idx, rating AS value FROM cells JOIN items USING (item_id) JOIN people USING (user_id)
""")
def q_matrix_block_cells(spark, sf_dir):
    """The whole matrix written as compressed blocks, read again and taken apart."""
    return matrix_blocks.to_cells(_stored_blocks(spark, sf_dir)[0])


TILE = 8


@register("dense_pivot_tile", "A3", f"""
WITH {CELLS}, {_PLACED}
SELECT i.row_idx, {", ".join(f"COALESCE(MAX(CASE WHEN p.col_idx = {c} THEN c.rating END), 0.0) AS c{c}" for c in range(TILE))}
FROM items i LEFT JOIN cells c ON c.item_id = i.item_id LEFT JOIN people p ON p.user_id = c.user_id GROUP BY i.row_idx
""")
def q_dense_pivot_tile(spark, sf_dir):
    """The dense pivot of all items and the first users."""
    blocks, rows = _stored_blocks(spark, sf_dir)
    return matrix_blocks.dense_tile(blocks, 0, rows.count(), 0, TILE)
