"""Registered queries: metadata flattening and content features."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.common import shown
from shelfwise.operators import features, metadata
from shelfwise.plans.registry import register
from shelfwise.plans.sql_common import FEATURES, INTERACTIONS, META
from shelfwise.session import cut_lineage
from shelfwise.sources import fixtures


def catalog_of(spark, sf_dir):
    return fixtures.interactions(spark, sf_dir).select("item_id").distinct()


def book_metadata(spark, sf_dir, catalog=None):
    """``catalog``: the item ids where the query has them already."""
    return metadata.flatten_metadata(fixtures.raw_books(spark, sf_dir), catalog_of(spark, sf_dir) if catalog is None else catalog)


def content_features(spark, sf_dir, catalog=None):
    # the ids are read twice: the lines that they come from are joined to their orders once
    catalog = cut_lineage(catalog_of(spark, sf_dir)) if catalog is None else catalog
    return features.content_features(book_metadata(spark, sf_dir, catalog), catalog)


@register("book_metadata", "C1 P9 P10 P11 P12 L3 Q12 Q13 Q14", f"""
WITH inter AS ({INTERACTIONS}), {META}
SELECT * FROM meta
""")
def q_book_metadata(spark, sf_dir):
    return book_metadata(spark, sf_dir)


@register("metadata_profile", "A10 A11", f"""
WITH inter AS ({INTERACTIONS}), {META}
SELECT CAST(COUNT(*) AS BIGINT) AS n_books,
       CAST(COUNT(*) FILTER (WHERE num_authors > 0) AS BIGINT) AS n_with_authors,
       CAST(COUNT(*) FILTER (WHERE num_shelves > 0) AS BIGINT) AS n_with_shelves,
       ROUND(AVG(num_shelves), 6) AS mean_shelves, ROUND(AVG(num_authors), 6) AS mean_authors,
       ROUND(AVG(average_rating), 6) AS mean_rating,
       MIN(publication_year) FILTER (WHERE publication_year > 0) AS min_year,
       MAX(publication_year) FILTER (WHERE publication_year > 0) AS max_year,
       MIN(num_pages) FILTER (WHERE num_pages > 0) AS min_pages, MAX(num_pages) AS max_pages,
       ROUND(COUNT(*) FILTER (WHERE num_authors > 0) * 100.0 / COUNT(*), 6) AS pct_with_authors,
       ROUND(COUNT(*) FILTER (WHERE num_shelves > 0) * 100.0 / COUNT(*), 6) AS pct_with_shelves
FROM meta
""")
def q_metadata_profile(spark, sf_dir):
    return metadata.metadata_profile(book_metadata(spark, sf_dir))


@register("top_shelves", "A12", f"""
WITH inter AS ({INTERACTIONS}), {META}
SELECT shelf, CAST(COUNT(*) AS BIGINT) AS n_books
FROM (SELECT unnest(string_split(shelves, ',')) AS shelf FROM meta WHERE shelves <> '')
WHERE shelf <> '' GROUP BY shelf ORDER BY n_books DESC, shelf LIMIT 20
""")
def q_top_shelves(spark, sf_dir):
    return metadata.top_shelves(book_metadata(spark, sf_dir), 20)


@register("shelf_vocabulary", "C2 A13 Q15 Q16 Q17 Q22", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES}
SELECT term, CAST(df AS BIGINT) AS df, CAST(total AS DOUBLE) AS total, ROUND(idf, 6) AS idf FROM vocab
""")
def q_shelf_vocabulary(spark, sf_dir):
    _, vocab = features.shelf_vocabulary(book_metadata(spark, sf_dir), catalog_of(spark, sf_dir))
    return vocab.select("term", F.col("df").cast("bigint").alias("df"), F.col("total").cast("double").alias("total"),
                        shown("idf").alias("idf"))


@register("content_features", "C2 C3 C4 C5 A14 A15 Q18 Q19 Q20 Q21", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES}
SELECT item_id, block, feature, ROUND(value, 6) AS value FROM features
""")
def q_content_features(spark, sf_dir):
    return content_features(spark, sf_dir).select("item_id", "block", "feature", shown("value").alias("value"))


@register("feature_mapping", "C6 W2 J8", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES}
SELECT item_id, title IS NOT NULL AS has_metadata,
       CAST(CASE WHEN COALESCE(shelves, '') = '' THEN 0 ELSE len(string_split(shelves, ',')) END AS BIGINT) AS num_shelves,
       CAST(COALESCE(m.num_authors, 0) AS BIGINT) AS num_authors,
       CAST(ROW_NUMBER() OVER (ORDER BY item_id) - 1 AS BIGINT) AS matrix_idx
FROM docs LEFT JOIN (SELECT item_id, num_authors FROM meta) m USING (item_id)
""")
def q_feature_mapping(spark, sf_dir):
    return features.feature_mapping(book_metadata(spark, sf_dir), catalog_of(spark, sf_dir))


@register("feature_stats", "C7 A11", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES},
n AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM catalog),
b AS (SELECT block, CAST(COUNT(DISTINCT feature) AS BIGINT) AS dims, CAST(COUNT(*) AS BIGINT) AS nnz,
             CAST(COUNT(DISTINCT item_id) AS BIGINT) AS items_with_block FROM features GROUP BY block
      UNION ALL
      SELECT 'all', CAST(COUNT(DISTINCT (block, feature)) AS BIGINT), CAST(COUNT(*) AS BIGINT),
             CAST(COUNT(DISTINCT item_id) AS BIGINT) FROM features)
SELECT b.*, ROUND(nnz / n.n, 6) AS mean_features_per_item, ROUND(1.0 - nnz / (n.n * dims), 6) AS sparsity
FROM b, n
""")
def q_feature_stats(spark, sf_dir):
    return features.feature_stats(content_features(spark, sf_dir), catalog_of(spark, sf_dir))


def documents_as_text(spark, sf_dir):
    """(item_id, shelves) view of the documents table: whole texts as the corpus."""
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("item_id"), F.col("text").alias("shelves"))


@register("document_tfidf", "C2 A13 A15 Q15 Q16 Q17", """
WITH docs AS (SELECT doc_id AS item_id, text AS shelves FROM documents),
tokens AS (SELECT item_id, unnest(regexp_extract_all(lower(replace(COALESCE(shelves, ''), ',', ' ')),
                                                    '[a-z][a-z0-9\\-]+')) AS term FROM docs),
tf AS (SELECT item_id, term, CAST(COUNT(*) AS DOUBLE) AS tf FROM tokens GROUP BY item_id, term),
tstats AS (SELECT term, COUNT(*) AS df, SUM(tf) AS total FROM tf GROUP BY term),
vocab AS (SELECT term, df, total, LN((1.0 + (SELECT COUNT(*) FROM docs)) / (df + 1.0)) + 1.0 AS idf
          FROM tstats WHERE df >= 3 ORDER BY total DESC, term LIMIT 500),
w AS (SELECT tf.item_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term))
SELECT item_id, 'shelf' AS block, term AS feature, ROUND(w / SQRT(SUM(w * w) OVER (PARTITION BY item_id)), 6) AS value
FROM w
""")
def q_document_tfidf(spark, sf_dir):
    docs = documents_as_text(spark, sf_dir)
    return features.shelf_block(docs, docs.select("item_id")).select(
        "item_id", "block", "feature", shown("value").alias("value"))
