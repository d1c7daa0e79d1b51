"""Content features in long form (C2-C7; Q15-Q21).

``content_features`` returns one row per non-zero entry:
(item_id, block, feature, value), block in {shelf, author, numeric}.  Each
block is L2-normalised per item, so an item's full vector has norm
sqrt(number of non-empty blocks) and the cosine of two items is
(sum of per-block dots) / sqrt(blocks_a * blocks_b)  (Q21) -- no wide vector
is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.metadata import split_list
from shelfwise.operators.ordering import global_index
from shelfwise.session import cut_lineage

ITEM = "item_id"

# Fixed values of the shelf vectoriser: the token pattern applied to the
# lower-cased, comma-to-space shelf text, and the default vocabulary limits.
TOKEN_PATTERN = r"[a-z][a-z0-9\-]+"
MAX_TERMS = 500
MIN_DF = 3
MIN_AUTHOR_ITEMS = 2

# Items of a task that gathers their terms and authors.  Rows, not bytes: shelf names pack
# so well that 4 MB of a shuffle hold some hundred thousand items.
ITEMS_OF_TASK = 8192

NUMERIC_FEATURES = ["log_ratings_count", "rating_over_5", "year_offset", "log_pages"]


def _docs(metadata: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every catalog item (also those without metadata) with its metadata row."""
    return catalog.select(ITEM).distinct().join(metadata, ITEM, "left")


def shelf_vocabulary(metadata: DataFrame, catalog: DataFrame, max_terms: int = MAX_TERMS,
                     min_df: int = MIN_DF) -> tuple[DataFrame, DataFrame]:
    """(term frequencies per item, vocabulary with idf).

    idf = ln((1 + N) / (1 + df)) + 1 over N = all catalog items (Q17); the
    vocabulary keeps df >= ``min_df`` and then the ``max_terms`` terms of
    highest total count, ties by term (Q16).
    """
    docs = _docs(metadata, catalog)
    return _vocabulary(docs, docs.select(F.count(F.lit(1)).cast("double")).scalar(), max_terms, min_df)


def _vocabulary(docs: DataFrame, n_docs: Column, max_terms: int, min_df: int) -> tuple[DataFrame, DataFrame]:
    text = F.lower(F.replace(F.coalesce(F.col("shelves"), F.lit("")), F.lit(","), F.lit(" ")))
    tokens = docs.select(ITEM, F.explode(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)).alias("term"))
    tf = tokens.groupBy(ITEM, "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocab = (stats.where(F.col("df") >= min_df)
             .orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_terms)
             .select("term", "df", "total", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0).alias("idf")))
    return tf, vocab


def shelf_block(metadata: DataFrame, catalog: DataFrame, max_terms: int = MAX_TERMS, min_df: int = MIN_DF) -> DataFrame:
    """Raw tf x smoothed idf, L2-normalised per item."""
    return _shelf_entries(*shelf_vocabulary(metadata, catalog, max_terms, min_df))


def _shelf_entries(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    # The vocabulary has at most max_terms rows: a bounded broadcast.
    w = tf.join(F.broadcast(vocab.select("term", "idf")), "term").select(ITEM, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(ITEM)))
    return w.select(ITEM, F.lit("shelf").alias("block"), F.col("term").alias("feature"), (F.col("w") / norm).alias("value"))


def author_block(metadata: DataFrame, catalog: DataFrame, min_items: int = MIN_AUTHOR_ITEMS) -> DataFrame:
    """Author set one-hot (duplicates once), authors on >= ``min_items``
    catalog books, each kept author weighing 1/sqrt(m) (Q19)."""
    return _author_entries(_docs(metadata, catalog), min_items)


def _author_entries(docs: DataFrame, min_items: int) -> DataFrame:
    pairs = docs.select(ITEM, F.explode(F.array_distinct(split_list("author_ids"))).alias("feature"))
    keep = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_items).select("feature")
    kept = pairs.join(keep, "feature", "left_semi")
    m = F.count(F.lit(1)).over(Window.partitionBy(ITEM))
    return kept.select(ITEM, F.lit("author").alias("block"), "feature", (F.lit(1.0) / F.sqrt(m)).alias("value"))


def numeric_block(metadata: DataFrame, catalog: DataFrame) -> DataFrame:
    """C4: four numeric features, L2-normalised per item; zeros dropped (Q20)."""
    return _numeric_entries(_docs(metadata, catalog))


def _numeric_entries(docs: DataFrame) -> DataFrame:
    docs = docs.where(F.col("title").isNotNull() | F.col("num_pages").isNotNull())
    year = F.col("publication_year")
    raw = [
        F.log1p(F.col("ratings_count").cast("double")),
        F.col("average_rating") / 5.0,
        F.when(year > 0, (year - 1900) / 100.0).otherwise(F.lit(0.0)),
        F.log1p(F.col("num_pages").cast("double")) / 10.0,
    ]
    vals = docs.select(ITEM, *[r.alias(n) for r, n in zip(raw, NUMERIC_FEATURES)])
    norm = F.sqrt(sum((F.col(n) * F.col(n) for n in NUMERIC_FEATURES), F.lit(0.0)))
    long = vals.select(ITEM, norm.alias("norm"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).alias("v")) for n in NUMERIC_FEATURES])).alias("f"))
    return (long.where((F.col("f.v") != 0) & (F.col("norm") > 0))
            .select(ITEM, F.lit("numeric").alias("block"), F.col("f.feature").alias("feature"),
                    (F.col("f.v") / F.col("norm")).alias("value")))


def content_features(metadata: DataFrame, catalog: DataFrame, max_terms: int = MAX_TERMS, min_df: int = MIN_DF,
                     min_author_items: int = MIN_AUTHOR_ITEMS) -> DataFrame:
    """The three normalised blocks stacked in long form.

    The catalog-aligned metadata (one row per catalog item) feeds the three
    blocks, the vocabulary and the document count; it is written once to the
    checkpoint folder instead of being derived five times.  It is already aligned,
    so the blocks read it without joining the catalog again, and it is dealt by
    item into tasks of about ``ITEMS_OF_TASK`` items.
    """
    cols = ["title", "shelves", "author_ids", "num_authors", "ratings_count", "average_rating",
            "publication_year", "num_pages"]
    docs = cut_lineage(_docs(metadata.select(ITEM, *cols), catalog))
    n_docs = docs.count()
    dealt = docs.repartition(max(1, -(-n_docs // ITEMS_OF_TASK)), ITEM)
    return (_shelf_entries(*_vocabulary(dealt, F.lit(float(n_docs)), max_terms, min_df))
            .unionByName(_author_entries(dealt, min_author_items))
            .unionByName(_numeric_entries(docs)))


def feature_mapping(metadata: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog order index with metadata flags."""
    docs = _docs(metadata, catalog)
    flags = docs.select(
        ITEM,
        F.col("title").isNotNull().alias("has_metadata"),
        F.size(split_list("shelves")).cast("bigint").alias("num_shelves"),
        F.coalesce(F.col("num_authors"), F.lit(0)).cast("bigint").alias("num_authors"),
    )
    return global_index(flags, [F.col(ITEM).asc()], "matrix_idx")


def feature_stats(features: DataFrame, catalog: DataFrame) -> DataFrame:
    """Dimensions and entries per block plus the whole-matrix sparsity."""
    n_items = catalog.select(ITEM).distinct().select(F.count(F.lit(1)).cast("double")).scalar()
    per_block = features.groupBy("block").agg(
        F.countDistinct("feature").cast("bigint").alias("dims"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"),
        F.countDistinct(ITEM).cast("bigint").alias("items_with_block"),
    )
    total = features.agg(
        F.lit("all").alias("block"),
        F.countDistinct("block", "feature").cast("bigint").alias("dims"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"),
        F.countDistinct(ITEM).cast("bigint").alias("items_with_block"),
    )
    both = per_block.unionByName(total)
    return both.select(
        "*",
        F.round(F.col("nnz") / n_items, 6).alias("mean_features_per_item"),
        F.round(F.lit(1.0) - F.col("nnz") / (n_items * F.col("dims")), 6).alias("sparsity"),
    )


def catalog_alignment(catalog: DataFrame, features: DataFrame, metadata: DataFrame) -> DataFrame:
    """How much of the collaborative catalog has content features and
    metadata (the hybrid's index-mapping and metadata coverage)."""
    cat = catalog.select(ITEM).distinct()
    fi = features.select(ITEM).distinct()
    n = F.count(F.lit(1)).cast("bigint")
    n_cat = cat.select(n).scalar()
    aligned = cat.join(fi, ITEM).select(n).scalar()
    with_meta = cat.join(metadata.select(ITEM), ITEM).select(n).scalar()
    return cat.agg(n.alias("n_collab")).select(
        "n_collab", fi.select(n).scalar().alias("n_content"), aligned.alias("n_aligned"),
        with_meta.alias("n_with_metadata"),
        F.round(F.lit(100.0) * aligned / n_cat, 6).alias("pct_aligned"),
        F.round(F.lit(100.0) * with_meta / n_cat, 6).alias("pct_with_metadata"))
