"""Nested book records -> one flat metadata row per catalog book.

One projection over the scan: array filters drop empty elements (P10),
``coalesce(try_cast(...), 0)`` gives missing or malformed numbers their
default (P11/Q12), strings are truncated (P12), and the shelves are ordered
by count descending with the original position as the stable tie-break (L3),
cut to ``top_n_shelves`` and only *then* cleared of empty names (Q13).
The catalog filter is a semi join (S2/P9), through ``id_map`` when the
catalog and the records use different id spaces (section 1.4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM = "item_id"

# Fixed values of the record format: field length caps and the separators of
# the joined-string columns.
TITLE_MAX = 500
AUTHORS_MAX = 500
LANGUAGE_MAX = 10
LIST_SEP = ","
AUTHOR_NAME_SEP = ", "


def _num(c: str, to: str) -> F.Column:
    return F.coalesce(F.expr(f"try_cast({c} as {to})"), F.lit(0).cast(to))


def _nonempty(x: F.Column) -> F.Column:
    return x.isNotNull() & (x != "")


def flatten_metadata(books: DataFrame, catalog: DataFrame, id_map: DataFrame | None = None,
                     top_n_shelves: int = 10) -> DataFrame:
    """Flat metadata of the catalog's books.

    ``catalog``: frame with ``item_id`` (the interaction id space).
    ``id_map``: optional (book_id_csv, book_id) bridge; with it the record's
    ``book_id`` is translated to the catalog id, without it ids are compared
    as they are.  Output ``item_id`` is always in the catalog's space.
    """
    rec = books.withColumn("_json_id", F.col("book_id").cast("bigint"))
    if id_map is not None:
        rec = rec.join(id_map.select(F.col("book_id").alias("_json_id"), F.col("book_id_csv").alias(ITEM)), "_json_id")
    else:
        rec = rec.withColumn(ITEM, F.col("_json_id"))
    authors = F.coalesce(F.col("authors"), F.array())
    author_ids = F.filter(F.transform(authors, lambda a: a["author_id"]), _nonempty)
    author_names = F.filter(F.transform(authors, lambda a: a["name"]), _nonempty)

    shelves = F.coalesce(F.col("popular_shelves"), F.array())
    keyed = F.transform(shelves, lambda s, i: F.struct(
        (-F.coalesce(s["count"].try_cast("bigint"), F.lit(0).cast("bigint"))).alias("neg_count"),
        i.alias("pos"), s["name"].alias("name"), s["count"].alias("count")))
    top = F.slice(F.array_sort(keyed), 1, top_n_shelves)
    shelf_names = F.transform(F.filter(top, lambda s: _nonempty(s["name"])), lambda s: s["name"])
    shelf_counts = F.transform(F.filter(top, lambda s: _nonempty(s["count"])),
                               lambda s: s["count"].try_cast("bigint").cast("string"))

    flat = rec.select(
        F.col(ITEM).alias("_id"),
        F.substring(F.coalesce(F.col("title"), F.lit("")), 1, TITLE_MAX).alias("title"),
        F.substring(F.array_join(author_names, AUTHOR_NAME_SEP), 1, AUTHORS_MAX).alias("authors"),
        F.array_join(author_ids, LIST_SEP).alias("author_ids"),
        F.size(author_ids).cast("bigint").alias("num_authors"),
        F.array_join(shelf_names, LIST_SEP).alias("shelves"),
        F.array_join(shelf_counts, LIST_SEP).alias("shelf_counts"),
        F.size(shelf_names).cast("bigint").alias("num_shelves"),
        _num("average_rating", "double").alias("average_rating"),
        _num("ratings_count", "bigint").alias("ratings_count"),
        _num("publication_year", "bigint").alias("publication_year"),
        _num("num_pages", "bigint").alias("num_pages"),
        F.substring(F.coalesce(F.col("language_code"), F.lit("")), 1, LANGUAGE_MAX).alias("language_code"),
    )
    # The flat columns that are used are joined, not the nested records: an inner join with
    # ids that are distinct is the semi join, but stays above the projection.
    listed = catalog.select(ITEM).distinct()
    return flat.join(listed, F.col("_id") == F.col(ITEM)).select(ITEM, *[c for c in flat.columns if c != "_id"])


def split_list(c: str) -> F.Column:
    """Comma-joined string -> array without empty elements."""
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), LIST_SEP), lambda x: x != "")


def metadata_profile(metadata: DataFrame, catalog_size_of: DataFrame | None = None) -> DataFrame:
    """One-row profile of the flattened metadata."""
    n = F.count(F.lit(1))
    return metadata.agg(
        n.cast("bigint").alias("n_books"),
        F.count_if(F.col("num_authors") > 0).cast("bigint").alias("n_with_authors"),
        F.count_if(F.col("num_shelves") > 0).cast("bigint").alias("n_with_shelves"),
        F.round(F.avg("num_shelves"), 6).alias("mean_shelves"),
        F.round(F.avg("num_authors"), 6).alias("mean_authors"),
        F.round(F.avg("average_rating"), 6).alias("mean_rating"),
        F.min(F.when(F.col("publication_year") > 0, F.col("publication_year"))).alias("min_year"),
        F.max(F.when(F.col("publication_year") > 0, F.col("publication_year"))).alias("max_year"),
        F.min(F.when(F.col("num_pages") > 0, F.col("num_pages"))).alias("min_pages"),
        F.max("num_pages").alias("max_pages"),
        F.round(F.count_if(F.col("num_authors") > 0) * 100.0 / n, 6).alias("pct_with_authors"),
        F.round(F.count_if(F.col("num_shelves") > 0) * 100.0 / n, 6).alias("pct_with_shelves"),
    )


def top_shelves(metadata: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` shelves on most books (ties by name)."""
    return (metadata.select(F.explode(split_list("shelves")).alias("shelf"))
            .groupBy("shelf").agg(F.count(F.lit(1)).cast("bigint").alias("n_books"))
            .orderBy(F.col("n_books").desc(), F.col("shelf").asc()).limit(n))
