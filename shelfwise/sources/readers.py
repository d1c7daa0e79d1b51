"""Readers and writers for the raw inputs and the long-form tables.

Raw book records arrive as (gzipped) NDJSON whose scalars are all strings and
whose authors / shelves are arrays of structs; interactions and the id map are
CSV with a header.  Schemas are explicit: schema inference would be a second
full pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The field names of the raw records.
BOOK_STRING_FIELDS = [
    "book_id", "work_id", "title", "title_without_series", "description", "format",
    "language_code", "country_code", "publication_year", "is_ebook", "num_pages",
    "ratings_count", "text_reviews_count", "average_rating",
]

AUTHOR = T.StructType([T.StructField("author_id", T.StringType()), T.StructField("name", T.StringType())])
SHELF = T.StructType([T.StructField("count", T.StringType()), T.StructField("name", T.StringType())])

BOOKS_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in BOOK_STRING_FIELDS]
    + [T.StructField("authors", T.ArrayType(AUTHOR)), T.StructField("popular_shelves", T.ArrayType(SHELF))]
)

ID_MAP_SCHEMA = T.StructType([T.StructField("book_id_csv", T.LongType()), T.StructField("book_id", T.LongType())])


def read_books(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """NDJSON book records with the fixed raw schema.

    A ``.gz`` file is not splittable and arrives as one task per file; the
    repartition right after the scan spreads the parsing that follows.
    """
    df = spark.read.schema(BOOKS_SCHEMA).json(path)
    if path.endswith(".gz"):
        df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    return df


def read_interactions(spark: SparkSession, path: str, id_col: str = "book_id") -> DataFrame:
    """S3: interactions CSV.  The header names the columns and all are read as
    strings (no inference, which would be a second pass); the three used ones get
    a strict cast, the rest are carried unread."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col(id_col).cast("bigint").alias("item_id"),
        F.col("rating").cast("bigint").alias("rating"),
        *[F.col(c) for c in raw.columns if c not in ("user_id", id_col, "rating")],
    )


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV id -> JSON id bridge."""
    return spark.read.option("header", True).schema(ID_MAP_SCHEMA).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns become JSON strings so a CSV sink can hold them."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(field.name)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; fields are quoted only where necessary."""
    csv_ready(df).write.mode("overwrite").option("header", True).csv(path)


# ---------------------------------------------------------------------------
# Book projections of the ingest step
# ---------------------------------------------------------------------------

def extra_features(books: DataFrame) -> DataFrame:
    """Descriptive string columns of each book."""
    return books.select("book_id", "description", "format", "title", "title_without_series", "language_code",
                        "authors", "country_code")


def titles(books: DataFrame) -> DataFrame:
    """P2."""
    return books.select("book_id", "title", "title_without_series")


def simple_features(books: DataFrame) -> DataFrame:
    """Numeric columns; a bad number becomes null (try_cast), and
    is_ebook is 1 exactly for the string "true"."""
    return books.select(
        F.expr("try_cast(book_id as bigint)").alias("book_id"),
        F.expr("try_cast(work_id as bigint)").alias("work_id"),
        F.expr("try_cast(publication_year as bigint)").alias("publication_year"),
        F.when(F.col("is_ebook") == "true", 1).otherwise(0).cast("int").alias("is_ebook"),
        F.expr("try_cast(num_pages as bigint)").alias("num_pages"),
        F.expr("try_cast(ratings_count as bigint)").alias("ratings_count"),
        F.expr("try_cast(text_reviews_count as bigint)").alias("text_reviews_count"),
        F.expr("try_cast(average_rating as double)").alias("average_rating"),
    )


# ---------------------------------------------------------------------------
# Long-form matrix storage
# ---------------------------------------------------------------------------

def save_matrix(cells: DataFrame, row_map: DataFrame, col_map: DataFrame, path: str) -> None:
    """A sparse matrix is a long table of (row_idx, col_idx, value) plus
    the id maps; written as Parquet, never densified."""
    write_parquet(cells.select("row_idx", "col_idx", "value"), f"{path}/cells")
    write_parquet(row_map, f"{path}/rows")
    write_parquet(col_map, f"{path}/columns")


def load_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cells, the row map and the column map."""
    return tuple(spark.read.parquet(f"{path}/{part}") for part in ("cells", "rows", "columns"))


def check_matrix(cells: DataFrame, row_map: DataFrame, col_map: DataFrame) -> DataFrame:
    """One row telling whether the matrix shape agrees with its maps."""
    shape = cells.agg(
        (F.max("row_idx") + 1).cast("bigint").alias("max_row_plus_one"),
        (F.max("col_idx") + 1).cast("bigint").alias("max_col_plus_one"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"),
    )
    out = shape.select(
        "*",
        row_map.select(F.count(F.lit(1)).cast("bigint")).scalar().alias("n_row_ids"),
        col_map.select(F.count(F.lit(1)).cast("bigint")).scalar().alias("n_col_ids"),
    )
    return out.withColumn(
        "consistent",
        (F.col("max_row_plus_one") == F.col("n_row_ids")) & (F.col("max_col_plus_one") == F.col("n_col_ids")),
    )
