"""Adapters from the driver's star-schema tables onto the engine's inputs.

The engine's own inputs are interactions ``(user_id, item_id, rating)``, raw
book records (the nested NDJSON schema of ``readers.BOOKS_SCHEMA``), an id map
and dense item vectors.  The test tables are mapped onto them so that every
query's work grows with the tables:

* interactions: one row per line item; the buyer is the user, the part is the
  item, ``quantity mod 6`` the rating (0 = an explicit "unrated" entry).
* raw books: one record per part.  Title is the part name, authors are the
  distinct suppliers of its line items, shelves are the lower-cased market
  segments and order priorities of its buyers with their counts, and the
  numeric strings come from the part and its orders.
* id bridge: part key -> ten times the key plus one, with gaps.
* vectors: the ``embeddings`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import bound_partitions

# Gaps of the bridge fixtures.
NO_BRIDGE, NO_TITLE = 40, 50
# Up to so many suppliers are sent to every task; more are joined by a shuffle.
BROADCAST_SUPPLIERS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_partitions(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", _rating().alias("rating"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        "rating",
    )


def _rating():
    return F.col("l_quantity").cast("bigint") % 6


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # orders meet their buyers first, so that the lines are dealt by order only
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    bought = orders.join(cust, F.col("o_custkey") == cust.c_custkey).select(
        "o_orderkey", F.year("o_orderdate").cast("smallint").alias("year"), F.lower("c_mktsegment").alias("segment"), F.lower("o_orderpriority").alias("priority"))
    li = table(spark, sf_dir, "lineitem").where("l_partkey is not null").select(
        "l_orderkey", "l_partkey", "l_suppkey", _rating().cast("tinyint").alias("rating"))
    return li.join(bought, li.l_orderkey == bought.o_orderkey).drop("l_orderkey", "o_orderkey")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, named): every supplier once, with its rows' ids and names."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").where("s_suppkey is not null")
    once = supplier.groupBy("s_suppkey").agg(F.collect_list(F.struct("s_suppkey", "s_name")).alias("named"))
    return F.broadcast(once) if supplier.count() <= BROADCAST_SUPPLIERS else once


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, all-string book records derived from part and its line items.

    The lines are dealt by part once.  There a line is a row for each of its two shelf
    names and one for its supplier, which are counted by part and name or supplier, and
    then gathered by part."""
    lines = _lines(spark, sf_dir).repartition("l_partkey")
    part = table(spark, sf_dir, "part")
    none = {"name": F.lit(None).cast("string"), "supp": F.lit(None).cast("bigint"),
            "rating": F.lit(None).cast("tinyint"), "year": F.lit(None).cast("smallint")}

    def kind(shelf, **own):
        return F.struct(F.lit(shelf).alias("shelf"), *[(own.get(c, x)).alias(c) for c, x in none.items()])

    rows = lines.select("l_partkey", F.inline(F.array(
        kind(True, name=F.col("segment")), kind(True, name=F.col("priority")),
        kind(False, supp=F.col("l_suppkey"), rating=F.col("rating"), year=F.col("year")))))
    counted = rows.groupBy("l_partkey", "shelf", "name", "supp").agg(
        F.count(F.lit(1)).alias("cnt"), F.count("rating").alias("rated"),
        F.sum("rating").alias("ratings"), F.min("year").alias("first"))
    named = counted.join(_suppliers(spark, sf_dir), F.col("supp") == F.col("s_suppkey"), "left")
    shelf, mean = F.col("shelf"), F.sum("ratings") / F.nullif(F.sum("rated"), F.lit(0))
    stats = named.groupBy("l_partkey").agg(
        F.sum(F.when(~shelf, F.col("cnt"))).alias("n_lines"),
        # two decimals as floor(x * 100 + 0.5) / 100: the same IEEE steps in any engine
        (F.floor(mean * 100 + 0.5) / 100).alias("avg_rating"),
        F.min("first").cast("int").alias("first_year"),
        F.array_sort(F.collect_list(F.when(shelf, F.struct("name", "cnt")))).alias("by_name"),
        F.array_sort(F.flatten(F.collect_list("named"))).alias("by_id"),
    ).select(
        "l_partkey", "n_lines", "avg_rating", "first_year",
        F.transform("by_name", lambda s: F.struct(s["cnt"].cast("string").alias("count"), s["name"].alias("name")))
        .alias("popular_shelves"),
        F.when(F.size("by_id") > 0, F.transform("by_id", lambda a: F.struct(
            a["s_suppkey"].cast("string").alias("author_id"), a["s_name"].alias("name")))).alias("authors"),
    )
    books = part.join(stats, part.p_partkey == stats.l_partkey, "left").drop("l_partkey")
    return books.select(
        F.col("p_partkey").cast("string").alias("book_id"),
        F.col("p_partkey").cast("string").alias("work_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("title_without_series"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
        F.col("p_type").alias("format"),
        F.concat_ws("-", F.lower("p_type"), F.lower("p_brand")).alias("language_code"),
        F.lit(None).cast("string").alias("country_code"),
        F.col("first_year").cast("string").alias("publication_year"),
        F.when(F.col("p_size") % 2 == 0, "true").otherwise("false").alias("is_ebook"),
        F.col("p_size").cast("string").alias("num_pages"),
        F.col("n_lines").cast("string").alias("ratings_count"),
        F.col("n_lines").cast("string").alias("text_reviews_count"),
        F.col("avg_rating").cast("string").alias("average_rating"),
        "authors",
        "popular_shelves",
    )


def record_id(item_id):
    """The records' id of an item in the second id space of the bridge fixtures."""
    return item_id * 10 + 1


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction id -> record id; items divisible by NO_BRIDGE are missing."""
    part = table(spark, sf_dir, "part").where(F.col("p_partkey") % NO_BRIDGE != 0)
    return part.select(F.col("p_partkey").alias("book_id_csv"), record_id(F.col("p_partkey")).alias("book_id"))


def record_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title) by record id; items divisible by NO_TITLE have none."""
    part = table(spark, sf_dir, "part").where(F.col("p_partkey") % NO_TITLE != 0)
    return part.select(record_id(F.col("p_partkey")).alias("item_id"), F.col("p_name").alias("title"))


def title_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title) of every part."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, vector array<double>) from the embeddings table."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("item_id"),
                      F.transform("embedding", lambda x: x.cast("double")).alias("vector"))


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second interaction source: every event is an implicit rating 1 of the
    item named by its ``k`` property."""
    ev = table(spark, sf_dir, "events").select("user_id", "props")
    return ev.select("user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
                     F.lit(1).cast("bigint").alias("rating")).where(F.col("item_id").isNotNull())
