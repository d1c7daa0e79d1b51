"""Catalog coverage at every cutoff from bitmaps that merge over runs.

A recommender's items at a cutoff are bits at their places in the catalog, in buckets of
32,768 bits (4 KB).  A task turns its lists into bitmaps before anything is shuffled, so
the shuffle holds at most tasks x recommenders x cutoffs x catalog / 32,768 bitmaps
however many lists there are; a distinct count would shuffle the items.  The bitmaps of
one run can be stored, and those of several runs be merged without their lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM = "item_id"
KEYS = ["recommender", "k", "bucket"]


def item_bitmaps(recs: DataFrame, places: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """``recommender, k, bucket, items``: the bits of the items within the first k.

    ``recs`` (recommender, rank, item_id), ``places`` (matrix_idx, item_id) as
    ``prepare.index_ids`` gives for the catalog.  Items outside the catalog, null items
    and null ranks set no bit; an item recommended many times sets one.
    """
    if not k_values:
        raise ValueError("k_values must be non-empty")
    listed = recs.where(F.col("rank") <= max(k_values)).select("recommender", "rank", ITEM)
    at = F.col("matrix_idx") + 1  # bit positions count from 1
    ks = F.explode(F.array(*[F.lit(int(k)) for k in sorted(set(k_values))])).alias("k")
    bits = listed.join(places, ITEM).select("recommender", "rank", F.bitmap_bucket_number(at).alias("bucket"),
                                            F.bitmap_bit_position(at).alias("bit"), ks)
    return bits.where(F.col("rank") <= F.col("k")).groupBy(*KEYS).agg(F.bitmap_construct_agg("bit").alias("items"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The union of the items of several runs' bitmaps (one table over the other)."""
    return bitmaps.groupBy(*KEYS).agg(F.bitmap_or_agg("items").alias("items"))


def bitmap_coverage(bitmaps: DataFrame, catalog_size: int, recommenders: Sequence[str],
                    k_values: Sequence[int]) -> DataFrame:
    """``recommender, k, n_distinct, catalog_coverage`` for every recommender and
    cutoff; one without bits, and any over an empty catalog, covers 0."""
    spark = bitmaps.sparkSession
    every = spark.createDataFrame([(r, int(k)) for r in recommenders for k in sorted(set(k_values))], "recommender string, k int")
    counted = bitmaps.select("recommender", "k", F.bitmap_count("items").alias("n"))
    rows = counted.unionByName(every.withColumn("n", F.lit(0).cast("bigint")))
    n = rows.where(F.col("recommender").isin(list(recommenders))).groupBy("recommender", "k").agg(F.sum("n").alias("n_distinct"))
    share = F.col("n_distinct") / F.lit(float(catalog_size)) if catalog_size else F.lit(0.0)
    return n.select("recommender", "k", "n_distinct", share.alias("catalog_coverage"))
