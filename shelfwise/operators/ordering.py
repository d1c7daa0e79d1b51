"""Global positions without funnelling rows through one task.

``row_number() over (order by ...)`` with no partition key runs in a single
task, and ``orderBy().limit(n)`` merges up to ``partitions x n`` rows in one
task.  For dense 0-based indices (W2) and large top-N cuts we range-partition
instead, freeze the partition assignment with a reliable checkpoint, count
rows per partition (one small row per partition), and number each sorted
partition from its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

# Up to this many rows a top-N is a report and is left to Spark's
# TakeOrderedAndProject, whose final merge holds at most partitions x n rows.
TAKE_ORDERED_MAX = 1_000


def global_index(df: DataFrame, order_cols: list[Column], name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order.

    ``order_cols`` must make the order total (end with a unique key).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition; the offsets join back on the partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_pid"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    # rows of a written partition stay in order: their increasing id less the partition's start is their place
    placed = ranged.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return placed.join(F.broadcast(offsets), "_pid").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_place") + F.col("_offset")).cast("bigint").alias(name))


def top_n(df: DataFrame, n: int, order_cols: list[Column]) -> DataFrame:
    """First ``n`` rows in ``order_cols`` order (ties must be broken by the caller's columns)."""
    if n <= 0:
        return df.limit(0)
    if n <= TAKE_ORDERED_MAX:
        return df.orderBy(*order_cols).limit(n)
    return global_index(df, order_cols, "_pos").where(F.col("_pos") < n).drop("_pos")
