"""Streaming ingest: exactly-once append of new interaction files."""

import tempfile

from pyspark.sql import functions as F

from shelfwise.sources import fixtures
from shelfwise.streaming.ingest import start_interaction_ingest

from conftest import SF


def _write_batch(spark, df, path):
    (df.select(F.col("user_id").cast("string"), F.col("item_id").cast("string").alias("book_id"),
               F.col("rating").cast("string"))
     .coalesce(1).write.mode("append").option("header", True).csv(path))


def test_ingest_is_incremental_and_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="ingest-")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    inter = fixtures.interactions(spark, SF)
    first = inter.where(F.col("user_id") % 2 == 0)
    second = inter.where(F.col("user_id") % 2 == 1)
    _write_batch(spark, first, src)
    start_interaction_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == first.count()
    # a rerun without new files appends nothing
    start_interaction_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == first.count()
    _write_batch(spark, second, src)
    start_interaction_ingest(spark, src, out, checkpoint=ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == inter.count()
    assert got.exceptAll(inter.select("user_id", "item_id", "rating")).count() == 0
