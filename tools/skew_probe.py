"""Hot-key probe for the collaborative KNN.

Derives, with Spark, an interaction table in which one user holds a third of
all rows (every third line item is re-assigned to user -1), then runs the
all-pairs KNN with hot-user blocking and with blocking disabled, reporting
wall time and whether the two results are identical.

usage: python tools/skew_probe.py [sf_dir] [block_items] [--blocked-only]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.operators import neighbors, prepare  # noqa: E402
from shelfwise.session import get_spark  # noqa: E402
from shelfwise.sources import fixtures  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    block = int(sys.argv[2]) if len(sys.argv) > 2 else 256
    blocked_only = "--blocked-only" in sys.argv
    spark = get_spark("local[8]", 16, extra={"spark.driver.memory": "12g"})
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    inter = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.when(F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
        .cast("bigint").alias("user_id"),
        F.col("l_partkey").alias("item_id"), (F.col("l_quantity").cast("bigint") % 6).alias("rating"))
    cells = prepare.rating_cells(inter)
    hot = cells.where(F.col("user_id") == -1).count()
    print(f"cells {cells.count()}, hot user cells {hot}")
    if not blocked_only:
        neighbors.item_neighbors(cells, k=10, block_items=block).collect()  # warm-up
    out = {}
    runs = (("blocked", block),) if blocked_only else (("unblocked", 10 ** 9), ("blocked", block))
    for label, b in runs:
        t0 = time.time()
        df = neighbors.item_neighbors(cells, k=10, block_items=b)
        rows = sorted(df.collect())
        out[label] = rows
        print(f"{label:10s} block_items={b:<11d} {time.time() - t0:6.2f}s rows={len(rows)}")
    if not blocked_only:
        print("identical:", out["blocked"] == out["unblocked"])
    spark.stop()


if __name__ == "__main__":
    main()
