"""Weighted hybrid of collaborative and content candidates (R3, R4, R11; J11, T1, Q26).

Candidates are long tables ``(query, item_id, similarity)``.  The two sides
are merged by a full outer join on (query, item) -- a missing side scores 0 --
and every weight pair of the (small, literal) weight grid is applied in the
same pass, so all configurations share one shuffle.  Ranking is by the
combined score, ties by item id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


ITEM = "item_id"


def weight_name(w_collab: float, w_content: float) -> str:
    """A label that tells any two different weight pairs apart."""
    return f"hybrid_{float(w_collab)}_{float(w_content)}"


def parse_weights(spec: str) -> tuple[float, float]:
    """``"0.6:0.4"`` -> (0.6, 0.4)."""
    a, b = spec.split(":")
    return float(a), float(b)


def hybrid(collab: DataFrame, content: DataFrame, weights: Sequence[tuple[float, float]], k: int,
           query_col: str = "user_id", exclude_col: str | None = None) -> DataFrame:
    """Top-``k`` per (configuration, query) by w_c * collab + w_t * content.

    ``collab`` / ``content``: (query_col, item_id, similarity).  With
    ``exclude_col`` (a column of ``collab``/``content`` holding the query
    item) that item is removed from the union (T1).
    Returns (recommender, query_col, rank, item_id, score, collab_score, content_score).
    """
    c = collab.select(query_col, ITEM, F.col("similarity").alias("collab_score"))
    t = content.select(query_col, ITEM, F.col("similarity").alias("content_score"))
    merged = c.join(t, [query_col, ITEM], "full_outer")
    if exclude_col is not None:
        seeds = collab.select(query_col, exclude_col).unionByName(content.select(query_col, exclude_col)).distinct()
        merged = merged.join(seeds, query_col, "left").where(
            F.col(exclude_col).isNull() | (F.col(ITEM) != F.col(exclude_col))).drop(exclude_col)
    grid = F.explode(F.array(*[
        F.struct(F.lit(weight_name(wc, wt)).alias("recommender"), F.lit(float(wc)).alias("wc"), F.lit(float(wt)).alias("wt"))
        for wc, wt in dict.fromkeys(weights)])).alias("g")
    cs = F.coalesce(F.col("collab_score"), F.lit(0.0))
    ts = F.coalesce(F.col("content_score"), F.lit(0.0))
    scored = merged.select("*", grid).select(
        F.col("g.recommender").alias("recommender"), query_col, ITEM,
        (F.col("g.wc") * cs + F.col("g.wt") * ts).alias("score"),
        cs.alias("collab_score"), ts.alias("content_score"))
    w = Window.partitionBy("recommender", query_col).orderBy(F.col("score").desc(), F.col(ITEM).asc())
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("recommender", query_col, F.col("rank").cast("bigint").alias("rank"), ITEM, "score",
                    "collab_score", "content_score"))


def single_method(cands: DataFrame, method: str, k: int, query_col: str = "user_id") -> DataFrame:
    """A one-sided list in the hybrid shape, the other side scored 0."""
    collab = method == "collaborative"
    return cands.where(F.col("rank") <= k).select(
        F.lit(method).alias("recommender"), query_col, F.col("rank").cast("bigint").alias("rank"), ITEM,
        F.col("similarity").alias("score"),
        (F.col("similarity") if collab else F.lit(0.0)).alias("collab_score"),
        (F.lit(0.0) if collab else F.col("similarity")).alias("content_score"))
