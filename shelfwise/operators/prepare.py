"""Interaction preparation: activity filter, top-N cuts, rating cells.

All functions take and return long tables; the books x users matrix is never
densified: the wide table is its long form, ``rating_cells`` with the "first"
policy, in which a missing cell means 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ordering import global_index, top_n
from shelfwise.session import cut_lineage

USER, ITEM, RATING = "user_id", "item_id", "rating"


def active_filter(interactions: DataFrame, min_reads: int = 10) -> DataFrame:
    """Keep rows whose user AND item each have >= ``min_reads`` rows.

    Both counts come from the unfiltered input and are applied once (not an
    iterated k-core); duplicate rows each count; null keys never match.
    The counts are partial-aggregated before their shuffle, and the two
    semi joins let AQE broadcast a small key set or split a skewed key.
    """
    users = interactions.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_reads).select(USER)
    items = interactions.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_reads).select(ITEM)
    return interactions.join(users, USER, "left_semi").join(items, ITEM, "left_semi")


def _counts(interactions: DataFrame, key: str) -> DataFrame:
    return interactions.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n_interactions"))


def top_users(interactions: DataFrame, n: int = 1_000_000) -> DataFrame:
    """L1: the ``n`` users with most rows; ties by id ascending."""
    return top_n(_counts(interactions, USER), n, [F.col("n_interactions").desc(), F.col(USER).asc()])


def top_items(interactions: DataFrame, n: int = 50_000) -> DataFrame:
    """L2: the ``n`` items with most rows; ties by id ascending."""
    return top_n(_counts(interactions, ITEM), n, [F.col("n_interactions").desc(), F.col(ITEM).asc()])


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key_cols: list[str] | None = None) -> DataFrame:
    """Seeded fraction sample.

    With ``key_cols`` the draw is a hash bucket of the key (md5 of
    ``seed|key``), identical in any engine and stable under recomputation;
    without, Spark's Bernoulli sampler.
    """
    if fraction >= 1.0:
        return df
    if not key_cols:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])), 1, 8), 16, 10)
    return df.where(bucket.cast("double") / F.lit(4294967296.0) < F.lit(fraction))


def prepare(interactions: DataFrame, min_reads: int = 10, n_items: int = 50_000, n_users: int = 1_000_000,
            sample: float = 1.0, seed: int = 42) -> DataFrame:
    """Sample -> activity filter -> restrict to top users and top items.

    Top users and top items are taken independently from the same filtered
    frame, then both applied as semi joins.
    """
    src = sample_fraction(interactions, sample, seed, key_cols=[USER, ITEM]) if sample < 1.0 else interactions
    filtered = cut_lineage(active_filter(src, min_reads))  # read four times below
    users = top_users(filtered, n_users).select(USER)
    items = top_items(filtered, n_items).select(ITEM)
    return filtered.join(users, USER, "left_semi").join(items, ITEM, "left_semi")


def rating_cells(interactions: DataFrame, dup_policy: str = "sum", order_col: str | None = None) -> DataFrame:
    """A2/Q6: one row per (item, user).  ``sum`` adds duplicate ratings (the
    sparse build); ``first`` keeps the rating of the smallest ``order_col``
    (the dense pivot), which needs an explicit order to be deterministic.
    Zero ratings stay as stored cells (Q7)."""
    if dup_policy == "sum":
        agg = F.sum(RATING).cast("double").alias(RATING)
    elif dup_policy == "first":
        if order_col is None:
            raise ValueError("dup_policy='first' needs order_col")
        agg = F.min_by(RATING, order_col).cast("double").alias(RATING)
    else:
        raise ValueError(f"unknown dup_policy {dup_policy!r}")
    return interactions.groupBy(ITEM, USER).agg(agg)


def index_ids(df: DataFrame, col: str, name: str = "matrix_idx") -> DataFrame:
    """Dense 0-based index of the sorted distinct ids of ``col``."""
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_index(ids, [F.col(col).asc()], name).select(F.col(name), F.col(col))


def rating_matrix(interactions: DataFrame, dup_policy: str = "sum") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sparse books x users matrix for export: (cells with indices, item map, user map)."""
    cells = rating_cells(interactions, dup_policy)
    item_map = index_ids(cells, ITEM).withColumnRenamed("matrix_idx", "row_idx")
    user_map = index_ids(cells, USER).withColumnRenamed("matrix_idx", "col_idx")
    indexed = (cells.join(item_map, ITEM).join(user_map, USER)
               .select("row_idx", "col_idx", F.col(RATING).alias("value"), ITEM, USER))
    return indexed, item_map, user_map


def matrix_stats(cells: DataFrame) -> DataFrame:
    """A4/A5/Q9: shape, stored entries, density and sparsity (named as what
    they are), and the dense vs. sparse storage estimate in bytes."""
    s = cells.agg(
        F.countDistinct(ITEM).cast("bigint").alias("n_items"),
        F.countDistinct(USER).cast("bigint").alias("n_users"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"),
        F.count_if(F.col(RATING) != 0).cast("bigint").alias("n_nonzero_ratings"),
    )
    cellsz = F.col("n_items").cast("double") * F.col("n_users").cast("double")
    return s.select(
        "*",
        F.round(F.col("nnz") / cellsz, 9).alias("density"),
        F.round(F.lit(1.0) - F.col("nnz") / cellsz, 9).alias("sparsity"),
        (cellsz * 8).cast("bigint").alias("dense_bytes"),
        (F.col("nnz") * 12 + (F.col("n_items") + 1) * 4).cast("bigint").alias("sparse_bytes"),
    )
