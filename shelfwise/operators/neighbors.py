"""Exact item-item cosine top-K (R1, R5, R8; J14, W1; Q7, Q23, Q24).

Collaborative similarity is a sparse product of the ratings over the users:

1. cells with a zero rating are stored entries but add nothing to a dot
   product, so they are dropped here (they still count in ``matrix_stats``);
2. each rating is divided by its item's L2 norm, so the summed products *are*
   the cosine and no norm join follows the pair aggregation;
3. all pairs: items are dealt into blocks of about ``BLOCK_RATINGS`` ratings and
   a task gets the ratings of two blocks.  It forms the products of a bounded
   number of ratings at a time and returns the top-k of each item of either
   block, so no pair becomes a row or is shuffled.  More than ``BLOCK_RATINGS``
   ratings are written once, in blocks: a task has the items of one and reads the
   others from storage, as a shuffle would hold each rating once for every block;
4. seeds: a join on the user, by broadcast where the seeds have few ratings.  Else a user with more than ``block_items`` rated items
   is a hot key: its items are split into ``ceil(degree / block_items)`` hash
   blocks and the join key becomes (user, left block, right block), so no task
   ever multiplies more than ``block_items`` x ``block_items`` ratings of one
   user.  Other users get one block and are not replicated.  Per-pair sums are
   partial-aggregated in the join stage before the shuffle;
5. the per-item cut is a ``row_number`` filter that Spark plans as a partial +
   final ``WindowGroupLimit``.

Lists are padded to ``k`` with zero-similarity items, in id order, excluding
the item itself and its positive neighbours (the brute-force KNN of the
reference returns such items at distance 1).  With non-negative ratings the
pad candidates are the first ``k + 1`` catalog ids, a bounded set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.common import RANK_DIGITS, score
from shelfwise.operators.blocks import query_blocks
from shelfwise.operators.vector_knn import PRODUCTS, best_of, ids_of, lists_of, products, sparse_cosine_topk
from shelfwise.session import cut_lineage

USER, ITEM, RATING = "user_id", "item_id", "rating"

# Items of one user handled by a single join task (see 4. above).
DEFAULT_BLOCK_ITEMS = 1024
# Ratings of seeds that are sent to every task, at most (32 bytes each).
SEED_RATINGS = 200_000
# Most ratings that are shuffled once per block, and the blocks that they are parted into.
BLOCK_RATINGS = 6_000_000
BLOCKS = 8
# Ratings of a stored block of items (24 bytes each in a task).
STORED_RATINGS = 3_000_000


def unit_ratings(cells: DataFrame) -> DataFrame:
    """(item_id, user_id, w): non-zero ratings scaled to unit item norm."""
    nz = cells.where(F.col(RATING) != 0).select(ITEM, USER, F.col(RATING).cast("double").alias(RATING))
    norms = nz.groupBy(ITEM).agg(F.sqrt(F.sum(F.col(RATING) * F.col(RATING))).alias("norm"))
    return nz.join(norms, ITEM).select(ITEM, USER, (F.col(RATING) / F.col("norm")).alias("w"))


def _with_blocks(unit: DataFrame, block_items: int) -> DataFrame:
    """Attach ``n_blocks`` per user: 1, or ceil(degree / block_items) for hot users.

    The hot-user table has at most rows / block_items entries; the planner
    broadcasts it when its measured size is small and shuffles otherwise.
    """
    degree = unit.groupBy(USER).agg(F.count(F.lit(1)).alias("deg"))
    hot = degree.where(F.col("deg") > block_items).select(
        USER, F.ceil(F.col("deg") / F.lit(block_items)).cast("int").alias("n_blocks"))
    return unit.join(hot, USER, "left").withColumn("n_blocks", F.coalesce(F.col("n_blocks"), F.lit(1)))


def _block_of(item_col: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(item_col)), F.col("n_blocks")).cast("int")


def _fan_out() -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))


def pair_dots(unit: DataFrame, block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """(i, j, dot) for every co-rated pair with i < j."""
    blocked = _with_blocks(unit, block_items)
    left = blocked.select(USER, F.col(ITEM).alias("i"), F.col("w").alias("wi"),
                          _block_of(ITEM).alias("bl"), _fan_out().alias("br"))
    right = blocked.select(USER, F.col(ITEM).alias("j"), F.col("w").alias("wj"),
                           _block_of(ITEM).alias("br"), _fan_out().alias("bl"))
    pairs = left.join(right, [USER, "bl", "br"]).where(F.col("i") < F.col("j"))
    return pairs.groupBy("i", "j").agg(F.sum(F.col("wi") * F.col("wj")).alias("dot"))


def seed_dots(unit: DataFrame, seed_items: DataFrame, block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """(i, j, dot) for seed items i against every co-rated item j != i.

    Up to ``SEED_RATINGS`` ratings of seeds are sent to every task, and the other
    ratings are not shuffled.  ``unit`` is read twice."""
    # A small seed set is broadcast by the planner from its measured size, a large one shuffled.
    seeds = seed_items.select(ITEM).distinct()
    asked = cut_lineage(unit.join(seeds, ITEM, "left_semi").select(USER, F.col(ITEM).alias("i"), F.col("w").alias("wi")))
    if asked.count() <= SEED_RATINGS:
        pairs = unit.join(F.broadcast(asked), USER).where(F.col("i") != F.col(ITEM))
        return pairs.groupBy("i", F.col(ITEM).alias("j")).agg(F.sum(F.col("wi") * F.col("w")).alias("dot"))
    blocked = _with_blocks(unit, block_items)
    left = (blocked.join(seeds, ITEM, "left_semi")
            .select(USER, F.col(ITEM).alias("i"), F.col("w").alias("wi"), _block_of(ITEM).alias("bl"), _fan_out().alias("br")))
    right = blocked.select(USER, F.col(ITEM).alias("j"), F.col("w").alias("wj"), _block_of(ITEM).alias("br"),
                           _fan_out().alias("bl"))
    pairs = left.join(right, [USER, "bl", "br"]).where(F.col("i") != F.col("j"))
    return pairs.groupBy("i", "j").agg(F.sum(F.col("wi") * F.col("wj")).alias("dot"))


def _best_of_block(seeds: tuple, items: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed ids, neighbour ids and similarities: for each seed its ``k`` best of the items
    that share a user.  A side: ids, and the row numbers, users and weights of its
    ratings; rows in order."""
    seed_ids, seed_row, seed_user, seed_w = seeds
    ids, row, user, w = items
    if (np.diff(user) < 0).any():
        by_user = np.argsort(user, kind="stable")
        user, row, w = user[by_user], row[by_user], w[by_user]
    begins = np.flatnonzero(np.diff(user, prepend=user[:1] - 1))
    names, sizes = user[begins], np.diff(begins, append=len(user))
    # looked up in the users' order, which is many times faster
    order = np.argsort(seed_user, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.minimum(np.searchsorted(names, seed_user[order]), len(names) - 1)
    known = names[place] == seed_user
    seed_row, seed_w, place = seed_row[known], seed_w[known], place[known]
    counts = sizes[place]
    # seeds are taken together up to a number of products; one with more is summed in parts
    work = np.bincount(seed_row, weights=counts, minlength=len(seed_ids)).cumsum()
    found, s0 = [], 0
    while s0 < len(seed_ids):
        before = work[s0 - 1] if s0 else 0
        s1 = max(s0 + 1, int(np.searchsorted(work, before + PRODUCTS, side="right")))
        own = slice(*np.searchsorted(seed_row, (s0, s1)))
        whole = work[s1 - 1] - before > PRODUCTS
        keys, dots, dense = np.zeros(0, np.int64), np.zeros(0), np.zeros(len(ids) if whole else 0)
        for entry, at in products(begins[place[own]], counts[own]):
            value = seed_w[own][entry] * w[at]
            if whole:
                dense += np.bincount(row[at], weights=value, minlength=len(ids))
                continue
            pair = (seed_row[own][entry] - s0) * len(ids) + row[at]
            order = np.argsort(pair, kind="stable")
            keys, first = np.unique(pair[order], return_index=True)
            dots = np.add.reduceat(value[order], first)
        if whole:
            keys = np.flatnonzero(dense)
            dots = dense[keys]
        similarity = np.round(dots, RANK_DIGITS)
        r, neighbor = keys // len(ids) + s0, ids[keys % len(ids)]
        keep = (similarity > 0) & (neighbor != seed_ids[r])
        r, neighbor, similarity = best_of(r[keep], neighbor[keep], similarity[keep], k)
        found.append((seed_ids[r], neighbor, similarity))
        s0 = s1
    return tuple(np.concatenate(x) for x in zip(*found))


def block_pair_lists(table: pa.Table, k: int) -> pa.Table:
    """The lists of the items of two blocks within the other (``own`` rows are those of
    the first, the others those of the second), or of one block within itself."""
    def side(part: pa.Table) -> tuple:
        (row, user), (_, w) = lists_of(part, "users"), lists_of(part, "ws")
        return ids_of(part), row, user, w

    own = table.column("own").to_numpy()
    first, second = table.filter(pa.array(own)), table.filter(pa.array(~own))
    if table.column("left")[0].as_py() == table.column("right")[0].as_py():
        met = [(side(first), side(first))]
    elif len(first) and len(second):
        a, b = side(first), side(second)
        met = [(a, b), (b, a)]
    else:
        met = []
    lists = [_best_of_block(x, y, k) for x, y in met]
    columns = [np.concatenate(x) for x in zip(*lists)] if lists else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(columns, names=[ITEM, "neighbor_id", "similarity"])


def _side(table: pa.Table) -> tuple:
    """Item ids, and the row numbers, users and weights of a stored block's ratings."""
    ids, row = np.unique(ids_of(table), return_inverse=True)
    return ids, row, table.column(USER).to_numpy(), table.column("w").to_numpy()


def _by_item(table: pa.Table) -> tuple:
    ids, row, user, w = _side(table)
    order = np.argsort(row, kind="stable")
    return ids, row[order], user[order], w[order]


def stored_block_lists(seeds: tuple, items: pa.Table, k: int, before: pa.Table | None = None) -> pa.Table:
    """The lists of a block's items (``_by_item``) within another block, and within those
    that ``before`` has the lists of."""
    lists = _best_of_block(seeds, _side(items), k)
    if before is not None:
        lists = tuple(np.concatenate(x) for x in zip(lists, (c.to_numpy() for c in before.columns)))
    row, neighbor, similarity = best_of(np.searchsorted(seeds[0], lists[0]), *lists[1:], k)
    return pa.table([seeds[0][row], neighbor, similarity], names=[ITEM, "neighbor_id", "similarity"])


def all_pairs_lists(unit: DataFrame, k: int) -> DataFrame:
    """(item_id, neighbor_id, similarity): for every pair of blocks, or for all blocks
    that a task reads, the ``k`` best neighbours of each item.  ``unit``: written unit ratings."""
    if unit.count() > BLOCK_RATINGS:
        rated = unit.where(F.col(USER).isNotNull())
        return query_blocks(rated, ITEM, rated, ITEM, lambda q, r, before: stored_block_lists(q, r, k, before),
                            f"{ITEM} bigint, neighbor_id bigint, similarity double", STORED_RATINGS, STORED_RATINGS, arrow=True,
                            ready=_by_item, carried=True, order=(USER,))
    n = min(BLOCKS, int(unit.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    items = unit.where(F.col(USER).isNotNull()).groupBy(ITEM).agg(F.collect_list(F.struct(F.col(USER), F.col("w"))).alias("r"))
    block = F.pmod(F.xxhash64(ITEM), F.lit(n)).cast("int")
    items = items.select(ITEM, F.col(f"r.{USER}").alias("users"), F.col("r.w").alias("ws"), block.alias("block"))
    other = items.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dealt = other.select(F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                         (F.col("block") <= F.col("other")).alias("own"), ITEM, "users", "ws")
    return dealt.groupBy("left", "right").applyInArrow(
        lambda t: block_pair_lists(t, k), f"{ITEM} bigint, neighbor_id bigint, similarity double")


def top_k_lists(scored: DataFrame, k: int) -> DataFrame:
    """Per item, the ``k`` best neighbours by similarity, then id."""
    w = Window.partitionBy(ITEM).orderBy(F.col("similarity").desc(), F.col("neighbor_id").asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("bigint")))


def pad_lists(lists: DataFrame, catalog: DataFrame, query_items: DataFrame, k: int) -> DataFrame:
    """Q23: complete each query item's list to ``k`` with similarity-0 items.

    ``lists`` holds positive-similarity neighbours only (rank 1..n <= k).  The
    pad items of a list are the smallest catalog ids not in it and not the
    item itself, so they lie among the first ``k + 1`` catalog ids; that
    bounded id list is inlined as a literal array.  Each list is gathered
    into one array of at most ``k`` entries (bounded by construction), the
    pads are appended with higher-order functions, and the array is exploded
    again -- one pass over ``lists``, no join against the catalog.
    """
    first_ids = [r[ITEM] for r in catalog.select(ITEM).orderBy(ITEM).limit(k + 1).collect()]
    entry = F.struct(F.col("rank"), F.col("neighbor_id"), F.col("similarity"))
    gathered = lists.groupBy(ITEM).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    full = (query_items.select(ITEM).distinct().join(gathered, ITEM, "left")
            .withColumn("entries", F.coalesce(F.col("entries"), F.array().cast(gathered.schema["entries"].dataType))))
    taken = F.transform(F.col("entries"), lambda e: e["neighbor_id"])
    free = F.filter(F.array(*[F.lit(x).cast("bigint") for x in first_ids]) if first_ids else F.array().cast("array<bigint>"),
                    lambda x: (x != F.col(ITEM)) & ~F.array_contains(taken, x))
    n_pos = F.size(F.col("entries"))
    pads = F.transform(F.slice(free, 1, F.greatest(F.lit(k) - n_pos, F.lit(0))),
                       lambda x, pos: F.struct((n_pos + pos + 1).cast("bigint").alias("rank"),
                                               x.alias("neighbor_id"), F.lit(0.0).alias("similarity")))
    return (full.select(ITEM, F.explode(F.concat(F.col("entries"), pads)).alias("e"))
            .select(ITEM, F.col("e.neighbor_id").alias("neighbor_id"), F.col("e.rank").alias("rank"),
                    F.col("e.similarity").alias("similarity")))


def item_neighbors(cells: DataFrame, k: int = 10, seeds: DataFrame | None = None, pad: bool = True,
                   block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """Collaborative top-``k`` neighbours by cosine of the rating columns.

    ``cells``: (item_id, user_id, rating), one row per cell (``rating_cells``);
    ratings are non-negative star ratings.  ``seeds``: optional frame with an
    ``item_id`` column; without it every catalog item is a query (R8).
    ``block_items`` is for seeds (4. above).
    Returns (item_id, neighbor_id, rank, similarity).  The query item itself
    is never its own neighbour (dropped by id, Q24).
    """
    # Written once to the checkpoint folder: the block count and the pairs (or both
    # join sides and the degree count) read it, and the product restarts from it after a loss.
    unit = cut_lineage(unit_ratings(cells))
    if seeds is None:
        scored = all_pairs_lists(unit, k)
        query_items = cells.select(ITEM)
    else:
        dots = seed_dots(unit, seeds, block_items)
        scored = dots.select(F.col("i").alias(ITEM), F.col("j").alias("neighbor_id"), score("dot").alias("similarity"))
        query_items = seeds.select(ITEM)
    lists = top_k_lists(scored.where(F.col("similarity") > 0), k)
    if not pad:
        return lists
    return pad_lists(lists, cells.select(ITEM).distinct(), query_items, k)


def content_neighbors(features: DataFrame, catalog: DataFrame, seeds: DataFrame, k: int = 20) -> DataFrame:
    """Top-``k`` content neighbours of the seed items by the block
    cosine of Q21 (each item's vector scaled by 1/sqrt(non-empty blocks)).

    ``features``: long form of ``features.content_features``; ``catalog``:
    every item that may be recommended (items without features score 0).  A
    seed outside the catalog has no list (Q27).
    """
    entries = features.select(ITEM, F.concat_ws("\u0001", "block", "feature").alias("key"), "value")
    scale = features.groupBy(ITEM).agg((F.lit(1.0) / F.sqrt(F.countDistinct("block"))).alias("scale"))
    listed = catalog.select(F.col(ITEM).alias("_listed"))
    known = seeds.select(F.col(ITEM).alias("_seed")).join(listed, F.col("_seed") == F.col("_listed"), "left_semi")
    known = known.select(F.col("_seed").alias(ITEM))
    return sparse_cosine_topk(entries, scale, catalog, known, k)


def mapped_only(lists: DataFrame, known: DataFrame) -> DataFrame:
    """The lists without neighbours that are not in ``known`` (item_id); the
    rest keep their order and are ranked anew."""
    listed = known.select(F.col(ITEM).alias("_known")).distinct()
    kept = lists.join(listed, F.col("neighbor_id") == F.col("_known"), "left_semi")
    again = F.row_number().over(Window.partitionBy(ITEM).orderBy("rank")).cast("bigint")
    return kept.withColumn("rank", again)
