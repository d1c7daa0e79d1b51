"""Exact cosine top-K of a set of seeds against a whole catalog.

Content vectors have a dense part (the numeric block is non-zero for almost every
item), so every seed is compared with every catalog item; a join on shared
features cannot prune that.  The work is dealt out as blocks of seeds against
blocks of the catalog (``operators.blocks``), which many seeds read from storage, so
that nothing is repeated on disk for each of their blocks.  A task forms scores in tiles of at
most ``DENSE_CELLS``: columns that many vectors have by a matrix product, the
others by the lists of the seeds that have them.  Once a seed has ``k`` items, only
scores that reach its worst one leave the tile.  The task returns the top ``k`` of
each seed within its blocks; a ``row_number`` per seed picks the global ones.
Nothing passes the driver, and neither side is bounded.

Every catalog item is scored, so items with similarity 0 fill short lists in id
order and negative similarities rank after them, as a brute-force KNN does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.common import RANK_DIGITS
from shelfwise.operators.blocks import query_blocks
from shelfwise.session import cut_lineage

ITEM = "item_id"
SEED_BLOCK = 32_768
CATALOG_BLOCK = 32_768
# Seeds of a tile, and its scores (32 MB).
TILE = 2048
DENSE_CELLS = 4_000_000
# A column is multiplied as dense where lists would take more than 1/64 of the scores.
DENSE_SHARE = 64
# Keys that are sent to every task, at most (some 60 bytes each).
MOST_SENT = 500_000
# Products of lists that are fewer than 1/16 of the scores are added one by one.
FEW_CELLS = 16
# Products of lists that are held at a time.
PRODUCTS = 4_000_000
# Scores this much below a seed's worst are still rounded before they are dropped.
MARGIN = 10.0 ** (1 - RANK_DIGITS)


def lists_of(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a column of lists."""
    lists = table.column(name).combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(table)), sizes), lists.flatten().to_numpy(zero_copy_only=False)


def ids_of(table: pa.Table) -> np.ndarray:
    return table.column(ITEM).fill_null(-2**63).to_numpy()


def _vectors(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, and the row numbers, keys and scaled values of the entries."""
    (row, key), (_, value) = lists_of(table, "keys"), lists_of(table, "values")
    return ids_of(table), row, key, value.astype(np.float64) * table.column("scale").to_numpy()[row]


def products(starts: np.ndarray, counts: np.ndarray, limit: int = PRODUCTS):
    """Every entry met with the ``counts`` places from ``starts`` on, in parts of about
    ``limit`` products: pairs of entry numbers and places."""
    done = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = done[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(done, before + limit, side="right")))
        own = counts[at:end]
        entry = np.repeat(np.arange(at, end), own)
        yield entry, np.arange(len(entry)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(starts[at:end], own)
        at = end


def best_of(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of each row, by score, then id."""
    order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], ids[keep], scores[keep]


def _dense(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return np.bincount(row * columns + column, weights=value, minlength=rows * columns).reshape(rows, columns)


def block_top_k(seeds: pa.Table | tuple, items: pa.Table, k: int, before: pa.Table | None = None) -> pa.Table:
    """The ``k`` best items for each seed of a block (or its ``_vectors``), of this block
    of items and of those that ``before`` has the best of."""
    items = items.sort_by(ITEM)
    ids, row, key, value = _vectors(items)
    seed_ids, seed_row, seed_key, seed_value = seeds if isinstance(seeds, tuple) else _vectors(seeds)
    names, seed_column = np.unique(seed_key, return_inverse=True)
    column = np.minimum(np.searchsorted(names, key), max(0, len(names) - 1))
    known = names[column] == key if len(names) else np.zeros(len(key), dtype=bool)  # else: no seed has the feature
    row, column, value = row[known], column[known], value[known]
    finite = np.isfinite(value).all() and np.isfinite(seed_value).all()
    had = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if before is not None:
        by_id = np.argsort(seed_ids, kind="stable")
        own, *lists = (c.to_numpy() for c in before.columns)
        had = by_id[np.searchsorted(seed_ids[by_id], own)], *lists  # rows in order, as they were returned

    met = np.bincount(column, minlength=len(names)) * np.bincount(seed_column, minlength=len(names))
    often = met * DENSE_SHARE >= len(ids) * len(seed_ids)
    place, width = np.cumsum(often) - 1, int(often.sum())
    step = max(1, DENSE_CELLS // TILE)
    # one tile's memory serves all: new pages cost as much as the scores
    cells, marks = np.empty(min(TILE, len(seed_ids)) * min(step, len(ids))), np.empty(min(TILE, len(seed_ids)) * min(step, len(ids)), dtype=bool)
    found = []
    for s0 in range(0, len(seed_ids), TILE):
        n_seeds = min(TILE, len(seed_ids) - s0)
        own = slice(*np.searchsorted(seed_row, (s0, s0 + n_seeds)))
        s_row, s_column, s_value = seed_row[own] - s0, seed_column[own], seed_value[own]
        dense = often[s_column]
        matrix = _dense(s_row[dense], place[s_column[dense]], s_value[dense], n_seeds, width)
        by_column = np.argsort(s_column[~dense], kind="stable")
        l_row, l_value = s_row[~dense][by_column], s_value[~dense][by_column]
        sizes = np.bincount(s_column[~dense], minlength=len(names))
        begins = np.cumsum(sizes) - sizes
        own = slice(*np.searchsorted(had[0], (s0, s0 + n_seeds)))
        best = had[0][own] - s0, had[1][own], had[2][own]
        worst, worst_id = _worst(best, n_seeds, k)
        for i0 in range(0, len(ids), step):
            n_items = min(step, len(ids) - i0)
            own = slice(*np.searchsorted(row, (i0, i0 + n_items)))
            i_row, i_column, i_value = row[own] - i0, column[own], value[own]
            dense = often[i_column]
            scores = cells[:n_seeds * n_items].reshape(n_seeds, n_items)
            np.matmul(matrix, _dense(i_row[dense], place[i_column[dense]], i_value[dense], n_items, width).T, out=scores)
            i_row, i_column, i_value = i_row[~dense], i_column[~dense], i_value[~dense]
            for entry, at in products(begins[i_column], sizes[i_column]):
                cell, product = l_row[at] * n_items + i_row[entry], l_value[at] * i_value[entry]
                if len(cell) * FEW_CELLS < scores.size:
                    np.add.at(scores.reshape(-1), cell, product)
                else:
                    scores += np.bincount(cell, weights=product, minlength=scores.size).reshape(n_seeds, n_items)
            if not finite:
                scores[~np.isfinite(scores)] = -np.inf
            limit = worst
            if n_items > k + 1 and np.isneginf(worst).any():  # one more: the seed itself may be among them
                limit = np.maximum(worst, np.partition(scores, n_items - k - 1, axis=1)[:, n_items - k - 1])
            reach = marks[:scores.size]
            np.greater_equal(scores, (limit - MARGIN)[:, None], out=reach.reshape(scores.shape))
            r, c = np.divmod(np.flatnonzero(reach), n_items)
            if not len(r):
                continue
            similarity, item = np.round(scores[r, c], RANK_DIGITS) + 0.0, ids[i0 + c]
            # a tie with the worst of a full list needs a lower id; an item is never its own neighbour
            keep = ((similarity > worst[r]) | ((similarity == worst[r]) & (item < worst_id[r]))) & (item != seed_ids[s0 + r])
            if not keep.any():
                continue
            new = r[keep], item[keep], similarity[keep]
            best = best_of(*[np.concatenate(x) for x in zip(best, new)], k)
            worst, worst_id = _worst(best, n_seeds, k)
        found.append((seed_ids[s0 + best[0]], best[1], best[2]))
    return pa.table([np.concatenate(x) for x in zip(*found)], names=["seed_id", "neighbor_id", "similarity"])


def _worst(best: tuple[np.ndarray, np.ndarray, np.ndarray], rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of the last entry of each row that has ``k``; others take any finite score."""
    worst, worst_id = np.full(rows, -np.inf), np.full(rows, np.iinfo(np.int64).min)
    n = np.bincount(best[0], minlength=rows)
    full = n >= k
    last = (np.cumsum(n) - 1)[full]
    worst[full], worst_id[full] = best[2][last], best[1][last]
    return worst, worst_id


def _top_k(vectors: DataFrame, k: int) -> DataFrame:
    """``vectors``: (item_id, listed, asked, keys, values, scale), written."""
    def side(name: str) -> DataFrame:
        return vectors.where(F.col(name)).select(ITEM, "keys", "values", "scale")

    found = query_blocks(side("asked"), ITEM, side("listed"), ITEM, lambda q, r, before: block_top_k(q, r, k, before),
                         "seed_id bigint, neighbor_id bigint, similarity double", SEED_BLOCK, CATALOG_BLOCK, arrow=True,
                         ready=_vectors, carried=True)
    w = Window.partitionBy("seed_id").orderBy(F.col("similarity").desc(), F.col("neighbor_id").asc())
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("seed_id").alias(ITEM), "neighbor_id", F.col("rank").cast("bigint").alias("rank"), "similarity"))


def _sided(catalog: DataFrame, seeds: DataFrame) -> DataFrame:
    """Every id once, with the sides that it is on."""
    ids = catalog.select(ITEM, F.lit(True).alias("listed"), F.lit(False).alias("asked")).unionByName(
        seeds.select(ITEM, F.lit(False).alias("listed"), F.lit(True).alias("asked")))
    return ids.groupBy(ITEM).agg(F.max("listed").alias("listed"), F.max("asked").alias("asked"))


def _joined(ids: DataFrame, gathered: DataFrame, scale: DataFrame) -> DataFrame:
    """The vectors of the ids, written once, as both sides and their sizes are read from them."""
    gathered = gathered.withColumnRenamed(ITEM, "_item")
    scales = scale.select(F.col(ITEM).alias("_scaled"), "scale")
    return cut_lineage(
        ids.join(gathered, F.col(ITEM) == F.col("_item"), "left").join(scales, F.col(ITEM) == F.col("_scaled"), "left").select(
            ITEM, "listed", "asked", F.coalesce("keys", F.array().cast("array<bigint>")).alias("keys"),
            F.coalesce("values", F.array().cast("array<double>")).alias("values"), F.coalesce("scale", F.lit(0.0)).alias("scale")))


def sparse_cosine_topk(entries: DataFrame, scale: DataFrame, catalog: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Top-``k`` by cosine for each seed.

    ``entries``: (item_id, key string, value double) non-zero vector entries.
    ``scale``: (item_id, scale) with 1 / |vector| (0 for an empty vector).
    ``catalog``: (item_id) every candidate item.  ``seeds``: (item_id).
    """
    # keys travel with every block pair: as numbers
    numbers = cut_lineage(entries.select(F.col("key").alias("_key")).distinct().withColumn("number", F.monotonically_increasing_id()))
    # up to MOST_SENT keys go to every task; the entries are then not shuffled by key
    named = F.broadcast(numbers) if numbers.count() <= MOST_SENT else numbers
    numbered = entries.join(named, F.col("key") == F.col("_key"))
    gathered = numbered.groupBy(ITEM).agg(F.collect_list(F.struct("number", "value")).alias("entries")).select(
        ITEM, F.col("entries.number").alias("keys"), F.col("entries.value").alias("values"))
    return _top_k(_joined(_sided(catalog, seeds), gathered, scale), k)


def dense_cosine_topk(vectors: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Top-``k`` cosine neighbours in a dense ``vector`` array column (R2 dense form)."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    scale = vectors.select(ITEM, F.when(norm > 0, F.lit(1.0) / norm).otherwise(F.lit(0.0)).alias("scale"))
    own = F.transform("vector", lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    gathered = vectors.where(F.size("vector") > 0).groupBy(ITEM).agg(F.collect_list(own).alias("rows")).select(
        ITEM, F.flatten(F.transform("rows", lambda v: F.sequence(F.lit(0).cast("bigint"), F.size(v).cast("bigint") - 1))).alias("keys"),
        F.flatten("rows").alias("values"))
    return _top_k(_joined(_sided(vectors.select(ITEM), seeds), gathered, scale), k)
