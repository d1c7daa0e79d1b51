"""Fuzzy title search and title lookups.

A search scores queries against distinct titles.  Window ratios of strings that are
long enough for the threshold go through the q-gram index (``operators.title_index``);
everything else runs as blocks of queries against blocks of titles
(``operators.blocks``): a task scores one block pair with the vectorised scorers
of ``functions.text``, after an exact upper bound has dropped most pairs, and
returns only the matches at or above the threshold.  Matches are then ranked per
query (score desc, item id asc) and cut to ``max_results``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators import title_index
from shelfwise.operators.blocks import query_blocks
from shelfwise.session import cut_lineage

ITEM = "item_id"


def distinct_titles(titles: DataFrame) -> DataFrame:
    """Q28: one id per distinct title (duplicate titles: the largest id wins)."""
    return titles.groupBy("title").agg(F.max(ITEM).alias(ITEM))


def search_titles(titles: DataFrame, queries: DataFrame, threshold: int = 60, max_results: int | None = None,
                  scorer: str = "partial_ratio", process: bool = False) -> DataFrame:
    """F1: ``(query_id, rank, title, item_id, score)`` of every match >= ``threshold``.

    ``titles``: (item_id, title); ``queries``: (query_id, query).  Both sides
    are lower-cased (Q29); with ``process`` they are normalised as the search
    library's default processor does (F4).  Cutting to ``max_results`` before the
    threshold (F4's order) or after it gives the same rows, as both go by score.
    """
    text.scorer(scorer)  # raises for an unknown scorer (F1c)
    prep = text.normalise if process else F.lower
    q = queries.select("query_id", prep(F.col("query")).alias("q")).where("q is not null")
    idx = distinct_titles(titles).select("title", ITEM, prep(F.col("title")).alias("t")).where("t is not null")

    if scorer == "partial_ratio" and threshold > 0:
        out = _indexed(q, idx, threshold)
    else:
        out = _blockwise(q, idx, scorer, threshold)
    if max_results is not None:
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(ITEM).asc())
        ranked = out.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= max_results)
    else:
        # all matches of a query are ranked without one task holding them: by score, then within a score;
        # found once, as the counts and the rows are read from them
        out = cut_lineage(out)
        same = Window.partitionBy("query_id", "score").orderBy(ITEM)
        above = Window.partitionBy("query_id").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
        counts = out.groupBy("query_id", "score").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.select("query_id", "score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
        ranked = out.withColumn("in_score", F.row_number().over(same)).join(counts, ["query_id", "score"])
        ranked = ranked.withColumn("rank", (F.col("above") + F.col("in_score")).cast("bigint"))
    return ranked.select("query_id", "rank", "title", ITEM, "score")


def _blockwise(q: DataFrame, idx: DataFrame, scorer: str, threshold: int) -> DataFrame:
    """``(query_id, title, item_id, score)`` of all matches, by comparing blocks."""
    def matched(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        texts, names, ids = text.Texts(ts["t"].tolist()), ts["title"].to_numpy(dtype=object), ts[ITEM].to_numpy()
        parts = []
        for query_id, query in zip(qs["query_id"], qs["q"]):
            rows, scores = text.matches(scorer, query, texts, threshold)
            parts.append((np.full(len(rows), query_id), names[rows], ids[rows], scores))
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pd.DataFrame({n: pd.Series(c, dtype=c.dtype) for n, c in zip(("query_id", "title", ITEM, "score"), columns)})

    return query_blocks(q, "query_id", idx, ITEM, matched, f"query_id bigint, title string, {ITEM} bigint, score int")


def _indexed(q: DataFrame, idx: DataFrame, threshold: int) -> DataFrame:
    """The same for window ratios: strings that are long enough meet through their
    q-grams, short queries and short titles in blocks."""
    shortest = title_index.shortest_indexed(threshold)
    long_q, long_t = F.length("q") >= shortest, F.length("t") >= shortest
    if q.where(long_q).isEmpty():
        return _blockwise(q, idx, "partial_ratio", threshold)
    idx = cut_lineage(idx)  # read several times: for the q-grams, their texts, and the blocks
    # an item may have several titles
    keyed = idx.withColumn("t_id", F.struct(ITEM, "title"))
    pairs = title_index.candidates(q.select(F.col("query_id").alias("q_id"), F.col("q").alias("s")),
                                   keyed.select("t_id", F.col("t").alias("s")), threshold, shortest)
    met = pairs.join(q.withColumnRenamed("query_id", "q_id"), "q_id").join(keyed, "t_id")
    # the batches of a task hold few queries
    met = met.select("q_id", "title", ITEM, "q", "t").sortWithinPartitions("q_id")
    found = title_index.scored(met, "partial_ratio", threshold).select(F.col("q_id").alias("query_id"), "title", ITEM, "score")
    short_q = _blockwise(q.where(~long_q), idx, "partial_ratio", threshold)
    short_t = _blockwise(q.where(long_q), idx.where(~long_t), "partial_ratio", threshold)
    return found.unionByName(short_q).unionByName(short_t)


def best_match(titles: DataFrame, queries: DataFrame, threshold: int = 60, scorer: str = "partial_ratio") -> DataFrame:
    """the best title per query, or no row when nothing clears ``threshold``."""
    return search_titles(titles, queries, threshold, 1, scorer).drop("rank")


def smart_search(titles: DataFrame, queries: DataFrame, threshold: int = 70, max_results: int = 10) -> DataFrame:
    """processed text and the weighted scorer."""
    return search_titles(titles, queries, threshold, max_results, "weighted_ratio", process=True)


def sorted_titles(titles: DataFrame) -> DataFrame:
    """The distinct titles in order (the pick list)."""
    return titles.select("title").distinct().orderBy("title")


def titles_with_fallback(items: DataFrame, titles: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """(item_id, title) for ``items``, by id, through the optional id map
    (title ids -> item ids); a missing title becomes ``Book ID: <id>``.  Ids that
    share a title each keep it."""
    t = titles
    if id_map is not None:
        t = t.withColumnRenamed(ITEM, "book_id").join(id_map, "book_id").select("title", F.col("book_id_csv").alias(ITEM))
    t = t.groupBy(ITEM).agg(F.max("title").alias("title"))
    return items.join(t, ITEM, "left").withColumn(
        "title", F.coalesce(F.col("title"), F.concat(F.lit("Book ID: "), F.col(ITEM).cast("string"))))


def id_audit(interactions: DataFrame, id_map: DataFrame, titles: DataFrame) -> DataFrame:
    """Interaction items missing from the id map, and mapped ids without a title."""
    items = interactions.select(ITEM).distinct()
    unmapped = items.join(id_map.select(F.col("book_id_csv").alias(ITEM)), ITEM, "left_anti")
    mapped = items.join(id_map.select(F.col("book_id_csv").alias(ITEM), "book_id"), ITEM)
    no_title = mapped.join(titles.select(F.col(ITEM).alias("book_id")).distinct(), "book_id", "left_anti")
    return (items.select(F.count(F.lit(1)).cast("bigint").alias("n_items"))
            .select("n_items",
                    unmapped.select(F.count(F.lit(1)).cast("bigint")).scalar().alias("n_unmapped"),
                    no_title.select(F.count(F.lit(1)).cast("bigint")).scalar().alias("n_without_title")))
