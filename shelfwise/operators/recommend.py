"""Recommendations for title queries: search, candidates, lists.

``TitleRecommender`` holds the inputs that several queries share; each is
derived once, on first use, and written once.  ``recommend_by_title`` is the
one-call form for any of the three methods.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import features as feat
from shelfwise.operators import hybrid, neighbors, search
from shelfwise.session import cut_lineage

ITEM = "item_id"
METHODS = ("hybrid", "collaborative", "content")
DEFAULT_WEIGHTS = (0.6, 0.4)
# Candidates of each side for a list of n.
OVERFETCH = 3


class TitleRecommender:
    """``queries``: (query_id, query); ``titles``: (item_id, title); ``cells``:
    rating cells; ``metadata``: flat metadata of the ``catalog`` (content side)."""

    def __init__(self, queries: DataFrame, titles: DataFrame, cells: DataFrame | None = None,
                 catalog: DataFrame | None = None, metadata: DataFrame | None = None, n: int = 20, threshold: int = 60):
        self.queries, self.titles, self.cells, self.catalog = queries, titles, cells, catalog
        self.metadata, self.n, self.threshold = metadata, n, threshold

    @cached_property
    def best(self) -> DataFrame:
        """(query_id, title, item_id, score): the seed of each query that has one."""
        return cut_lineage(search.best_match(self.titles, self.queries, self.threshold))

    @cached_property
    def collaborative(self) -> DataFrame:
        return cut_lineage(neighbors.item_neighbors(self.cells, k=OVERFETCH * self.n, seeds=self.best.select(ITEM)))

    @cached_property
    def content(self) -> DataFrame:
        features = cut_lineage(feat.content_features(self.metadata, self.catalog))
        return cut_lineage(neighbors.content_neighbors(features, self.catalog, self.best.select(ITEM), k=OVERFETCH * self.n))

    def _per_query(self, lists: DataFrame) -> DataFrame:
        seeds = self.best.select("query_id", F.col(ITEM).alias("seed"))
        return seeds.join(lists.withColumnRenamed(ITEM, "seed"), "seed").select(
            "query_id", F.col("neighbor_id").alias(ITEM), "rank", "similarity")

    def hybrid(self, weights: Sequence[tuple[float, float]]) -> DataFrame:
        """The lists of every weight pair."""
        return hybrid.hybrid(self._per_query(self.collaborative), self._per_query(self.content), weights, self.n,
                             query_col="query_id")

    def single(self, method: str) -> DataFrame:
        return hybrid.single_method(self._per_query(getattr(self, method)), method, self.n, query_col="query_id")


def recommend_by_title(queries: DataFrame, titles: DataFrame, method: str = "hybrid", n: int = 5, threshold: int = 60,
                       cells: DataFrame | None = None, catalog: DataFrame | None = None,
                       metadata: DataFrame | None = None, weights: tuple[float, float] = DEFAULT_WEIGHTS,
                       id_map: DataFrame | None = None) -> DataFrame:
    """The top ``n`` for the best title match of each query, with titles; a
    query without a match has no rows.  ``collaborative`` needs ``cells``,
    ``content`` needs ``catalog`` and ``metadata``, ``hybrid`` all three."""
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method!r}; expected one of {METHODS}")
    need = {"collaborative": {"cells": cells}, "content": {"catalog": catalog, "metadata": metadata}}
    for name, value in (need["collaborative"] | need["content"] if method == "hybrid" else need[method]).items():
        if value is None:
            raise ValueError(f"method {method!r} needs {name}")
    found = TitleRecommender(queries, titles, cells, catalog, metadata, n, threshold)
    lists = found.hybrid([weights]) if method == "hybrid" else found.single(method)
    return search.titles_with_fallback(lists, titles, id_map)
