"""Analytics over the data set and over recommendation lists.

Data-set side: per-item / per-user totals and their distribution (A6-A9),
popularity ranks (W5), title-variant fragmentation and the filter funnel
(A28-A30), and edition consolidation (C8).

List side (recs are ``(recommender, query_id, rank, item_id, score,
collab_score, content_score)``): metadata attachment and filters (J12, P14,
P16, P17, P19), genre Jaccard diversity, genre counts, genre uniqueness,
novelty and list coverage (A19-A24), and the configuration sweep tables
(A25-A27, R11, R12).  Lists are bounded by their ``k``; every pairwise step
stays inside one list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.metadata import split_list
from shelfwise.operators.ordering import global_index
from shelfwise.operators.selection import exact_quantiles

USER, ITEM, RATING = "user_id", "item_id", "rating"

# Genres per book considered by the list analytics, the shelf
# count shown in the comparison table, and the histogram bin counts.
GENRES_PER_BOOK = 5
SHELVES_SHOWN = 3
HIST_BINS = 50
SCORE_BINS = 20


def half_up(c: str, digits: int = 6) -> F.Column:
    """floor(x * 10^d + 0.5) / 10^d: the same IEEE steps in every engine, so an
    exact-half value rounds the same way everywhere."""
    scale = float(10 ** digits)
    return F.floor(F.col(c) * scale + 0.5) / scale


# --------------------------------------------------------------------------- data set

def item_popularity(cells: DataFrame, popularity: str = "rating_sum") -> DataFrame:
    """(item_id, popularity): the rating sum (what the notebook calls
    interactions, Q36) or the number of stored cells."""
    if popularity == "rating_sum":
        agg = F.sum(RATING).cast("double")
    elif popularity == "count":
        agg = F.count(F.lit(1)).cast("double")
    else:
        raise ValueError(f"unknown popularity {popularity!r}")
    return cells.groupBy(ITEM).agg(agg.alias("popularity"))


def exact_median(values: DataFrame, col: str) -> DataFrame:
    """Exact median of ``col`` (mean of the two middle values) by counting passes."""
    return exact_quantiles(values, col, [0.5]).select(F.col("value").alias("median"))


def side_profile(cells: DataFrame, side: str = ITEM, popularity: str = "rating_sum") -> DataFrame:
    """One row describing the per-``side`` totals: count, sum, mean,
    min, max and exact median."""
    if popularity == "rating_sum":
        agg = F.sum(RATING).cast("double")
    else:
        agg = F.count(F.lit(1)).cast("double")
    per = cells.groupBy(side).agg(agg.alias("v"))
    stats = per.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum("v").alias("total"),
        F.round(F.avg("v"), 6).alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    med = exact_median(per, "v")
    return stats.select(F.lit(side).alias("side"), "*", med.select("median").scalar().alias("median"))


def histogram(values: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins between min and max (the last bin is closed)."""
    bounds = values.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)))
    counts = values.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.select("bin", F.round(lo + F.col("bin") * width, 6).alias("lower"),
                         F.round(lo + (F.col("bin") + 1) * width, 6).alias("upper"), "n")


def popularity_rank(interactions: DataFrame) -> DataFrame:
    """Rank of every item by interaction count (ties by id)."""
    counts = interactions.groupBy(ITEM).agg(F.count(F.lit(1)).cast("bigint").alias("n_interactions"))
    ranked = global_index(counts, [F.col("n_interactions").desc(), F.col(ITEM).asc()], "_pos")
    return ranked.select(ITEM, "n_interactions", (F.col("_pos") + 1).alias("popularity_rank"))


def canonical_title(c: F.Column) -> F.Column:
    """Title family: lower case, a trailing parenthesised part removed."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s*\([^)]*\)\s*$", ""))


def fragmentation(interactions: DataFrame, titles: DataFrame, top_n: int) -> DataFrame:
    """Per title family, how many ids share it, how many survive the
    top-``top_n`` cut, and the share of the family's interactions on its
    most-read id."""
    ranks = popularity_rank(interactions)
    fam = titles.select(ITEM, canonical_title(F.col("title")).alias("family"))
    j = ranks.join(fam, ITEM)
    return j.groupBy("family").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_ids"),
        F.count_if(F.col("popularity_rank") <= top_n).cast("bigint").alias("n_ids_in_top"),
        F.sum("n_interactions").cast("bigint").alias("n_interactions"),
        F.round(F.max("n_interactions") / F.sum("n_interactions"), 6).alias("top_id_share"),
    )


def funnel(interactions: DataFrame, min_reads: int, top_n: int) -> DataFrame:
    """Items at each preparation stage (raw, >= min_reads, top N)."""
    counts = interactions.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"))
    s = counts.agg(F.count(F.lit(1)).cast("bigint").alias("raw"),
                   F.count_if(F.col("n") >= min_reads).cast("bigint").alias("active"))
    def row(step, stage, n):
        return F.struct(F.lit(step).alias("step"), F.lit(stage).alias("stage"), n.cast("bigint").alias("n_items"))
    return s.select(F.explode(F.array(
        row(1, "raw", F.col("raw")),
        row(2, f"min_reads_{min_reads}", F.col("active")),
        row(3, f"top_{top_n}", F.least(F.col("active"), F.lit(top_n))))).alias("f")).select("f.*")


def item_density(cells: DataFrame) -> DataFrame:
    """Each item's stored entries over the number of users."""
    n_users = cells.select(F.countDistinct(USER).cast("double")).scalar()
    return cells.groupBy(ITEM).agg(F.count(F.lit(1)).cast("bigint").alias("nnz")).select(
        ITEM, "nnz", F.round(F.col("nnz") / n_users, 9).alias("density"))


def consolidate_editions(interactions: DataFrame, titles: DataFrame) -> DataFrame:
    """Map every id to the most-read id of its title family (ties: the
    lowest id) and return the interactions on the canonical ids; the rating
    cells built from them sum the editions."""
    counts = interactions.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"))
    fam = titles.select(ITEM, canonical_title(F.col("title")).alias("family")).join(counts, ITEM)
    canon = fam.groupBy("family").agg(
        F.min_by(ITEM, F.struct(-F.col("n"), F.col(ITEM))).alias("canonical_id"))
    mapping = fam.join(canon, "family").select(ITEM, "canonical_id")
    return (interactions.join(mapping, ITEM, "left")
            .withColumn(ITEM, F.coalesce(F.col("canonical_id"), F.col(ITEM))).drop("canonical_id"))


# --------------------------------------------------------------------------- lists

def apply_filters(recs: DataFrame, metadata: DataFrame, min_rating: float | None = None,
                  min_year: int | None = None, max_year: int | None = None) -> DataFrame:
    """A missing or zero value passes; a threshold of 0/None is no
    filter; applied after the top-n cut, without refill."""
    m = recs.join(metadata.select(ITEM, "average_rating", "publication_year"), ITEM, "left")
    rating = F.col("average_rating")
    year = F.col("publication_year")
    cond = F.lit(True)
    if min_rating:
        cond = cond & (rating.isNull() | (rating == 0) | (rating >= min_rating))
    if min_year:
        cond = cond & (year.isNull() | (year == 0) | (year >= min_year))
    if max_year:
        cond = cond & (year.isNull() | (year == 0) | (year <= max_year))
    return m.where(cond).select(*recs.columns)


def detail_line(metadata: DataFrame) -> DataFrame:
    """``year | rating | N ratings | P pages``, absent or zero parts skipped."""
    def part(c, text):
        return F.when(F.col(c).isNotNull() & (F.col(c) != 0), text)
    return metadata.select(ITEM, F.concat_ws(" | ",
        part("publication_year", F.col("publication_year").cast("string")),
        part("average_rating", F.format_number(F.col("average_rating"), 2)),
        part("ratings_count", F.concat(F.format_number(F.col("ratings_count"), 0), F.lit(" ratings"))),
        part("num_pages", F.concat(F.col("num_pages").cast("string"), F.lit(" pages")))).alias("details"))


def score_breakdown(recs: DataFrame, top: int = 10) -> DataFrame:
    """Collaborative and content percentages of the first ``top`` items."""
    return recs.where(F.col("rank") <= top).select(
        "recommender", "query_id", "rank", ITEM,
        F.round(F.col("collab_score") * 100, 6).alias("collab_pct"),
        F.round(F.col("content_score") * 100, 6).alias("content_pct"))


def _genres(metadata: DataFrame) -> DataFrame:
    """(item_id, genres): the first five shelf names of items with shelves."""
    return metadata.where(F.coalesce(F.col("shelves"), F.lit("")) != "").select(
        ITEM, F.slice(F.split("shelves", ","), 1, GENRES_PER_BOOK).alias("genres"))


def genre_diversity(recs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per list, mean pairwise (1 - Jaccard) of the genre sets x 100;
    books without shelves are skipped, 0 without a pair."""
    g = recs.join(_genres(metadata), ITEM).select("recommender", "query_id", "rank",
                                                  F.array_distinct("genres").alias("g"))
    a, b = g.alias("a"), g.alias("b")
    pairs = a.join(b, [F.col("a.recommender") == F.col("b.recommender"), F.col("a.query_id") == F.col("b.query_id"),
                       F.col("a.rank") < F.col("b.rank")])
    inter = F.size(F.array_intersect("a.g", "b.g"))
    union = F.size(F.array_union("a.g", "b.g"))
    d = pairs.where(union > 0).select(F.col("a.recommender").alias("recommender"), F.col("a.query_id").alias("query_id"),
                                      (F.lit(1.0) - inter / union).alias("d"))
    per = d.groupBy("recommender", "query_id").agg(F.round(F.avg("d") * 100, 6).alias("genre_diversity"))
    lists = recs.select("recommender", "query_id").distinct()
    return lists.join(per, ["recommender", "query_id"], "left").fillna(0.0, ["genre_diversity"])


def genre_counts(recs: DataFrame, metadata: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` genres of each list (first five shelves per book,
    trimmed), ties by name."""
    g = recs.join(_genres(metadata), ITEM).select("recommender", "query_id", F.explode("genres").alias("genre"))
    c = g.select("recommender", "query_id", F.trim("genre").alias("genre")).groupBy("recommender", "query_id", "genre") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy("recommender", "query_id").orderBy(F.col("n").desc(), F.col("genre").asc())
    return c.withColumn("position", F.row_number().over(w).cast("bigint")).where(F.col("position") <= top)


def list_metrics(recs: DataFrame, metadata: DataFrame, popularity: DataFrame, catalog_size: int | F.Column,
                 requested: int | None = None) -> DataFrame:
    """A21-A24 per list: mean score, genre uniqueness (distinct / total of
    the first five genres per book), coverage (distinct items / catalog),
    novelty (mean of 1 - popularity / max popularity) and, with
    ``requested``, the filter pass rate in percent."""
    max_pop = popularity.select(F.max("popularity")).scalar()
    size = F.lit(catalog_size) if isinstance(catalog_size, int) else catalog_size
    # Scores are weighted sums of 6-decimal similarities: averaging them as
    # exact integers of 1e-7 keeps the mean identical under any summation order.
    base = recs.join(popularity, ITEM, "left").groupBy("recommender", "query_id").agg(
        (F.avg(F.round(F.col("score") * 1e7).cast("bigint")) / 1e7).alias("mean_score"),
        (F.countDistinct(ITEM) / size).alias("coverage"),
        F.avg(F.lit(1.0) - F.coalesce(F.col("popularity"), F.lit(0.0)) / max_pop).alias("novelty"),
        F.count(F.lit(1)).alias("n_kept"),
    )
    g = recs.join(_genres(metadata), ITEM).select("recommender", "query_id", F.explode("genres").alias("genre"))
    uniq = g.groupBy("recommender", "query_id").agg(
        (F.countDistinct("genre") / F.count(F.lit(1))).alias("genre_uniqueness"))
    out = base.join(uniq, ["recommender", "query_id"], "left").fillna(0.0, ["genre_uniqueness"])
    cols = ["recommender", "query_id", half_up("mean_score").alias("mean_score")] + [
        F.round(c, 6).alias(c) for c in ["genre_uniqueness", "coverage", "novelty"]]
    if requested:
        cols.append(F.round(F.col("n_kept") * 100.0 / requested, 6).alias("pass_rate_pct"))
    return out.select(*cols)


def filter_stats(kept: DataFrame, recs: DataFrame, requested: int) -> DataFrame:
    """A24 per list of ``recs``: the share in percent of ``requested`` that the
    filters kept, and the mean match of the kept in percent (0 without any)."""
    per = ["recommender", "query_id"]
    stats = kept.groupBy(*per).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"))
    return recs.select(*per).distinct().join(stats, per, "left").select(
        *per, F.round(F.coalesce("n", F.lit(0)) * 100.0 / requested, 6).alias("pass_rate_pct"),
        F.round(F.coalesce("mean", F.lit(0.0)) * 100, 4).alias("mean_match_pct"))


def sweep_pivot(per_list: DataFrame, metrics: Sequence[str], configs: Sequence[str]) -> DataFrame:
    """One row per query and metric, one column per configuration."""
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    tidy = per_list.select("recommender", "query_id", stack.alias("s")).select("recommender", "query_id", "s.metric", "s.value")
    return tidy.groupBy("query_id", "metric").pivot("recommender", list(configs)).agg(F.first("value"))


def titles_with_features(titles: DataFrame, simple: DataFrame) -> DataFrame:
    """Every title with its numeric columns, null where it has none."""
    named = titles.withColumn("_id", F.col("book_id").try_cast("bigint"))
    features = simple.withColumnRenamed("book_id", "_book").where(F.col("_book").isNotNull())
    return named.join(features, F.col("_id") == F.col("_book"), "left").drop("_id", "_book")


def sweep_summary(per_list: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per configuration (rounded to 3), the
    best configuration per metric, and the best overall by the mean of the
    metric means."""
    means = per_list.groupBy("recommender").agg(*[F.round(F.avg(m), 3).alias(m) for m in metrics])
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    tidy = means.select("recommender", stack.alias("s")).select("recommender", "s.metric", "s.value")
    overall = means.select("recommender", (sum(F.col(m) for m in metrics) / len(metrics)).alias("value")) \
        .withColumn("metric", F.lit("overall"))
    both = tidy.unionByName(overall.select("recommender", "metric", "value"))
    return both.groupBy("metric").agg(
        F.max("value").alias("best_value"),
        F.min_by("recommender", F.struct(-F.col("value"), F.col("recommender"))).alias("best_recommender"))


def comparison_table(recs: DataFrame, titles: DataFrame, metadata: DataFrame, configs: Sequence[str], n_show: int = 5) -> DataFrame:
    """For each query, the first ``n_show`` titles (with their first
    three shelves) of every configuration side by side: one row per rank,
    one column per configuration of ``configs``."""
    m = metadata.select(ITEM, F.array_join(F.slice(split_list("shelves"), 1, SHELVES_SHOWN), ", ").alias("top_shelves"))
    t = recs.where(F.col("rank") <= n_show).join(titles, ITEM, "left").join(m, ITEM, "left")
    cell = F.concat(F.coalesce(F.col("title"), F.concat(F.lit("Book ID: "), F.col(ITEM).cast("string"))),
                    F.when(F.col("top_shelves") != "", F.concat(F.lit(" ["), F.col("top_shelves"), F.lit("]")))
                    .otherwise(F.lit("")))
    return t.select("query_id", "rank", "recommender", cell.alias("cell")).groupBy("query_id", "rank") \
        .pivot("recommender", list(configs)).agg(F.first("cell"))
