"""Offline evaluation: holdouts, ranking metrics, coverage, diversity.

Tables:

* holdouts ``(user_id, seed_item, n_positives)`` -- one query per sampled user;
* positives ``(user_id, item_id)`` -- the user's other stored cells;
* recs ``(recommender, user_id, rank, item_id)`` -- 1-based ranks.

Every metric is a grouped aggregate over ``recs`` left-joined with the
positives; queries without any recommendation still count with 0 because the
per-query table starts from the holdouts, not from the recs (section 2.12).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.ordering import top_n
from shelfwise.session import cut_lineage

USER, ITEM, RATING = "user_id", "item_id", "rating"
METRICS = ["precision", "recall", "ndcg", "map", "hit_rate"]

# The evaluation defaults (users, minimum interactions, cutoffs,
# seed) and the four hybrid weightings of the offline report.
DEFAULT_N_USERS = 500
DEFAULT_MIN_INTERACTIONS = 10
DEFAULT_K_VALUES = (5, 10, 20)
DEFAULT_SEED = 42
DEFAULT_HYBRID_WEIGHTS = ((0.3, 0.7), (0.5, 0.5), (0.6, 0.4), (0.7, 0.3))
# Rows of lists whose items are sent to every task, at most.
MOST_SENT = 500_000


def _md5_key(seed: int, *cols: str) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def sample_holdouts(cells: DataFrame, n_users: int, min_interactions: int = 5, seed: int = 42) -> DataFrame:
    """Leave-one-out queries.

    Eligible users have >= ``min_interactions`` stored cells (zero ratings
    count, Q7).  ``n_users`` of them are drawn without replacement in the
    order of md5(seed|user); each draws one seed item uniformly as the item of
    least md5(seed|user|item) -- an aggregate, so a user with millions of
    cells is reduced map-side and never gathered (Q35).
    """
    if n_users <= 0:
        return cells.sparkSession.createDataFrame([], "user_id bigint, seed_item bigint, n_positives bigint")
    degree = cells.groupBy(USER).agg(F.count(F.lit(1)).alias("deg"))
    eligible = degree.where(F.col("deg") >= min_interactions).select(USER, "deg", _md5_key(seed, USER).alias("h"))
    users = top_n(eligible, n_users, [F.col("h").asc(), F.col(USER).asc()]).select(USER, "deg")
    picks = (cells.join(users.select(USER), USER, "left_semi")
             .groupBy(USER).agg(F.min_by(ITEM, _md5_key(seed, USER, ITEM)).alias("seed_item")))
    return picks.join(users, USER).select(USER, "seed_item", (F.col("deg") - 1).cast("bigint").alias("n_positives"))


def holdout_positives(cells: DataFrame, holdouts: DataFrame) -> DataFrame:
    """Every other stored item of a sampled user."""
    return (cells.join(holdouts.select(USER, "seed_item"), USER)
            .where(F.col(ITEM) != F.col("seed_item")).select(USER, ITEM))


def per_query_metrics(recs: DataFrame, holdouts: DataFrame, positives: DataFrame, recommenders: Sequence[str],
                      k_values: Sequence[int]) -> DataFrame:
    """E1-E5 for every (recommender, query, k).

    precision divides by k even for short lists; recall, NDCG and AP are 0
    on an empty positive set; IDCG and the AP denominator use min(|R|, k) (Q31).
    """
    if not k_values:
        raise ValueError("k_values must be non-empty")
    hits = (recs.join(positives.select(USER, ITEM, F.lit(1).alias("hit")), [USER, ITEM], "left")
            .withColumn("hit", F.coalesce(F.col("hit"), F.lit(0))))
    w = Window.partitionBy("recommender", USER).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("cum_hits", F.sum("hit").over(w))
    ks = F.explode(F.array(*[F.lit(int(k)) for k in k_values])).alias("k")
    cut = hits.select("*", ks).where(F.col("rank") <= F.col("k"))
    agg = cut.groupBy("recommender", USER, "k").agg(
        F.sum("hit").alias("hits"),
        F.max("hit").alias("any_hit"),
        F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.sum(F.col("hit") * F.col("cum_hits") / F.col("rank")).alias("ap_sum"),
    )
    base = holdouts.select(USER, "n_positives",
                           F.explode(F.array(*[F.lit(r) for r in recommenders])).alias("recommender"), ks)
    m = base.join(agg, ["recommender", USER, "k"], "left")
    npos = F.col("n_positives")
    hits_c = F.coalesce(F.col("hits"), F.lit(0)).cast("double")
    denom = F.least(npos, F.col("k"))
    idcg = F.aggregate(F.sequence(F.lit(1), F.greatest(denom, F.lit(1)).cast("int")), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1))
    return m.select(
        "recommender", USER, "k", "n_positives",
        F.when(F.col("k") > 0, hits_c / F.col("k")).otherwise(0.0).alias("precision"),
        F.when(npos > 0, hits_c / npos).otherwise(0.0).alias("recall"),
        F.when(denom > 0, F.coalesce(F.col("dcg"), F.lit(0.0)) / idcg).otherwise(0.0).alias("ndcg"),
        F.when(denom > 0, F.coalesce(F.col("ap_sum"), F.lit(0.0)) / denom).otherwise(0.0).alias("map"),
        F.coalesce(F.col("any_hit"), F.lit(0)).cast("double").alias("hit_rate"),
    )


def coverage(recs: DataFrame, catalog_size: F.Column | int, max_k: int, recommenders: Sequence[str]) -> DataFrame:
    """Distinct recommended items over the catalog size, for every
    recommender; one without any list covers 0."""
    size = F.lit(catalog_size) if isinstance(catalog_size, int) else catalog_size
    # every recommender has a row of its own, whose null item counts as none
    named = recs.sparkSession.createDataFrame([(r,) for r in recommenders], "recommender string")
    rows = recs.where(F.col("rank") <= max_k).select("recommender", ITEM).unionByName(named, allowMissingColumns=True)
    return rows.groupBy("recommender").agg(F.countDistinct(ITEM).alias("n_distinct")).select(
        "recommender", F.when(size > 0, F.col("n_distinct") / size).otherwise(0.0).alias("catalog_coverage"))


def list_diversity(recs: DataFrame, features: DataFrame, max_k: int) -> DataFrame:
    """Mean pairwise cosine distance inside each list.

    Items with an empty vector are left out; a distance is held to [0, 1]; a list
    with fewer than two valid items has no pairs and scores 0 downstream (Q33).
    The entries of a list meet on (list, feature); the products of two items'
    entries add up to their cosine, and pairs that share no feature have distance
    1, so only the number of all pairs is needed for them.  Up to ``MOST_SENT`` rows of
    lists: the features of other items are left out before anything is shuffled.
    """
    per_list = ["recommender", USER]
    if recs.count() <= MOST_SENT:
        listed = recs.where(F.col("rank") <= max_k).select(F.col(ITEM).alias("_listed")).distinct()
        features = features.join(F.broadcast(listed), F.col(ITEM) == F.col("_listed"), "left_semi")
    blocks = features.groupBy(ITEM).agg(F.countDistinct("block").alias("blocks"))
    items = recs.where(F.col("rank") <= max_k).select(*per_list, ITEM).distinct().join(blocks, ITEM)
    entries = items.join(features.select(ITEM, "block", "feature", "value"), ITEM).select(
        *per_list, ITEM, "block", "feature", (F.col("value") / F.sqrt("blocks")).alias("value"))
    key = [*per_list, "block", "feature"]
    met = entries.join(entries.select(*key, F.col(ITEM).alias("other"), F.col("value").alias("other_value")), key)
    cosine = met.where(F.col(ITEM) < F.col("other")).groupBy(*per_list, ITEM, "other").agg(
        F.sum(F.col("value") * F.col("other_value")).alias("cosine"))
    near = cosine.groupBy(*per_list).agg(F.sum(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("cosine")))).alias("near"))
    pairs = items.groupBy(*per_list).agg((F.count(F.lit(1)) * (F.count(F.lit(1)) - 1) / 2).alias("pairs")).where("pairs > 0")
    return pairs.join(near, per_list, "left").select(
        *per_list, (1.0 - F.coalesce("near", F.lit(0.0)) / F.col("pairs")).alias("diversity"))


def evaluate(recs: DataFrame, holdouts: DataFrame, positives: DataFrame, recommenders: Sequence[str],
             k_values: Sequence[int], catalog: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Tidy ``(recommender, k, metric, value)`` for all recommenders.

    Per-K ranking metrics are means over the queries; coverage, diversity,
    mean positives and sample count are computed once at max K and stored
    with ``k = max K`` (Q32).
    """
    if not recommenders:
        raise ValueError("no recommenders to evaluate")
    if holdouts.isEmpty():
        raise ValueError("no holdout samples: nothing to evaluate")
    max_k = max(k_values)
    pq = per_query_metrics(recs, holdouts, positives, recommenders, k_values)
    means = pq.groupBy("recommender", "k").agg(*[F.avg(m).alias(m) for m in METRICS])
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    tidy = means.select("recommender", F.col("k").cast("int").alias("k"), stack.alias("s")) \
        .select("recommender", "k", F.col("s.metric").alias("metric"), F.col("s.value").alias("value"))

    n_catalog = catalog.select(ITEM).distinct().select(F.count(F.lit(1)).cast("double")).scalar()
    base = holdouts.select(USER, "n_positives", F.explode(F.array(*[F.lit(r) for r in recommenders])).alias("recommender"))
    once = [coverage(recs, n_catalog, max_k, recommenders).select("recommender", F.lit("catalog_coverage").alias("metric"),
                                                    F.col("catalog_coverage").alias("value"))]
    if features is not None:
        div = list_diversity(recs, features, max_k)
        once.append(base.join(div, ["recommender", USER], "left").groupBy("recommender")
                    .agg(F.avg(F.coalesce(F.col("diversity"), F.lit(0.0))).alias("value"))
                    .select("recommender", F.lit("intra_list_diversity").alias("metric"), "value"))
    once.append(base.groupBy("recommender").agg(F.avg("n_positives").alias("value"))
                .select("recommender", F.lit("mean_n_positives").alias("metric"), "value"))
    once.append(base.groupBy("recommender").agg(F.count(F.lit(1)).cast("double").alias("value"))
                .select("recommender", F.lit("n_samples").alias("metric"), "value"))
    out = tidy
    for o in once:
        out = out.unionByName(o.select("recommender", F.lit(max_k).cast("int").alias("k"), "metric", "value"))
    return out.select("recommender", "k", "metric", F.round("value", 6).alias("value"))


def evaluate_recommenders(recommenders: Mapping[str, Callable[[DataFrame, int], DataFrame]], holdouts: DataFrame,
                          positives: DataFrame, k_values: Sequence[int], catalog: DataFrame,
                          features: DataFrame | None = None) -> DataFrame:
    """The report on any recommenders: a name and a function from (queries
    (user_id, seed_item), k) to lists (user_id, rank, item_id)."""
    if not recommenders:
        raise ValueError("no recommenders to evaluate")
    queries, lists = holdouts.select(USER, "seed_item"), None
    for name, recommend in recommenders.items():
        own = recommend(queries, max(k_values)).select(F.lit(name).alias("recommender"), USER, "rank", ITEM)
        lists = own if lists is None else lists.unionByName(own)
    return evaluate(cut_lineage(lists), holdouts, positives, list(recommenders), k_values, catalog, features)


def metrics_by_k(tidy: DataFrame) -> DataFrame:
    """One row per (recommender, k), one column per metric."""
    names = METRICS + ["catalog_coverage", "intra_list_diversity"]
    return tidy.where(F.col("metric").isin(names)).groupBy("recommender", "k").pivot("metric", names).agg(F.first("value"))


def leaderboard(tidy: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """Recommenders ranked by NDCG at the middle cutoff."""
    k_mid = sorted(k_values)[len(k_values) // 2]
    wide = metrics_by_k(tidy).where(F.col("k") == k_mid)
    cov = tidy.where(F.col("metric") == "catalog_coverage").select("recommender", F.col("value").alias("cov"))
    div = tidy.where(F.col("metric") == "intra_list_diversity").select("recommender", F.col("value").alias("div"))
    w = Window.orderBy(F.col("ndcg").desc(), F.col("recommender").asc())  # one row per recommender
    return (wide.drop("catalog_coverage", "intra_list_diversity").join(cov, "recommender", "left")
            .join(div, "recommender", "left")
            .withColumnRenamed("cov", "catalog_coverage").withColumnRenamed("div", "intra_list_diversity")
            .withColumn("position", F.row_number().over(w).cast("bigint")))


def write_report(tidy: DataFrame, path: str, config: dict, fmt: str = "json") -> None:
    """Persist the tidy metrics with the run configuration attached as
    literal columns (``config_<name>``), one small file per recommender."""
    cols = [F.lit(str(v) if isinstance(v, (list, tuple, dict)) else v).alias(f"config_{k}")
            for k, v in sorted(config.items())]
    out = tidy.select("*", *cols).repartition("recommender")
    out.write.mode("overwrite").format(fmt).save(path)
