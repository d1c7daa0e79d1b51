"""Registered queries: holdouts, candidates, hybrids and the offline report."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions.common import shown
from shelfwise.operators import evaluation as ev
from shelfwise.operators import hybrid, neighbors, prepare
from shelfwise.operators.coverage_bitmaps import bitmap_coverage, item_bitmaps, merged_bitmaps
from shelfwise.plans.content import book_metadata, catalog_of
from shelfwise.operators import features as feat
from shelfwise.plans.registry import REGISTRY, register
from shelfwise.plans.sql_common import CELLS, FEATURES, INTERACTIONS, UNIT, content_knn_sql, knn_sql
from shelfwise.session import cut_lineage, ensure_checkpoint_dir
from shelfwise.sources import fixtures

N_USERS = ev.DEFAULT_N_USERS
MIN_INTERACTIONS = ev.DEFAULT_MIN_INTERACTIONS
K_VALUES = ev.DEFAULT_K_VALUES
SEED = ev.DEFAULT_SEED
WEIGHTS = ev.DEFAULT_HYBRID_WEIGHTS
MAX_K = max(K_VALUES)
CAND_K = 3 * MAX_K  # over-fetch so the hybrid merges a richer pool
RECOMMENDERS = ["collaborative", "content"] + [hybrid.weight_name(a, b) for a, b in WEIGHTS]


class EvalInputs:
    """Everything the offline report needs.  Each table is built on first use
    and, when ``cut``, written once to the checkpoint folder because several
    recommenders reuse it (holdouts, features, candidate lists)."""

    def __init__(self, spark, sf_dir, cut: bool = True):
        self.spark, self.sf_dir = spark, sf_dir
        self._keep = cut_lineage if cut else (lambda d: d)
        self._cache = {}

    def _once(self, key, build):
        if key not in self._cache:
            self._cache[key] = self._keep(build())
        return self._cache[key]

    @property
    def cells(self):
        """Read by the holdouts, the positives and the collaborative lists."""
        return self._once("cells", lambda: prepare.rating_cells(fixtures.interactions(self.spark, self.sf_dir)))

    @property
    def catalog(self):
        return self._once("catalog", lambda: self.cells.select("item_id").distinct())

    @property
    def holdouts(self):
        return self._once("holdouts", lambda: ev.sample_holdouts(self.cells, N_USERS, MIN_INTERACTIONS, SEED))

    @property
    def positives(self):
        # N_USERS rows at most: sent to the cells, which are not shuffled by user
        return ev.holdout_positives(self.cells, F.broadcast(self.holdouts))

    def _seeds(self):
        return self.holdouts.select(F.col("seed_item").alias("item_id"))

    @property
    def features(self):
        return self._once("features", lambda: feat.content_features(
            book_metadata(self.spark, self.sf_dir, self.catalog), self.catalog))

    @property
    def collab_nb(self):
        return self._once("collab", lambda: neighbors.item_neighbors(self.cells, k=CAND_K, seeds=self._seeds()))

    @property
    def content_nb(self):
        return self._once("content", lambda: neighbors.content_neighbors(self.features, self.catalog,
                                                                        self._seeds(), k=CAND_K))

    def per_query(self, nb):
        q = self.holdouts.select("user_id", F.col("seed_item"))
        return q.join(nb.withColumnRenamed("item_id", "seed_item"), "seed_item").select(
            "user_id", "seed_item", "rank", F.col("neighbor_id").alias("item_id"), "similarity")

    def hybrid_recs(self, weights=WEIGHTS):
        return hybrid.hybrid(self.per_query(self.collab_nb), self.per_query(self.content_nb), weights, MAX_K)

    def recs(self):
        single = [hybrid.single_method(self.per_query(self.collab_nb), "collaborative", MAX_K),
                  hybrid.single_method(self.per_query(self.content_nb), "content", MAX_K)]
        out = self.hybrid_recs()
        for s in single:
            out = out.unionByName(s)
        return out.select("recommender", "user_id", "rank", "item_id")

    def report(self):
        # The lists (users x recommenders x K rows) feed five aggregations;
        # written once they are not re-derived from the candidates each time.
        recs = cut_lineage(self.recs())
        return ev.evaluate(recs, self.holdouts, self.positives, RECOMMENDERS, K_VALUES, self.catalog,
                           self.features)


def shown_lists(recs):
    return recs.withColumns({c: shown(c) for c in ("score", "collab_score", "content_score")})


# --------------------------------------------------------------------------- SQL

HOLDOUTS_SQL = f"""
  {UNIT},
  deg AS (SELECT user_id, COUNT(*) AS deg FROM cells GROUP BY user_id),
  husers AS (SELECT user_id, deg FROM deg WHERE deg >= {MIN_INTERACTIONS}
             ORDER BY md5('{SEED}|' || CAST(user_id AS VARCHAR)), user_id LIMIT {N_USERS}),
  holdouts AS (
    SELECT c.user_id,
           arg_min(c.item_id, md5('{SEED}|' || CAST(c.user_id AS VARCHAR) || '|' || CAST(c.item_id AS VARCHAR))) AS seed_item,
           CAST(ANY_VALUE(h.deg) - 1 AS BIGINT) AS n_positives
    FROM cells c JOIN husers h USING (user_id) GROUP BY c.user_id),
  seeds AS (SELECT DISTINCT seed_item AS item_id FROM holdouts)
"""

_grid = ", ".join(f"('{hybrid.weight_name(a, b)}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in WEIGHTS)
_names = ", ".join(f"('{r}')" for r in RECOMMENDERS)
_ks = ", ".join(f"({k})" for k in K_VALUES)

CANDIDATES_SQL = f"""
  {HOLDOUTS_SQL},
  {FEATURES},
  {knn_sql("seeds", CAND_K)},
  {content_knn_sql("seeds")},
  cc AS (SELECT h.user_id, k.neighbor_id AS item_id, k.similarity, k.rank
         FROM holdouts h JOIN knn k ON k.item_id = h.seed_item WHERE k.rank <= {CAND_K}),
  tc AS (SELECT h.user_id, k.neighbor_id AS item_id, k.similarity, k.rank
         FROM holdouts h JOIN cknn k ON k.item_id = h.seed_item WHERE k.rank <= {CAND_K}),
  merged AS (SELECT COALESCE(cc.user_id, tc.user_id) AS user_id, COALESCE(cc.item_id, tc.item_id) AS item_id,
                    COALESCE(cc.similarity, 0.0) AS collab_score, COALESCE(tc.similarity, 0.0) AS content_score
             FROM cc FULL OUTER JOIN tc ON cc.user_id = tc.user_id AND cc.item_id = tc.item_id),
  grid AS (SELECT * FROM (VALUES {_grid}) g(recommender, wc, wt)),
  hscored AS (SELECT g.recommender, m.user_id, m.item_id,
                     g.wc * m.collab_score + g.wt * m.content_score AS score, m.collab_score, m.content_score
              FROM merged m, grid g),
  hyb AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY recommender, user_id ORDER BY score DESC, item_id) AS rank
                         FROM hscored) WHERE rank <= {MAX_K}),
  recs AS (SELECT recommender, user_id, rank, item_id FROM hyb
           UNION ALL SELECT 'collaborative', user_id, rank, item_id FROM cc WHERE rank <= {MAX_K}
           UNION ALL SELECT 'content', user_id, rank, item_id FROM tc WHERE rank <= {MAX_K})
"""

REPORT_SQL = f"""
  {CANDIDATES_SQL},
  positives AS (SELECT c.user_id, c.item_id FROM cells c JOIN holdouts h USING (user_id) WHERE c.item_id <> h.seed_item),
  hits AS (SELECT r.*, CASE WHEN p.item_id IS NULL THEN 0 ELSE 1 END AS hit
           FROM recs r LEFT JOIN positives p ON p.user_id = r.user_id AND p.item_id = r.item_id),
  hc AS (SELECT *, SUM(hit) OVER (PARTITION BY recommender, user_id ORDER BY rank
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hits FROM hits),
  ks AS (SELECT * FROM (VALUES {_ks}) t(k)),
  agg AS (SELECT recommender, user_id, k, SUM(hit) AS hits, MAX(hit) AS any_hit,
                 SUM(hit / LOG2(rank + 1)) AS dcg, SUM(hit * cum_hits / rank) AS ap_sum
          FROM hc JOIN ks ON hc.rank <= ks.k GROUP BY recommender, user_id, k),
  recnames AS (SELECT * FROM (VALUES {_names}) t(recommender)),
  base AS (SELECT h.user_id, h.n_positives, r.recommender, ks.k FROM holdouts h, recnames r, ks),
  idcg AS (SELECT i AS n, SUM(1.0 / LOG2(i + 1)) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS idcg
           FROM range(1, {MAX_K + 1}) t(i)),
  pq AS (
    SELECT b.recommender, b.user_id, b.k, b.n_positives,
           CASE WHEN b.k > 0 THEN COALESCE(a.hits, 0) / b.k ELSE 0.0 END AS precision,
           CASE WHEN b.n_positives > 0 THEN COALESCE(a.hits, 0) / b.n_positives ELSE 0.0 END AS recall,
           CASE WHEN LEAST(b.n_positives, b.k) > 0 THEN COALESCE(a.dcg, 0.0) / ig.idcg ELSE 0.0 END AS ndcg,
           CASE WHEN LEAST(b.n_positives, b.k) > 0 THEN COALESCE(a.ap_sum, 0.0) / LEAST(b.n_positives, b.k) ELSE 0.0 END AS map,
           CAST(COALESCE(a.any_hit, 0) AS DOUBLE) AS hit_rate
    FROM base b LEFT JOIN agg a ON a.recommender = b.recommender AND a.user_id = b.user_id AND a.k = b.k
    LEFT JOIN idcg ig ON ig.n = GREATEST(LEAST(b.n_positives, b.k), 1)),
  means AS (SELECT recommender, k, AVG(precision) AS precision, AVG(recall) AS recall, AVG(ndcg) AS ndcg,
                   AVG(map) AS map, AVG(hit_rate) AS hit_rate FROM pq GROUP BY recommender, k),
  ncat AS (SELECT CAST(COUNT(DISTINCT item_id) AS DOUBLE) AS n FROM cells),
  cov AS (SELECT recommender, COUNT(DISTINCT item_id) / (SELECT n FROM ncat) AS v
          FROM recs WHERE rank <= {MAX_K} GROUP BY recommender),
  litems AS (SELECT r.recommender, r.user_id, r.rank, r.item_id, nb.nb FROM recs r JOIN nb ON nb.item_id = r.item_id
             WHERE r.rank <= {MAX_K}),
  lpairs AS (SELECT a.recommender, a.user_id, a.item_id AS ia, b.item_id AS ib, SQRT(CAST(a.nb AS DOUBLE) * b.nb) AS norms
             FROM litems a JOIN litems b ON a.recommender = b.recommender AND a.user_id = b.user_id AND a.rank < b.rank),
  lfeat AS (SELECT l.recommender, l.user_id, l.rank, l.item_id, f.block, f.feature, f.value
            FROM litems l JOIN features f ON f.item_id = l.item_id),
  ldots AS (SELECT x.recommender, x.user_id, x.item_id AS ia, y.item_id AS ib, SUM(x.value * y.value) AS dot
            FROM lfeat x JOIN lfeat y ON x.recommender = y.recommender AND x.user_id = y.user_id
                 AND x.block = y.block AND x.feature = y.feature AND x.rank < y.rank
            GROUP BY 1, 2, 3, 4),
  ldist AS (SELECT p.recommender, p.user_id,
                   AVG(LEAST(GREATEST(1.0 - COALESCE(d.dot, 0.0) / p.norms, 0.0), 1.0)) AS diversity
            FROM lpairs p LEFT JOIN ldots d ON d.recommender = p.recommender AND d.user_id = p.user_id
                 AND d.ia = p.ia AND d.ib = p.ib
            GROUP BY p.recommender, p.user_id),
  bq AS (SELECT DISTINCT recommender, user_id, n_positives FROM base),
  tidy AS (
    SELECT recommender, k, 'precision' AS metric, precision AS value FROM means UNION ALL
    SELECT recommender, k, 'recall', recall FROM means UNION ALL
    SELECT recommender, k, 'ndcg', ndcg FROM means UNION ALL
    SELECT recommender, k, 'map', map FROM means UNION ALL
    SELECT recommender, k, 'hit_rate', hit_rate FROM means UNION ALL
    SELECT recommender, {MAX_K}, 'catalog_coverage', v FROM cov UNION ALL
    SELECT bq.recommender, {MAX_K}, 'intra_list_diversity', AVG(COALESCE(ld.diversity, 0.0))
      FROM bq LEFT JOIN ldist ld ON ld.recommender = bq.recommender AND ld.user_id = bq.user_id GROUP BY bq.recommender
    UNION ALL SELECT recommender, {MAX_K}, 'mean_n_positives', AVG(n_positives) FROM bq GROUP BY recommender
    UNION ALL SELECT recommender, {MAX_K}, 'n_samples', CAST(COUNT(*) AS DOUBLE) FROM bq GROUP BY recommender)
"""


@register("holdouts", "E8 W6 A31 Q35", f"""
WITH {HOLDOUTS_SQL}
SELECT user_id, seed_item, n_positives FROM holdouts
""")
def q_holdouts(spark, sf_dir):
    cells = prepare.rating_cells(fixtures.interactions(spark, sf_dir))
    return ev.sample_holdouts(cells, N_USERS, MIN_INTERACTIONS, SEED)


@register("collab_candidates", "R1 R5 J14 W1 Q23 Q24", f"""
WITH {HOLDOUTS_SQL}, {knn_sql("seeds", CAND_K)}
SELECT item_id, neighbor_id, CAST(rank AS BIGINT) AS rank, ROUND(similarity, 6) AS similarity FROM knn WHERE rank <= {CAND_K}
""")
def q_collab_candidates(spark, sf_dir):
    return EvalInputs(spark, sf_dir).collab_nb.withColumn("similarity", shown("similarity"))


@register("content_candidates", "R2 R6 J8 J15 Q21 Q25", f"""
WITH {HOLDOUTS_SQL}, {FEATURES}, {content_knn_sql("seeds")}
SELECT item_id, neighbor_id, CAST(rank AS BIGINT) AS rank, ROUND(similarity, 6) AS similarity FROM cknn WHERE rank <= {CAND_K}
""")
def q_content_candidates(spark, sf_dir):
    return EvalInputs(spark, sf_dir).content_nb.withColumn("similarity", shown("similarity"))


@register("hybrid_recs", "R3 R4 J11 T1 L4 P15 Q26", f"""
WITH {CANDIDATES_SQL}
SELECT recommender, user_id, CAST(rank AS BIGINT) AS rank, item_id, ROUND(score, 6) AS score,
       ROUND(collab_score, 6) AS collab_score, ROUND(content_score, 6) AS content_score FROM hyb
""")
def q_hybrid_recs(spark, sf_dir):
    return shown_lists(EvalInputs(spark, sf_dir).hybrid_recs())


CLOSE_WEIGHTS = tuple(hybrid.parse_weights(w) for w in ("0.65:0.35", "0.7:0.3", "0.66:0.34"))
_close = ", ".join(f"('{hybrid.weight_name(a, b)}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in CLOSE_WEIGHTS)


@register("hybrid_close_weights", "R4 R11 P18", f"""
WITH {CANDIDATES_SQL.replace(_grid, _close)}
SELECT recommender, user_id, CAST(rank AS BIGINT) AS rank, item_id, ROUND(score, 6) AS score,
       ROUND(collab_score, 6) AS collab_score, ROUND(content_score, 6) AS content_score FROM hyb
""")
def q_hybrid_close_weights(spark, sf_dir):
    """Weight pairs that are alike at one decimal keep lists of their own."""
    return shown_lists(EvalInputs(spark, sf_dir).hybrid_recs(CLOSE_WEIGHTS))


OUTSIDE = 100_000_000


@register("content_outside_seeds", "R2 R6 Q27", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES},
seeds AS (SELECT item_id FROM catalog), {content_knn_sql("seeds")}
SELECT item_id, neighbor_id, CAST(rank AS BIGINT) AS rank, ROUND(similarity, 6) AS similarity FROM cknn WHERE rank <= 10
""")
def q_content_outside_seeds(spark, sf_dir):
    """Seeds beyond the content catalog have no list."""
    catalog = cut_lineage(catalog_of(spark, sf_dir))
    feats = cut_lineage(feat.content_features(book_metadata(spark, sf_dir, catalog), catalog))
    seeds = catalog.unionByName(catalog.select((F.col("item_id") + OUTSIDE).alias("item_id")))
    return neighbors.content_neighbors(feats, catalog, seeds, k=10).withColumn("similarity", shown("similarity"))


@register("coverage_of_recommenders", "E6 A17", f"""
WITH {CELLS},
r AS (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM cells)
SELECT 'own best' AS recommender, ROUND(COUNT(DISTINCT item_id) / (SELECT CAST(COUNT(DISTINCT item_id) AS DOUBLE) FROM cells), 6)
       AS catalog_coverage FROM r WHERE rank <= 3
UNION ALL SELECT 'silent', 0.0
""")
def q_coverage_of_recommenders(spark, sf_dir):
    """A recommender without a single list covers 0."""
    cells = prepare.rating_cells(fixtures.interactions(spark, sf_dir))
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc(), "item_id")
    recs = cells.select(F.lit("own best").alias("recommender"), "user_id", "item_id", F.row_number().over(w).alias("rank"))
    size = cells.select(F.countDistinct("item_id").cast("double")).scalar()
    return ev.coverage(recs, size, 3, ["own best", "silent"]).withColumn("catalog_coverage", shown("catalog_coverage"))


COVERAGE_KS = (1, 3, 10)
_cover_ks = ", ".join(f"({k})" for k in COVERAGE_KS)


@register("coverage_at_k", "E6 A17 T5", f"""
WITH {CELLS},
r AS (SELECT item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS best,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rating, item_id) AS worst FROM cells),
recs AS (SELECT 'own best' AS recommender, item_id, best AS rank FROM r UNION ALL SELECT 'own worst', item_id, worst FROM r),
ks AS (SELECT * FROM (VALUES {_cover_ks}) t(k))
SELECT recommender, k, COUNT(DISTINCT item_id) AS n_distinct,
       ROUND(COUNT(DISTINCT item_id) / (SELECT CAST(COUNT(DISTINCT item_id) AS DOUBLE) FROM cells), 6) AS catalog_coverage
FROM recs JOIN ks ON rank <= k GROUP BY recommender, k
UNION ALL SELECT 'silent', k, 0, 0.0 FROM ks
""")
def q_coverage_at_k(spark, sf_dir):
    """Two runs, one for users of even and one for users of odd id, stored as bitmaps
    and merged: coverage at every cutoff without the lists."""
    cells = cut_lineage(prepare.rating_cells(fixtures.interactions(spark, sf_dir)))
    places = cut_lineage(prepare.index_ids(cells, "item_id"))
    folder = f"{ensure_checkpoint_dir(spark)}/bitmaps-{uuid.uuid4().hex}"
    for odd in (0, 1):
        run, lists = cells.where(F.abs("user_id") % 2 == odd), None
        for name, order in (("own best", F.col("rating").desc()), ("own worst", F.col("rating").asc())):
            w = Window.partitionBy("user_id").orderBy(order, "item_id")
            own = run.select(F.lit(name).alias("recommender"), "item_id", F.row_number().over(w).alias("rank"))
            lists = own if lists is None else lists.unionByName(own)
        item_bitmaps(lists, places, COVERAGE_KS).write.parquet(f"{folder}/run={odd}")
    merged = merged_bitmaps(spark.read.parquet(folder))
    covered = bitmap_coverage(merged, places.count(), ["own best", "own worst", "silent"], COVERAGE_KS)
    return covered.withColumn("catalog_coverage", shown("catalog_coverage"))


@register("evaluator_popular", "E9 E10 E13", f"""
WITH {HOLDOUTS_SQL},
pop AS (SELECT item_id, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, item_id) AS place FROM cells GROUP BY item_id),
lists AS (SELECT h.user_id, p.item_id, ROW_NUMBER() OVER (PARTITION BY h.user_id ORDER BY p.place) AS rank
          FROM holdouts h JOIN pop p ON p.place <= 11 AND p.item_id <> h.seed_item),
hits AS (SELECT l.user_id, COUNT(c.item_id) AS hits FROM lists l LEFT JOIN cells c ON c.user_id = l.user_id AND c.item_id = l.item_id
         WHERE l.rank <= 10 GROUP BY l.user_id)
SELECT 'popular' AS recommender, CAST(10 AS INTEGER) AS k, 'precision' AS metric, ROUND(AVG(hits / 10.0), 6) AS value FROM hits
UNION ALL SELECT 'popular', 10, 'hit_rate', ROUND(AVG(CAST(hits > 0 AS INTEGER)), 6) FROM hits
""")
def q_evaluator_popular(spark, sf_dir):
    """Any function can be evaluated: here the most-read books for everyone."""
    inputs = EvalInputs(spark, sf_dir)

    def popular(queries, k):
        top = prepare.top_items(inputs.cells, k + 1).withColumn("place", F.col("n_interactions"))
        listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("place")).alias("p"), "item_id"))).alias("top"))
        own = queries.select("user_id", "seed_item", F.lit(listed.select("top").scalar()).alias("top"))
        items = F.slice(F.filter(F.transform("top", lambda t: t["item_id"]), lambda i: i != F.col("seed_item")), 1, k)
        return own.select("user_id", F.posexplode(items).alias("pos", "item_id")).select(
            "user_id", (F.col("pos") + 1).cast("bigint").alias("rank"), "item_id")

    report = ev.evaluate_recommenders({"popular": popular}, inputs.holdouts, inputs.positives, [10], inputs.catalog)
    return report.where(F.col("metric").isin("precision", "hit_rate"))


@register("eval_metrics", "E1 E2 E3 E4 E5 E6 E7 E9 E10 E11 E14 A16 A17 A18 A31 J13 J16 T5 T6 W3 W4 L7 Q31 Q32 Q33 Q34", f"""
WITH {REPORT_SQL}
SELECT recommender, CAST(k AS INTEGER) AS k, metric, ROUND(value, 6) AS value FROM tidy
""")
def q_eval_metrics(spark, sf_dir):
    return EvalInputs(spark, sf_dir).report()


_PIVOT = ", ".join(f"MAX(value) FILTER (WHERE metric = '{m}') AS {m}" for m in ev.METRICS + ["catalog_coverage",
                                                                                           "intra_list_diversity"])


@register("metrics_by_k", "E13", f"""
WITH {REPORT_SQL},
t2 AS (SELECT recommender, CAST(k AS INTEGER) AS k, metric, ROUND(value, 6) AS value FROM tidy)
SELECT recommender, k, {_PIVOT} FROM t2
WHERE metric IN ('precision', 'recall', 'ndcg', 'map', 'hit_rate', 'catalog_coverage', 'intra_list_diversity')
GROUP BY recommender, k
""")
def q_metrics_by_k(spark, sf_dir):
    return ev.metrics_by_k(EvalInputs(spark, sf_dir).report())


_KMID = sorted(K_VALUES)[len(K_VALUES) // 2]


@register("leaderboard", "E12 W7", f"""
WITH {REPORT_SQL},
t2 AS (SELECT recommender, CAST(k AS INTEGER) AS k, metric, ROUND(value, 6) AS value FROM tidy),
w AS (SELECT recommender, k, {", ".join(f"MAX(value) FILTER (WHERE metric = '{m}') AS {m}" for m in ev.METRICS)}
      FROM t2 WHERE k = {_KMID} GROUP BY recommender, k),
c AS (SELECT recommender, value AS catalog_coverage FROM t2 WHERE metric = 'catalog_coverage'),
d AS (SELECT recommender, value AS intra_list_diversity FROM t2 WHERE metric = 'intra_list_diversity')
SELECT w.*, c.catalog_coverage, d.intra_list_diversity,
       CAST(ROW_NUMBER() OVER (ORDER BY w.ndcg DESC, w.recommender) AS BIGINT) AS position
FROM w LEFT JOIN c USING (recommender) LEFT JOIN d USING (recommender)
""")
def q_leaderboard(spark, sf_dir):
    return ev.leaderboard(EvalInputs(spark, sf_dir).report(), K_VALUES)


_POPULAR = REGISTRY["evaluator_popular"]


@register("report_file", "S9", f"""
SELECT recommender, CAST(k AS BIGINT) AS k, metric, value, CAST({SEED} AS BIGINT) AS config_seed, '[10]' AS config_k_values
FROM ({_POPULAR.sql})
""")
def q_report_file(spark, sf_dir):
    """The report written with its run configuration and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/report-{uuid.uuid4().hex}"
    ev.write_report(_POPULAR.build(spark, sf_dir), folder, {"seed": SEED, "k_values": [10]})
    return spark.read.json(folder)


@register("mapped_content_neighbors", "J10 Q25", f"""
WITH inter AS ({INTERACTIONS}), {FEATURES},
seeds AS (SELECT item_id FROM catalog), {content_knn_sql("seeds")}
SELECT item_id, neighbor_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY rank) AS BIGINT) AS rank,
       ROUND(similarity, 6) AS similarity
FROM cknn WHERE rank <= 12 AND neighbor_id % 3 <> 0
""")
def q_mapped_content_neighbors(spark, sf_dir):
    """Neighbours that the collaborative side does not know are dropped, without
    others in their place."""
    catalog = cut_lineage(catalog_of(spark, sf_dir))
    feats = cut_lineage(feat.content_features(book_metadata(spark, sf_dir, catalog), catalog))
    lists = neighbors.content_neighbors(feats, catalog, catalog, k=12)
    known = catalog.where("item_id % 3 <> 0")
    return neighbors.mapped_only(lists, known).withColumn("similarity", shown("similarity"))
