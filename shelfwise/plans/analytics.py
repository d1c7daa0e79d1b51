"""Registered queries: data-set profile, edition consolidation and the
list analytics of a weight sweep (B2, B7, B9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.common import shown
from shelfwise.operators import analytics, hybrid, prepare, recommend, search
from shelfwise.operators.selection import exact_quantiles
from shelfwise.plans.content import book_metadata, catalog_of
from shelfwise.plans.registry import register
from shelfwise.plans.search import _TITLES, _WORDS, title_words
from shelfwise.plans.sql_common import CELLS, FEATURES, INTERACTIONS, META as META_ONLY, UNIT, content_knn_sql, knn_sql, partial_ctes
from shelfwise.session import cut_lineage
from shelfwise.sources import fixtures

TOP_N = 500
MIN_READS = 10
SWEEP_N = 20
SWEEP_CANDIDATES = 3 * SWEEP_N
SEARCH_THRESHOLD = 60
# The six weightings of the configuration sweep.
SWEEP_WEIGHTS = ((1.0, 0.0), (0.0, 1.0), (0.7, 0.3), (0.6, 0.4), (0.5, 0.5), (0.4, 0.6))
SWEEP_NAMES = [hybrid.weight_name(a, b) for a, b in SWEEP_WEIGHTS]
LIST_METRICS = ["mean_score", "genre_uniqueness", "coverage", "novelty"]


def _cells(spark, sf_dir):
    return prepare.rating_cells(fixtures.interactions(spark, sf_dir))


@register("item_profile", "A6 A7 A8 Q36", f"""
WITH {CELLS},
per_item AS (SELECT item_id AS k, CAST(SUM(rating) AS DOUBLE) AS v FROM cells GROUP BY item_id),
per_user AS (SELECT user_id AS k, CAST(SUM(rating) AS DOUBLE) AS v FROM cells GROUP BY user_id)
SELECT 'item_id' AS side, CAST(COUNT(*) AS BIGINT) AS n, SUM(v) AS total, ROUND(AVG(v), 6) AS mean, MIN(v) AS min,
       MAX(v) AS max, MEDIAN(v) AS median FROM per_item
UNION ALL
SELECT 'user_id', CAST(COUNT(*) AS BIGINT), SUM(v), ROUND(AVG(v), 6), MIN(v), MAX(v), MEDIAN(v) FROM per_user
""")
def q_item_profile(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return analytics.side_profile(cells, "item_id").unionByName(analytics.side_profile(cells, "user_id"))


QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


@register("user_mean_quantiles", "A8", f"""
WITH {CELLS},
per_user AS (SELECT user_id, CAST(SUM(rating) AS DOUBLE) / COUNT(*) AS v FROM cells GROUP BY user_id)
{" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS probability, ROUND(QUANTILE_CONT(v, {p}), 6) AS value FROM per_user" for p in QUANTILES)}
""")
def q_user_mean_quantiles(spark, sf_dir):
    """Quantiles of the users' mean cell by counting passes."""
    per_user = _cells(spark, sf_dir).groupBy("user_id").agg((F.sum("rating") / F.count(F.lit(1))).alias("v"))
    return exact_quantiles(per_user, "v", QUANTILES).withColumn("value", shown("value"))


@register("popularity_histogram", "A9", f"""
WITH {CELLS},
pop AS (SELECT item_id, CAST(SUM(rating) AS DOUBLE) AS popularity FROM cells GROUP BY item_id),
b AS (SELECT MIN(popularity) AS lo, MAX(popularity) AS hi FROM pop),
binned AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
                        ELSE LEAST(FLOOR((p.popularity - b.lo) / ((b.hi - b.lo) / 50)), 49) END AS INTEGER) AS bin,
                  b.lo, (b.hi - b.lo) / 50 AS width FROM pop p, b)
SELECT bin, ROUND(ANY_VALUE(lo) + bin * ANY_VALUE(width), 6) AS lower,
       ROUND(ANY_VALUE(lo) + (bin + 1) * ANY_VALUE(width), 6) AS upper, CAST(COUNT(*) AS BIGINT) AS n
FROM binned GROUP BY bin
""")
def q_popularity_histogram(spark, sf_dir):
    return analytics.histogram(analytics.item_popularity(_cells(spark, sf_dir)), "popularity", analytics.HIST_BINS)


@register("popularity_rank", "W5", f"""
WITH inter AS ({INTERACTIONS})
SELECT item_id, CAST(COUNT(*) AS BIGINT) AS n_interactions,
       CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, item_id) AS BIGINT) AS popularity_rank
FROM inter GROUP BY item_id
""")
def q_popularity_rank(spark, sf_dir):
    return analytics.popularity_rank(fixtures.interactions(spark, sf_dir))


_FAMILY = "trim(regexp_replace(lower(p_name), '\\s*\\([^)]*\\)\\s*$', ''))"


@register("title_fragmentation", "A28", f"""
WITH inter AS ({INTERACTIONS}),
r AS (SELECT item_id, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, item_id) AS rk FROM inter GROUP BY item_id),
f AS (SELECT p_partkey AS item_id, {_FAMILY} AS family FROM part)
SELECT family, CAST(COUNT(*) AS BIGINT) AS n_ids, CAST(COUNT(*) FILTER (WHERE rk <= {TOP_N}) AS BIGINT) AS n_ids_in_top,
       CAST(SUM(n) AS BIGINT) AS n_interactions, ROUND(MAX(n) / SUM(n), 6) AS top_id_share
FROM r JOIN f USING (item_id) GROUP BY family
""")
def q_title_fragmentation(spark, sf_dir):
    return analytics.fragmentation(fixtures.interactions(spark, sf_dir), fixtures.title_table(spark, sf_dir), TOP_N)


@register("prepare_funnel", "A29", f"""
WITH inter AS ({INTERACTIONS}),
c AS (SELECT item_id, COUNT(*) AS n FROM inter GROUP BY item_id),
s AS (SELECT COUNT(*) AS raw, COUNT(*) FILTER (WHERE n >= {MIN_READS}) AS active FROM c)
SELECT 1 AS step, 'raw' AS stage, CAST(raw AS BIGINT) AS n_items FROM s
UNION ALL SELECT 2, 'min_reads_{MIN_READS}', CAST(active AS BIGINT) FROM s
UNION ALL SELECT 3, 'top_{TOP_N}', CAST(LEAST(active, {TOP_N}) AS BIGINT) FROM s
""")
def q_prepare_funnel(spark, sf_dir):
    return analytics.funnel(fixtures.interactions(spark, sf_dir), MIN_READS, TOP_N)


@register("item_density", "A30", f"""
WITH {CELLS}
SELECT item_id, CAST(COUNT(*) AS BIGINT) AS nnz,
       ROUND(COUNT(*) / (SELECT CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM cells), 9) AS density
FROM cells GROUP BY item_id
""")
def q_item_density(spark, sf_dir):
    return analytics.item_density(_cells(spark, sf_dir))


@register("consolidated_cells", "C8", f"""
WITH inter AS ({INTERACTIONS}),
c AS (SELECT item_id, COUNT(*) AS n FROM inter GROUP BY item_id),
fam AS (SELECT p_partkey AS item_id, {_FAMILY} AS family FROM part),
fc AS (SELECT fam.*, c.n FROM fam JOIN c USING (item_id)),
canon AS (SELECT family, arg_min(item_id, (-n, item_id)) AS canonical_id FROM fc GROUP BY family),
m AS (SELECT fc.item_id, canon.canonical_id FROM fc JOIN canon USING (family)),
mapped AS (SELECT i.user_id, COALESCE(m.canonical_id, i.item_id) AS item_id, i.rating FROM inter i LEFT JOIN m USING (item_id))
SELECT item_id, user_id, CAST(SUM(rating) AS DOUBLE) AS rating FROM mapped GROUP BY item_id, user_id
""")
def q_consolidated_cells(spark, sf_dir):
    inter = analytics.consolidate_editions(fixtures.interactions(spark, sf_dir), fixtures.title_table(spark, sf_dir))
    return prepare.rating_cells(inter)


# --------------------------------------------------------------------------- weight sweep

class Sweep:
    """The inputs of the sweep queries, from the fixtures; each is derived once,
    when a query first asks for it."""

    def __init__(self, spark, sf_dir, n: int = SWEEP_N, weights=SWEEP_WEIGHTS):
        self.weights = weights
        self.cells = cut_lineage(_cells(spark, sf_dir))
        self.catalog = cut_lineage(self.cells.select("item_id").distinct())
        self.titles = fixtures.title_table(spark, sf_dir)
        self.words = title_words(spark, sf_dir)
        # metadata feeds the features, the genre analytics and the detail columns
        self.metadata = cut_lineage(book_metadata(spark, sf_dir, self.catalog))
        self.found = recommend.TitleRecommender(self.words, self.titles, self.cells, self.catalog, self.metadata, n,
                                                SEARCH_THRESHOLD)

    def recs(self):
        return self.found.hybrid(self.weights)

    def list_metrics(self):
        pop = analytics.item_popularity(self.cells)
        n_cat = self.catalog.select(F.count(F.lit(1)).cast("double")).scalar()
        return analytics.list_metrics(self.recs(), self.metadata, pop, n_cat)


def title_hybrid_sql(weights, n, n_cand) -> str:
    """CTEs up to ``recs``: title-word queries -> best title match -> padded
    collaborative and content candidates -> weighted hybrids."""
    grid = ", ".join(f"('{hybrid.weight_name(a, b)}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in weights)
    return f"""
  {UNIT}, {FEATURES}, {_TITLES}, {_WORDS},
  wq AS (SELECT query, CAST(ROW_NUMBER() OVER (ORDER BY query) - 1 AS BIGINT) AS query_id FROM words),
  spairs AS (SELECT w.query_id, lower(w.query) AS a, t.title, t.item_id, lower(t.title) AS b FROM wq w, titles t),
  {partial_ctes("spairs", "sscored", SEARCH_THRESHOLD)},
  best AS (SELECT query_id, item_id FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS r
             FROM sscored WHERE score >= {SEARCH_THRESHOLD}) WHERE r = 1),
  seeds AS (SELECT DISTINCT item_id FROM best),
  {knn_sql("seeds", n_cand)},
  {content_knn_sql("seeds")},
  cc AS (SELECT b.query_id, k.neighbor_id AS item_id, k.similarity FROM best b JOIN knn k ON k.item_id = b.item_id
         WHERE k.rank <= {n_cand}),
  tc AS (SELECT b.query_id, k.neighbor_id AS item_id, k.similarity FROM best b JOIN cknn k ON k.item_id = b.item_id
         WHERE k.rank <= {n_cand}),
  merged AS (SELECT COALESCE(cc.query_id, tc.query_id) AS query_id, COALESCE(cc.item_id, tc.item_id) AS item_id,
                    COALESCE(cc.similarity, 0.0) AS collab_score, COALESCE(tc.similarity, 0.0) AS content_score
             FROM cc FULL OUTER JOIN tc ON cc.query_id = tc.query_id AND cc.item_id = tc.item_id),
  grid AS (SELECT * FROM (VALUES {grid}) g(recommender, wc, wt)),
  hs AS (SELECT g.recommender, m.query_id, m.item_id, g.wc * m.collab_score + g.wt * m.content_score AS score,
                m.collab_score, m.content_score FROM merged m, grid g),
  recs AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY recommender, query_id ORDER BY score DESC, item_id) AS rank
                          FROM hs) WHERE rank <= {n})
"""


SWEEP_SQL = title_hybrid_sql(SWEEP_WEIGHTS, SWEEP_N, SWEEP_CANDIDATES) + """,
  pop AS (SELECT item_id, CAST(SUM(rating) AS DOUBLE) AS popularity FROM cells GROUP BY item_id),
  genres AS (SELECT item_id, string_split(shelves, ',')[1:5] AS genres FROM meta WHERE COALESCE(shelves, '') <> ''),
  lbase AS (SELECT r.recommender, r.query_id, AVG(CAST(ROUND(r.score * 1e7) AS BIGINT)) / 1e7 AS mean_score,
                   COUNT(DISTINCT r.item_id) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM catalog) AS coverage,
                   AVG(1.0 - COALESCE(p.popularity, 0.0) / (SELECT MAX(popularity) FROM pop)) AS novelty
            FROM recs r LEFT JOIN pop p USING (item_id) GROUP BY r.recommender, r.query_id),
  lgen AS (SELECT r.recommender, r.query_id, COUNT(DISTINCT g) / CAST(COUNT(*) AS DOUBLE) AS genre_uniqueness
           FROM recs r JOIN (SELECT item_id, unnest(genres) AS g FROM genres) x USING (item_id)
           GROUP BY r.recommender, r.query_id),
  lm AS (SELECT b.recommender, b.query_id, FLOOR(b.mean_score * 1000000.0 + 0.5) / 1000000.0 AS mean_score,
                ROUND(COALESCE(g.genre_uniqueness, 0.0), 6) AS genre_uniqueness, ROUND(b.coverage, 6) AS coverage,
                ROUND(b.novelty, 6) AS novelty
         FROM lbase b LEFT JOIN lgen g USING (recommender, query_id))
"""


@register("sweep_list_metrics", "R11 A21 A22 A23 Q36 Q37", f"""
WITH RECURSIVE {SWEEP_SQL}
SELECT * FROM lm
""")
def q_sweep_list_metrics(spark, sf_dir):
    return Sweep(spark, sf_dir).list_metrics()


@register("sweep_summary", "A26 A27", f"""
WITH RECURSIVE {SWEEP_SQL},
means AS (SELECT recommender, ROUND(AVG(mean_score), 3) AS mean_score, ROUND(AVG(genre_uniqueness), 3) AS genre_uniqueness,
                 ROUND(AVG(coverage), 3) AS coverage, ROUND(AVG(novelty), 3) AS novelty FROM lm GROUP BY recommender),
t AS (SELECT recommender, 'mean_score' AS metric, mean_score AS value FROM means UNION ALL
      SELECT recommender, 'genre_uniqueness', genre_uniqueness FROM means UNION ALL
      SELECT recommender, 'coverage', coverage FROM means UNION ALL
      SELECT recommender, 'novelty', novelty FROM means UNION ALL
      SELECT recommender, 'overall', (mean_score + genre_uniqueness + coverage + novelty) / 4 FROM means)
SELECT metric, MAX(value) AS best_value, arg_min(recommender, (-value, recommender)) AS best_recommender
FROM t GROUP BY metric
""")
def q_sweep_summary(spark, sf_dir):
    return analytics.sweep_summary(Sweep(spark, sf_dir).list_metrics(), LIST_METRICS)


@register("sweep_genre_diversity", "A19 J16 T4", f"""
WITH RECURSIVE {SWEEP_SQL},
gl AS (SELECT r.recommender, r.query_id, r.rank, list_distinct(g.genres) AS g FROM recs r JOIN genres g USING (item_id)),
d AS (SELECT a.recommender, a.query_id,
             1.0 - len(list_intersect(a.g, b.g)) / CAST(len(list_distinct(list_concat(a.g, b.g))) AS DOUBLE) AS d
      FROM gl a JOIN gl b ON a.recommender = b.recommender AND a.query_id = b.query_id AND a.rank < b.rank
      WHERE len(list_distinct(list_concat(a.g, b.g))) > 0),
per AS (SELECT recommender, query_id, ROUND(AVG(d) * 100, 6) AS genre_diversity FROM d GROUP BY recommender, query_id)
SELECT l.recommender, l.query_id, COALESCE(per.genre_diversity, 0.0) AS genre_diversity
FROM (SELECT DISTINCT recommender, query_id FROM recs) l LEFT JOIN per USING (recommender, query_id)
""")
def q_sweep_genre_diversity(spark, sf_dir):
    s = Sweep(spark, sf_dir)
    return analytics.genre_diversity(s.recs(), s.metadata)


@register("sweep_genre_counts", "A20", f"""
WITH RECURSIVE {SWEEP_SQL},
gc AS (SELECT r.recommender, r.query_id, trim(x.g) AS genre, CAST(COUNT(*) AS BIGINT) AS n
       FROM recs r JOIN (SELECT item_id, unnest(genres) AS g FROM genres) x USING (item_id)
       GROUP BY r.recommender, r.query_id, trim(x.g))
SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY recommender, query_id ORDER BY n DESC, genre) AS BIGINT)
               AS position FROM gc) WHERE position <= 10
""")
def q_sweep_genre_counts(spark, sf_dir):
    s = Sweep(spark, sf_dir)
    return analytics.genre_counts(s.recs(), s.metadata)


@register("sweep_filtered", "P14 J12 Q30", f"""
WITH RECURSIVE {SWEEP_SQL}
SELECT r.recommender, r.query_id, CAST(r.rank AS BIGINT) AS rank, r.item_id, ROUND(r.score, 6) AS score, ROUND(r.collab_score, 6) AS collab_score,
       ROUND(r.content_score, 6) AS content_score
FROM recs r LEFT JOIN meta m USING (item_id)
WHERE (m.average_rating IS NULL OR m.average_rating = 0 OR m.average_rating >= 2.5)
  AND (m.publication_year IS NULL OR m.publication_year = 0 OR m.publication_year >= 1996)
  AND (m.publication_year IS NULL OR m.publication_year = 0 OR m.publication_year <= 2000)
""")
def q_sweep_filtered(spark, sf_dir):
    s = Sweep(spark, sf_dir)
    return _shown(analytics.apply_filters(s.recs(), s.metadata, 2.5, 1996, 2000))


@register("sweep_score_breakdown", "P15 P17 P19", f"""
WITH RECURSIVE {SWEEP_SQL}
SELECT recommender, query_id, CAST(rank AS BIGINT) AS rank, item_id, ROUND(collab_score * 100, 6) AS collab_pct,
       ROUND(content_score * 100, 6) AS content_pct
FROM recs WHERE rank <= 10
""")
def q_sweep_score_breakdown(spark, sf_dir):
    return analytics.score_breakdown(Sweep(spark, sf_dir).recs())


def _shown(recs):
    return recs.withColumns({c: shown(c) for c in ("score", "collab_score", "content_score")})


def _titled(spark, sf_dir, method, n=5):
    words, cells, catalog, meta = title_words(spark, sf_dir), None, None, None
    if method == "hybrid":
        cells = cut_lineage(_cells(spark, sf_dir))
        catalog = cut_lineage(cells.select("item_id").distinct())
    elif method == "collaborative":
        cells = cut_lineage(_cells(spark, sf_dir))
    else:
        catalog = cut_lineage(catalog_of(spark, sf_dir))
    if catalog is not None:
        meta = cut_lineage(book_metadata(spark, sf_dir, catalog))
    recs = recommend.recommend_by_title(words, fixtures.title_table(spark, sf_dir), method, n, SEARCH_THRESHOLD,
                                        cells, catalog, meta)
    return _shown(recs.join(words, "query_id")).select("query", "rank", "item_id", "title", "score", "collab_score",
                                                       "content_score"), meta


_TITLED = """
SELECT w.query, CAST(r.rank AS BIGINT) AS rank, r.item_id, COALESCE(p.p_name, 'Book ID: ' || CAST(r.item_id AS VARCHAR)) AS title,
       ROUND({score}, 6) AS score, ROUND({collab}, 6) AS collab_score, ROUND({content}, 6) AS content_score{more}
FROM {lists} r JOIN wq w USING (query_id) LEFT JOIN part p ON p.p_partkey = r.item_id"""


@register("recommend_by_title", "R7 F2 J6 J12 P16 R3", f"""
WITH RECURSIVE {title_hybrid_sql([(0.6, 0.4)], 5, 15)}
{_TITLED.format(lists="recs", score="r.score", collab="r.collab_score", content="r.content_score",
                more=", m.authors, array_to_string(string_split(m.shelves, ',')[1:3], ', ') AS top_shelves")}
LEFT JOIN meta m ON m.item_id = r.item_id
""")
def q_recommend_by_title(spark, sf_dir):
    recs, metadata = _titled(spark, sf_dir, "hybrid")
    meta = metadata.select("item_id", "authors", F.array_join(F.slice(F.split("shelves", ","), 1, 3), ", ").alias("top_shelves"))
    return recs.join(meta, "item_id", "left")


@register("recommend_by_title_collaborative", "R7 P17", f"""
WITH RECURSIVE {title_hybrid_sql([(0.6, 0.4)], 5, 15)},
lists AS (SELECT b.query_id, k.neighbor_id AS item_id, k.rank, k.similarity FROM best b JOIN knn k ON k.item_id = b.item_id WHERE k.rank <= 5)
{_TITLED.format(lists="lists", score="r.similarity", collab="r.similarity", content="0.0", more="")}
""")
def q_recommend_by_title_collaborative(spark, sf_dir):
    return _titled(spark, sf_dir, "collaborative")[0]


@register("recommend_by_title_content", "R7 P17", f"""
WITH RECURSIVE {title_hybrid_sql([(0.6, 0.4)], 5, 15)},
lists AS (SELECT b.query_id, k.neighbor_id AS item_id, k.rank, k.similarity FROM best b JOIN cknn k ON k.item_id = b.item_id WHERE k.rank <= 5)
{_TITLED.format(lists="lists", score="r.similarity", collab="0.0", content="r.similarity", more="")}
""")
def q_recommend_by_title_content(spark, sf_dir):
    return _titled(spark, sf_dir, "content")[0]


@register("sweep_filter_stats", "A24 P14", f"""
WITH RECURSIVE {SWEEP_SQL},
kept AS (SELECT r.* FROM recs r LEFT JOIN meta m USING (item_id)
         WHERE (m.average_rating IS NULL OR m.average_rating = 0 OR m.average_rating >= 2.5)
           AND (m.publication_year IS NULL OR m.publication_year = 0 OR m.publication_year <= 1993))
SELECT l.recommender, l.query_id, ROUND(COUNT(k.item_id) * 100.0 / {SWEEP_N}, 6) AS pass_rate_pct,
       ROUND(COALESCE(AVG(k.score), 0.0) * 100, 4) AS mean_match_pct
FROM (SELECT DISTINCT recommender, query_id FROM recs) l LEFT JOIN kept k USING (recommender, query_id) GROUP BY ALL
""")
def q_sweep_filter_stats(spark, sf_dir):
    s = Sweep(spark, sf_dir)
    recs = cut_lineage(s.recs())
    return analytics.filter_stats(analytics.apply_filters(recs, s.metadata, 2.5, None, 1993), recs, SWEEP_N)


@register("sweep_pivot", "A25", f"""
WITH RECURSIVE {SWEEP_SQL},
t AS ({" UNION ALL ".join(f"SELECT recommender, query_id, '{m}' AS metric, {m} AS value FROM lm" for m in LIST_METRICS)})
SELECT query_id, metric, {", ".join(f"MAX(value) FILTER (WHERE recommender = '{c}') AS {chr(34)}{c}{chr(34)}" for c in sorted(SWEEP_NAMES))}
FROM t GROUP BY query_id, metric
""")
def q_sweep_pivot(spark, sf_dir):
    return analytics.sweep_pivot(Sweep(spark, sf_dir).list_metrics(), LIST_METRICS, sorted(SWEEP_NAMES))


@register("score_histogram", "A9", f"""
WITH RECURSIVE {SWEEP_SQL},
b AS (SELECT MIN(score) AS lo, MAX(score) AS hi FROM recs),
binned AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE LEAST(FLOOR((r.score - b.lo) / ((b.hi - b.lo) / {analytics.SCORE_BINS})),
                       {analytics.SCORE_BINS - 1}) END AS INTEGER) AS bin, b.lo, (b.hi - b.lo) / {analytics.SCORE_BINS} AS width FROM recs r, b)
SELECT bin, ROUND(ANY_VALUE(lo) + bin * ANY_VALUE(width), 6) AS lower, ROUND(ANY_VALUE(lo) + (bin + 1) * ANY_VALUE(width), 6) AS upper,
       CAST(COUNT(*) AS BIGINT) AS n FROM binned GROUP BY bin
""")
def q_score_histogram(spark, sf_dir):
    return analytics.histogram(cut_lineage(Sweep(spark, sf_dir).recs()), "score", analytics.SCORE_BINS)


@register("book_details", "P16", f"""
WITH inter AS ({INTERACTIONS}), {META_ONLY}
SELECT item_id, concat_ws(' | ',
    CASE WHEN publication_year <> 0 THEN CAST(publication_year AS VARCHAR) END,
    CASE WHEN average_rating <> 0 THEN printf('%.2f', average_rating) END,
    CASE WHEN ratings_count <> 0 THEN printf('%,d', ratings_count) || ' ratings' END,
    CASE WHEN num_pages <> 0 THEN CAST(num_pages AS VARCHAR) || ' pages' END) AS details
FROM meta
""")
def q_book_details(spark, sf_dir):
    return analytics.detail_line(book_metadata(spark, sf_dir))


_CONFIGS = sorted(SWEEP_NAMES)


@register("config_comparison", "R12", f"""
WITH RECURSIVE {SWEEP_SQL},
cells5 AS (SELECT r.query_id, r.rank, r.recommender,
                  COALESCE(p.p_name, 'Book ID: ' || CAST(r.item_id AS VARCHAR)) ||
                  CASE WHEN COALESCE(m.shelves, '') <> ''
                       THEN ' [' || array_to_string(string_split(m.shelves, ',')[1:3], ', ') || ']' ELSE '' END AS cell
           FROM recs r LEFT JOIN part p ON p.p_partkey = r.item_id LEFT JOIN meta m USING (item_id) WHERE r.rank <= 5)
SELECT query_id, CAST(rank AS BIGINT) AS rank,
       {", ".join(f'MAX(cell) FILTER (WHERE recommender = {chr(39)}{c}{chr(39)}) AS "{c}"' for c in _CONFIGS)}
FROM cells5 GROUP BY query_id, rank
""")
def q_config_comparison(spark, sf_dir):
    s = Sweep(spark, sf_dir)
    return analytics.comparison_table(s.recs(), s.titles, s.metadata, _CONFIGS, 5)
