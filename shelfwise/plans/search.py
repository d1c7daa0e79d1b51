"""Registered queries: title search and id/title lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import search
from shelfwise.plans.registry import register
from shelfwise.plans.sql_common import INTERACTIONS, duck_ratio, partial_ctes
from shelfwise.session import cut_lineage
from shelfwise.sources import fixtures

THRESHOLD = 60
MAX_RESULTS = 5


def title_words(spark, sf_dir):
    """The query batch: every distinct word of the catalog titles, numbered
    (few words: a report-sized table, numbered in one window)."""
    words = (fixtures.table(spark, sf_dir, "part")
             .select(F.explode(F.split("p_name", " ")).alias("query")).where(F.col("query") != "").distinct())
    return cut_lineage(words.select("query", (F.row_number().over(Window.orderBy("query")) - 1).cast("bigint").alias("query_id")))


def _with_text(words, res):
    return res.join(words, "query_id").select("query", "rank", "title", "item_id", "score")


_TITLES = "titles AS (SELECT p_name AS title, MAX(p_partkey) AS item_id FROM part GROUP BY p_name)"
_WORDS = ("words AS (SELECT DISTINCT query FROM (SELECT unnest(string_split(p_name, ' ')) AS query FROM part) "
          "WHERE query <> '')")


def _search_sql(scored: str, max_results: int, columns: str = "query, CAST(rank AS BIGINT) AS rank, title, item_id, score") -> str:
    """``scored``: CTEs that give ``sscored``, the matches, from ``spairs``."""
    return f"""
WITH RECURSIVE {_TITLES}, {_WORDS},
spairs AS (SELECT w.query, lower(w.query) AS a, t.title, t.item_id, lower(t.title) AS b FROM words w, titles t),
{scored},
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, item_id) AS rank FROM sscored)
SELECT {columns} FROM ranked WHERE rank <= {max_results}
"""


def _partial_sql(threshold: int) -> str:
    return partial_ctes("spairs", "pscored", threshold) + f", sscored AS (SELECT * FROM pscored WHERE score >= {threshold})"


@register("title_search", "F1 F1b J17 L5 Q28 Q29", _search_sql(_partial_sql(THRESHOLD), MAX_RESULTS))
def q_title_search(spark, sf_dir):
    titles = fixtures.title_table(spark, sf_dir)
    words = title_words(spark, sf_dir)
    return _with_text(words, search.search_titles(titles, words, THRESHOLD, MAX_RESULTS, "partial_ratio"))


@register("title_search_ratio", "F1a", _search_sql(
    f"sscored AS (SELECT * FROM (SELECT *, {duck_ratio('a', 'b')} AS score FROM spairs) WHERE score >= 40)", MAX_RESULTS))
def q_title_search_ratio(spark, sf_dir):
    titles = fixtures.title_table(spark, sf_dir)
    words = title_words(spark, sf_dir)
    return _with_text(words, search.search_titles(titles, words, 40, MAX_RESULTS, "ratio"))


@register("best_title_match", "F2 F3", _search_sql(_partial_sql(80), 1, "query, title, item_id, score"))
def q_best_title_match(spark, sf_dir):
    titles = fixtures.title_table(spark, sf_dir)
    words = title_words(spark, sf_dir)
    return search.best_match(titles, words, 80).join(words, "query_id").select("query", "title", "item_id", "score")


_PAGE_TITLES = """page_titles AS (SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages),
titles AS (SELECT title, MAX(page_id) AS item_id FROM page_titles WHERE title <> '' GROUP BY title),
words AS (SELECT DISTINCT query FROM (SELECT array_to_string(string_split(title, ' ')[2:4], ' ') AS query FROM page_titles
          WHERE page_id % 100 = 0) WHERE query <> '')"""


@register("page_title_search", "F1 F1b J17 L5 Q28 Q29", f"""
WITH RECURSIVE {_PAGE_TITLES},
spairs AS (SELECT w.query, lower(w.query) AS a, t.title, t.item_id, lower(t.title) AS b FROM words w, titles t),
{_partial_sql(70)}
SELECT query, CAST(ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, item_id) AS BIGINT) AS rank, title, item_id, score
FROM sscored
""")
def q_page_title_search(spark, sf_dir):
    """Real titles, whose number grows with the data: all matches of three words of
    every hundredth page's title among the titles of all pages."""
    pages = fixtures.table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    titles = pages.where("title <> ''").select(F.col("page_id").alias("item_id"), "title")
    asked = pages.where("page_id % 100 = 0").select(F.array_join(F.slice(F.split("title", " "), 2, 3), " ").alias("query"))
    queries = asked.where("query <> ''").distinct().select(F.xxhash64("query").alias("query_id"), "query")
    return _with_text(queries, search.search_titles(titles, queries, 70))


@register("title_pick_list", "L6 T2", """
SELECT DISTINCT p_name AS title FROM part
""")
def q_title_pick_list(spark, sf_dir):
    return search.sorted_titles(fixtures.title_table(spark, sf_dir))


@register("item_titles", "J6", f"""
WITH inter AS ({INTERACTIONS}), items AS (SELECT DISTINCT item_id FROM inter)
SELECT items.item_id, COALESCE(p_name, 'Book ID: ' || CAST(items.item_id AS VARCHAR)) AS title
FROM items LEFT JOIN part ON p_partkey = items.item_id
""")
def q_item_titles(spark, sf_dir):
    items = fixtures.interactions(spark, sf_dir).select("item_id").distinct()
    return search.titles_with_fallback(items, fixtures.title_table(spark, sf_dir))


@register("bridged_item_titles", "J5 J6", f"""
WITH inter AS ({INTERACTIONS}), items AS (SELECT DISTINCT item_id FROM inter),
t AS (SELECT p_partkey AS item_id, p_name AS title FROM part
      WHERE p_partkey % {fixtures.NO_BRIDGE} <> 0 AND p_partkey % {fixtures.NO_TITLE} <> 0)
SELECT items.item_id, COALESCE(title, 'Book ID: ' || CAST(items.item_id AS VARCHAR)) AS title FROM items LEFT JOIN t USING (item_id)
""")
def q_bridged_item_titles(spark, sf_dir):
    """Two id spaces: titles by record id, items by interaction id, a map with gaps."""
    items = fixtures.interactions(spark, sf_dir).select("item_id").distinct()
    return search.titles_with_fallback(items, fixtures.record_titles(spark, sf_dir), fixtures.bridge(spark, sf_dir))


@register("id_audit", "J5 J7", f"""
WITH inter AS ({INTERACTIONS}), items AS (SELECT DISTINCT item_id FROM inter)
SELECT CAST(COUNT(*) AS BIGINT) AS n_items,
       CAST(COUNT(*) FILTER (WHERE item_id % {fixtures.NO_BRIDGE} = 0) AS BIGINT) AS n_unmapped,
       CAST(COUNT(*) FILTER (WHERE item_id % {fixtures.NO_BRIDGE} <> 0 AND item_id % {fixtures.NO_TITLE} = 0) AS BIGINT) AS n_without_title
FROM items
""")
def q_id_audit(spark, sf_dir):
    return search.id_audit(fixtures.interactions(spark, sf_dir), fixtures.bridge(spark, sf_dir),
                           fixtures.record_titles(spark, sf_dir))
