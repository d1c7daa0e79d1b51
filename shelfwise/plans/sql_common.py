"""SQL fragments shared by the oracle statements (DuckDB / ANSI dialect).

They restate, over the raw tables, the fixture adapters of
``shelfwise.sources.fixtures``.
"""

INTERACTIONS = """
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(l.l_quantity AS BIGINT) % 6 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

CELLS = f"""
  inter AS ({INTERACTIONS}),
  cells AS (SELECT item_id, user_id, CAST(SUM(rating) AS DOUBLE) AS rating FROM inter GROUP BY item_id, user_id)
"""

UNIT = f"""
  {CELLS},
  nz AS (SELECT * FROM cells WHERE rating <> 0),
  norms AS (SELECT item_id, SQRT(SUM(rating * rating)) AS norm FROM nz GROUP BY item_id),
  unit AS (SELECT nz.item_id, nz.user_id, nz.rating / norms.norm AS w FROM nz JOIN norms USING (item_id))
"""


def knn_sql(query_items: str, k: int) -> str:
    """Padded cosine top-k of the collaborative space for the items of the
    CTE ``query_items(item_id)``, brute force over the whole catalog."""
    return f"""
  dots AS (SELECT a.item_id AS item_id, b.item_id AS neighbor_id, SUM(a.w * b.w) AS dot
           FROM unit a JOIN unit b ON a.user_id = b.user_id AND a.item_id <> b.item_id
           WHERE a.item_id IN (SELECT item_id FROM {query_items})
           GROUP BY 1, 2),
  kcatalog AS (SELECT DISTINCT item_id FROM cells),
  scored AS (
    SELECT q.item_id, c.item_id AS neighbor_id, COALESCE(ROUND(d.dot, 12), 0.0) AS similarity
    FROM (SELECT DISTINCT item_id FROM {query_items}) q JOIN kcatalog c ON q.item_id <> c.item_id
    LEFT JOIN dots d ON d.item_id = q.item_id AND d.neighbor_id = c.item_id),
  knn AS (
    SELECT item_id, neighbor_id, similarity,
           ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY similarity DESC, neighbor_id) AS rank
    FROM scored)
"""

# Flattened metadata of the catalog (restates fixtures.raw_books followed by
# operators.metadata.flatten_metadata, relationally).  Needs CTE ``inter``.
META = """
  catalog AS (SELECT DISTINCT item_id FROM inter),
  lines AS (
    SELECT l.l_partkey AS item_id, l.l_suppkey, CAST(l.l_quantity AS BIGINT) % 6 AS rating, o.o_orderdate,
           lower(o.o_orderpriority) AS pri, lower(c.c_mktsegment) AS seg
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
  lstats AS (SELECT item_id, COUNT(*) AS n_lines, FLOOR(AVG(rating) * 100 + 0.5) / 100 AS avg_rating,
                    YEAR(MIN(o_orderdate)) AS first_year FROM lines GROUP BY item_id),
  shelf_rows AS (SELECT item_id, name, COUNT(*) AS cnt
                 FROM (SELECT item_id, seg AS name FROM lines UNION ALL SELECT item_id, pri AS name FROM lines)
                 GROUP BY item_id, name),
  shelf_top AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY cnt DESC, name) AS pos
                               FROM shelf_rows) WHERE pos <= 10),
  shelf_agg AS (SELECT item_id,
                       string_agg(name, ',' ORDER BY pos) FILTER (WHERE name <> '') AS shelves,
                       string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY pos) AS shelf_counts,
                       COUNT(*) FILTER (WHERE name <> '') AS num_shelves
                FROM shelf_top GROUP BY item_id),
  auth AS (SELECT DISTINCT item_id, l_suppkey FROM lines),
  auth_agg AS (SELECT a.item_id, string_agg(s.s_name, ', ' ORDER BY a.l_suppkey) AS authors,
                      string_agg(CAST(a.l_suppkey AS VARCHAR), ',' ORDER BY a.l_suppkey) AS author_ids,
                      COUNT(*) AS num_authors
               FROM auth a JOIN supplier s ON a.l_suppkey = s.s_suppkey GROUP BY a.item_id),
  meta AS (
    SELECT p.p_partkey AS item_id, SUBSTR(p.p_name, 1, 500) AS title,
           COALESCE(SUBSTR(au.authors, 1, 500), '') AS authors, COALESCE(au.author_ids, '') AS author_ids,
           CAST(COALESCE(au.num_authors, 0) AS BIGINT) AS num_authors,
           COALESCE(sh.shelves, '') AS shelves, COALESCE(sh.shelf_counts, '') AS shelf_counts,
           CAST(COALESCE(sh.num_shelves, 0) AS BIGINT) AS num_shelves,
           CAST(COALESCE(st.avg_rating, 0) AS DOUBLE) AS average_rating,
           CAST(COALESCE(st.n_lines, 0) AS BIGINT) AS ratings_count,
           CAST(COALESCE(st.first_year, 0) AS BIGINT) AS publication_year,
           CAST(COALESCE(p.p_size, 0) AS BIGINT) AS num_pages,
           SUBSTR(lower(p.p_type) || '-' || lower(p.p_brand), 1, 10) AS language_code
    FROM part p LEFT JOIN lstats st ON st.item_id = p.p_partkey LEFT JOIN shelf_agg sh ON sh.item_id = p.p_partkey
         LEFT JOIN auth_agg au ON au.item_id = p.p_partkey
    WHERE p.p_partkey IN (SELECT item_id FROM catalog))
"""

# Long-form content features over META (restates operators.features).
FEATURES = f"""
  {META},
  docs AS (SELECT c.item_id, m.shelves, m.author_ids, m.title, m.ratings_count, m.average_rating,
                  m.publication_year, m.num_pages
           FROM catalog c LEFT JOIN meta m USING (item_id)),
  tokens AS (SELECT item_id, unnest(regexp_extract_all(lower(replace(COALESCE(shelves, ''), ',', ' ')),
                                                      '[a-z][a-z0-9\\-]+')) AS term FROM docs),
  tf AS (SELECT item_id, term, CAST(COUNT(*) AS DOUBLE) AS tf FROM tokens GROUP BY item_id, term),
  tstats AS (SELECT term, COUNT(*) AS df, SUM(tf) AS total FROM tf GROUP BY term),
  vocab AS (SELECT term, df, total, LN((1.0 + (SELECT COUNT(*) FROM docs)) / (df + 1.0)) + 1.0 AS idf
            FROM tstats WHERE df >= 3 ORDER BY total DESC, term LIMIT 500),
  shelf_w AS (SELECT tf.item_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)),
  shelf_f AS (SELECT item_id, 'shelf' AS block, term AS feature,
                     w / SQRT(SUM(w * w) OVER (PARTITION BY item_id)) AS value FROM shelf_w),
  apairs AS (SELECT DISTINCT item_id, feature
             FROM (SELECT item_id, unnest(string_split(COALESCE(author_ids, ''), ',')) AS feature FROM docs)
             WHERE feature <> ''),
  akeep AS (SELECT feature FROM apairs GROUP BY feature HAVING COUNT(*) >= 2),
  author_f AS (SELECT item_id, 'author' AS block, feature,
                      1.0 / SQRT(COUNT(*) OVER (PARTITION BY item_id)) AS value
               FROM apairs WHERE feature IN (SELECT feature FROM akeep)),
  nraw AS (SELECT item_id, LN(1 + CAST(ratings_count AS DOUBLE)) AS f1, average_rating / 5.0 AS f2,
                  CASE WHEN publication_year > 0 THEN (publication_year - 1900) / CAST(100.0 AS DOUBLE)
                       ELSE 0.0 END AS f3,
                  LN(1 + CAST(num_pages AS DOUBLE)) / 10.0 AS f4
           FROM docs WHERE title IS NOT NULL),
  nlong AS (SELECT *, SQRT(f1 * f1 + f2 * f2 + f3 * f3 + f4 * f4) AS norm FROM nraw),
  numeric_f AS (
    SELECT item_id, 'numeric' AS block, feature, v / norm AS value FROM (
      SELECT item_id, norm, 'log_ratings_count' AS feature, f1 AS v FROM nlong UNION ALL
      SELECT item_id, norm, 'rating_over_5', f2 FROM nlong UNION ALL
      SELECT item_id, norm, 'year_offset', f3 FROM nlong UNION ALL
      SELECT item_id, norm, 'log_pages', f4 FROM nlong)
    WHERE v <> 0 AND norm > 0),
  features AS (SELECT * FROM shelf_f UNION ALL SELECT * FROM author_f UNION ALL SELECT * FROM numeric_f)
"""


def content_knn_sql(query_items: str) -> str:
    """Padded content cosine (Q21) of the items of CTE ``query_items(item_id)``
    against the whole catalog, brute force.  Needs FEATURES."""
    return f"""
  nb AS (SELECT item_id, COUNT(DISTINCT block) AS nb FROM features GROUP BY item_id),
  cdots AS (SELECT a.item_id AS item_id, b.item_id AS neighbor_id, SUM(a.value * b.value) AS dot
            FROM features a JOIN features b ON a.block = b.block AND a.feature = b.feature
            WHERE a.item_id IN (SELECT item_id FROM {query_items})
            GROUP BY 1, 2),
  cscored AS (
    SELECT q.item_id, c.item_id AS neighbor_id,
           COALESCE(ROUND(d.dot / SQRT(CAST(na.nb AS DOUBLE) * nc.nb), 12), 0.0) AS similarity
    FROM (SELECT DISTINCT item_id FROM {query_items}) q JOIN catalog c ON q.item_id <> c.item_id
    LEFT JOIN cdots d ON d.item_id = q.item_id AND d.neighbor_id = c.item_id
    LEFT JOIN nb na ON na.item_id = q.item_id LEFT JOIN nb nc ON nc.item_id = c.item_id),
  cknn AS (
    SELECT item_id, neighbor_id, similarity,
           ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY similarity DESC, neighbor_id) AS rank
    FROM cscored)
"""


def duck_lcs(a: str, b: str) -> str:
    """DuckDB: LCS length by the classic row-by-row dynamic programme (an
    independent formulation of what the Spark side computes bit-parallel)."""
    return (f"list_reduce(string_split({a}, ''), lambda prev, ch: list_reduce(range(1, len({b}) + 1), "
            f"lambda acc, j: list_append(acc, CASE WHEN substr({b}, j::BIGINT, 1) = ch THEN prev[j] + 1 "
            f"ELSE greatest(prev[j + 1], acc[j]) END), [0]), "
            f"list_transform(range(0, len({b}) + 1), lambda x: 0))[len({b}) + 1]")


def duck_ratio(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE CAST(round_even(CAST(100 AS DOUBLE) * "
            f"(CAST(2 * {duck_lcs(a, b)} AS DOUBLE) / CAST(len({a}) + len({b}) AS DOUBLE)), 0) AS INTEGER) END")


def duck_window_bound(a: str, b: str) -> str:
    """The best rounded ratio over all windows of the longer string, those that it ends included."""
    s = f"(CASE WHEN len({a}) < len({b}) THEN {a} ELSE {b} END)"
    l_ = f"(CASE WHEN len({a}) < len({b}) THEN {b} ELSE {a} END)"
    window = f"substr({l_}, pos::BIGINT, len({s}))"
    best = (f"list_max(list_transform(range(1, len({l_}) + 1), lambda pos: "
            f"CAST(2 * {duck_lcs(s, window)} AS DOUBLE) / CAST(len({s}) + len({window}) AS DOUBLE)))")
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE CAST(round_even(CAST(100 AS DOUBLE) * {best}, 0) AS INTEGER) END"


def partial_ctes(pairs: str, out: str, least: int, a: str = "a", b: str = "b") -> str:
    """CTEs (after WITH RECURSIVE) that give ``out``: the rows of ``pairs`` with ``score``,
    the ratio of the best block-aligned window of the longer string.

    Blocks are found relationally: equal characters make diagonal runs; of the runs,
    clipped to a box, the longest (earliest in the shorter, then in the longer string)
    is the block, and leaves a box before and one after it.  Pairs whose best window
    of all is below ``least`` are left out."""
    return f"""
{out}_c AS (SELECT *, row_number() OVER () AS pid, CASE WHEN len({a}) < len({b}) THEN {a} ELSE {b} END AS s,
                   CASE WHEN len({a}) < len({b}) THEN {b} ELSE {a} END AS l
            FROM (SELECT *, {duck_window_bound(a, b)} AS bound FROM {pairs}) WHERE bound >= {least} AND len({a}) > 0 AND len({b}) > 0),
{out}_i AS (SELECT pid, l, substr(s, (i + 1)::BIGINT, 1) AS ch, i FROM (SELECT pid, s, l, unnest(range(0, len(s))) AS i FROM {out}_c)),
{out}_x AS (SELECT pid, i, j FROM (SELECT pid, l, ch, i, unnest(range(0, len(l))) AS j FROM {out}_i) WHERE substr(l, (j + 1)::BIGINT, 1) = ch),
{out}_r AS (SELECT pid, j - i AS d, MIN(i) AS i0, COUNT(*) AS n
            FROM (SELECT *, i - row_number() OVER (PARTITION BY pid, j - i ORDER BY i) AS g FROM {out}_x) GROUP BY pid, j - i, g),
{out}_b AS (
  SELECT c.pid, 0::BIGINT AS alo, len(c.s)::BIGINT AS ahi, 0::BIGINT AS blo, len(c.l)::BIGINT AS bhi,
         arg_max({{'n': r.n, 'i': r.i0, 'j': r.i0 + r.d}}, r.n * 100000000 - r.i0 * 10000 - (r.i0 + r.d)) AS k
  FROM {out}_c c JOIN {out}_r r ON r.pid = c.pid GROUP BY c.pid, c.s, c.l
  UNION ALL
  SELECT x.pid, x.alo, x.ahi, x.blo, x.bhi, arg_max({{'n': x.n, 'i': x.ci, 'j': x.ci + x.d}}, x.n * 100000000 - x.ci * 10000 - (x.ci + x.d)) AS k
  FROM (SELECT q.*, r.d, greatest(r.i0, q.alo, q.blo - r.d) AS ci,
               least(r.i0 + r.n, q.ahi, q.bhi - r.d) - greatest(r.i0, q.alo, q.blo - r.d) AS n
        FROM (SELECT o.pid, CASE WHEN side = 0 THEN o.alo ELSE o.k.i + o.k.n END AS alo, CASE WHEN side = 0 THEN o.k.i ELSE o.ahi END AS ahi,
                     CASE WHEN side = 0 THEN o.blo ELSE o.k.j + o.k.n END AS blo, CASE WHEN side = 0 THEN o.k.j ELSE o.bhi END AS bhi
              FROM {out}_b o, (VALUES (0), (1)) v(side)) q JOIN {out}_r r ON r.pid = q.pid
        WHERE q.alo < q.ahi AND q.blo < q.bhi) x
  WHERE x.n > 0 GROUP BY x.pid, x.alo, x.ahi, x.blo, x.bhi),
{out}_w AS (SELECT pid, greatest(0, k.j - k.i) AS at FROM {out}_b UNION SELECT pid, len(l) - len(s) AS at FROM {out}_c),
{out}_s AS (SELECT c.pid, MAX(CAST(2 * {duck_lcs('c.s', 'substr(c.l, (w.at + 1)::BIGINT, len(c.s))')} AS DOUBLE)
                              / CAST(len(c.s) + len(substr(c.l, (w.at + 1)::BIGINT, len(c.s))) AS DOUBLE)) AS best
            FROM {out}_c c JOIN {out}_w w USING (pid) GROUP BY c.pid),
{out} AS (SELECT c.* EXCLUDE (pid, s, l, bound), CAST(round_even(CAST(100 AS DOUBLE) * z.best, 0) AS INTEGER) AS score
          FROM {out}_c c JOIN {out}_s z USING (pid))"""


def duck_words(a: str) -> str:
    return f"list_filter(string_split({a}, ' '), lambda x: x <> '')"


def duck_joined(words: str) -> str:
    return f"array_to_string(list_sort({words}), ' ')"


def weighted_ctes(pairs: str, out: str, least: int) -> str:
    """CTEs (after WITH RECURSIVE) that give ``out``: the rows of ``pairs`` (processed
    texts ``a`` and ``b``) whose default score is at least ``least``.  Window forms that
    cannot reach it are left out."""
    need = lambda scale: int((least - 0.5) / scale)
    d = lambda x: f"CAST({x} AS DOUBLE)"
    full_set = (f"greatest({duck_ratio('oa', 'ob')}, CASE WHEN shared = '' THEN 0 ELSE greatest({duck_ratio('shared', 'oa')}, "
                f"{duck_ratio('shared', 'ob')}) END)")
    return f"""
{out}_w AS (SELECT *, row_number() OVER () AS wid, {duck_words('a')} AS wa, {duck_words('b')} AS wb,
                   {d('greatest(len(a), len(b))')} / {d('least(len(a), len(b))')} AS apart FROM {pairs} WHERE len(a) > 0 AND len(b) > 0),
{out}_t AS (SELECT *, {duck_joined('wa')} AS ta, {duck_joined('wb')} AS tb, {duck_joined('list_distinct(wa)')} AS sa,
                   {duck_joined('list_distinct(wb)')} AS sb, {duck_joined('list_intersect(wa, wb)')} AS shared,
                   {duck_joined('list_filter(list_distinct(wa), lambda x: NOT list_contains(wb, x))')} AS da,
                   {duck_joined('list_filter(list_distinct(wb), lambda x: NOT list_contains(wa, x))')} AS db,
                   CASE WHEN apart > 8 THEN {d('0.6')} ELSE {d('0.9')} END AS scale FROM {out}_w),
{out}_o AS (SELECT *, trim(shared || ' ' || da) AS oa, trim(shared || ' ' || db) AS ob FROM {out}_t),
{out}_n AS (SELECT wid, greatest({duck_ratio('ta', 'tb')}, {full_set}) * {d('0.95')} AS extra FROM {out}_o WHERE apart < 1.5),
{out}_f1 AS (SELECT wid, scale, b AS a, a AS b FROM {out}_o WHERE apart >= 1.5),
{partial_ctes(f'{out}_f1', f'{out}_p1', need(0.9))},
{out}_f2 AS (SELECT wid, scale, tb AS a, ta AS b FROM {out}_o WHERE apart >= 1.5),
{partial_ctes(f'{out}_f2', f'{out}_p2', need(0.9 * 0.95))},
{out}_f3 AS (SELECT wid, scale, sb AS a, sa AS b FROM {out}_o WHERE apart >= 1.5 AND shared = '' AND (sa <> ta OR sb <> tb)),
{partial_ctes(f'{out}_f3', f'{out}_p3', need(0.9 * 0.95))},
{out}_e AS (SELECT wid, MAX(extra) AS extra FROM (
   SELECT wid, extra FROM {out}_n UNION ALL SELECT wid, score * scale FROM {out}_p1
   UNION ALL SELECT wid, score * {d('0.95')} * scale FROM {out}_p2 UNION ALL SELECT wid, score * {d('0.95')} * scale FROM {out}_p3
   UNION ALL SELECT wid, 100 * {d('0.95')} * scale FROM {out}_o WHERE apart >= 1.5 AND shared <> '') GROUP BY wid),
{out} AS (SELECT * FROM (SELECT o.* EXCLUDE (wid, wa, wb, apart, ta, tb, sa, sb, shared, da, db, scale, oa, ob),
                 CAST(round_even(greatest({d(duck_ratio('a', 'b'))}, COALESCE(e.extra, 0)), 0) AS INTEGER) AS score
          FROM {out}_o o LEFT JOIN {out}_e e USING (wid)) WHERE score >= {least})"""
