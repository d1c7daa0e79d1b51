"""The q-gram index: its bound, and the rows it gives."""

import random

import pytest

from shelfwise.functions import text
from shelfwise.operators import search
from shelfwise.operators import title_index as ti


def _grams(s, q):
    return [s[i:i + q] for i in range(len(s) - q + 1)]


def _shared(a, b, q):
    from collections import Counter
    return sum((Counter(_grams(a, q)) & Counter(_grams(b, q))).values())


def _titles(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeilnorst") for _ in range(r.randint(2, 9))) for _ in range(60)]
    return [" ".join(r.choice(words) for _ in range(r.randint(1, 8))) for _ in range(n)]


def _spoiled(seed, titles, n):
    """Stretches of titles with some characters changed, added and left out."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        t = list(r.choice(titles))
        at = r.randrange(len(t))
        t = t[at:at + r.randint(3, 40)]
        for _ in range(len(t) // 8):
            i = r.randrange(len(t))
            t[i:i + 1] = r.choice([[], ["x"], [t[i], "y"]])
        out.append("".join(t) or "a")
    return out


@pytest.mark.parametrize("threshold", [50, 70, 80, 92, 100])
def test_no_match_shares_fewer_grams(threshold):
    titles = _titles(1, 150)
    table = text.Texts(titles)
    for query in [*_spoiled(2, titles, 40), *titles[:10]]:
        rows, _ = text.matches("partial_ratio", query, table, threshold)
        for row in rows:
            n = min(len(query), len(titles[row]))
            for q in ti.SIZES:
                assert _shared(query, titles[row], q) >= ti.shared_grams(n, threshold, q)


def test_lengths_with_a_bound():
    assert ti.shared_grams(20, 100, 2) == 19 and ti.shared_grams(20, 0, 2) < 0
    for threshold in (70, 85, 100):
        n = ti.shortest_indexed(threshold)
        assert n <= ti.LONGEST and ti.shared_grams(n - 1, threshold, 2) < ti.ENOUGH <= min(ti.shared_grams(m, threshold, 2) for m in range(n, n + 80))


@pytest.mark.parametrize("threshold", [78, 85])
def test_same_rows_as_blocks(spark, threshold):
    titles = _titles(3, 400)
    queries = [*_spoiled(4, titles, 30), "ab", "", *titles[:3], "a long query that holds " + titles[5]]
    t = spark.createDataFrame([(s, i % 390) for i, s in enumerate(titles)], "title string, item_id bigint")
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, query string")
    got = search.search_titles(t, asked, threshold).collect()
    idx = search.distinct_titles(t).selectExpr("title", "item_id", "lower(title) AS t")
    want = search._blockwise(asked.selectExpr("query_id", "lower(query) AS q"), idx, "partial_ratio", threshold).collect()
    rows = lambda found: sorted((r.query_id, r.title, r.item_id, r.score) for r in found)
    assert rows(got) == rows(want) and len(got) > 30


def test_few_pairs_are_scored(spark):
    r = random.Random(5)
    words = ["".join(r.choice("etaoinshrdlucmfwypvbgk") for _ in range(r.randint(3, 9))) for _ in range(400)]
    titles = sorted({" ".join(r.choice(words) for _ in range(r.randint(3, 8))) for _ in range(1000)})
    asked = [q for q in _spoiled(6, titles, 60) if len(q) >= 12]
    t = spark.createDataFrame(list(enumerate(titles)), "t_id long, s string")
    q = spark.createDataFrame(list(enumerate(asked)), "q_id long, s string")
    pairs = ti.candidates(q, t, 85, ti.shortest_indexed(85))
    assert pairs.count() == pairs.distinct().count() < len(asked) * len(titles) / 20


def test_no_titles_and_null_queries(spark):
    t = spark.createDataFrame([], "title string, item_id bigint")
    asked = spark.createDataFrame([(1, "a query that is long enough for the index"), (2, None)], "query_id bigint, query string")
    assert search.search_titles(t, asked, 80).count() == 0
    t = spark.createDataFrame([(None, 1), ("A query that is long enough", 2)], "title string, item_id bigint")
    assert [(r.query_id, r.item_id) for r in search.search_titles(t, asked, 80).collect()] == [(1, 2)]
