"""Fuzzy title search: scorers against dynamic programming, and search semantics."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators import search

TITLES = [("A Field Guide to Lichens", 11), ("The Lichen Collector", 12), ("Bread, Salt and Iron", 13),
          ("Salt", 14), ("Tide Tables of the Northern Coast", 15)]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame(TITLES, "title string, item_id bigint")


def find(spark, titles, *queries, **options):
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, query string")
    rows = sorted(search.search_titles(titles, asked, **options).collect(), key=lambda r: (r.query_id, r.rank))
    return [(r.query_id, r.rank, r.item_id, r.score) for r in rows]


def dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + 1 if x == y else 0)
    return row[-1]


def dp_ratio(a, b):
    return round(100 * (2 * dp_lcs(a, b) / (len(a) + len(b)))) if a and b else 0


def blocks(a, b, i=0, j=0):
    """Matching blocks by trying every stretch: the longest, earliest in a, then in b; then left and right of it."""
    for size in range(min(len(a), len(b)), 0, -1):
        for x in range(len(a) - size + 1):
            y = b.find(a[x:x + size])
            if y >= 0:
                return [*blocks(a[:x], b[:y], i, j), (i + x, j + y), *blocks(a[x + size:], b[y + size:], i + x + size, j + y + size)]
    return []


def dp_partial(a, b):
    """``a`` is the shorter one of equal lengths."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not a:
        return 0
    starts = {max(0, j - i) for i, j in blocks(a, b)} | {len(b) - len(a)}
    return round(100 * max(2 * dp_lcs(a, b[at:at + len(a)]) / (len(a) + len(b[at:at + len(a)])) for at in starts))


def dp_token_set(a, b, score):
    a, b = set(a.split()), set(b.split())
    strings = [" ".join(sorted(a & b)), *(" ".join(" ".join(sorted(part)) for part in (a & b, one - other) if part) for one, other in ((a, b), (b, a)))]
    return max(score(x, y) for x, y in ((strings[0], strings[1]), (strings[0], strings[2]), (strings[1], strings[2])))


def dp_weighted(a, b):
    if not a or not b:
        return 0
    sort = lambda t: " ".join(sorted(t.split()))
    apart, base = max(len(a), len(b)) / min(len(a), len(b)), dp_ratio(a, b)
    if apart < 1.5:
        return round(max(base, dp_ratio(sort(a), sort(b)) * 0.95, dp_token_set(a, b, dp_ratio) * 0.95))
    scale = 0.6 if apart > 8 else 0.9
    return round(max(base, dp_partial(a, b) * scale, dp_partial(sort(a), sort(b)) * 0.95 * scale, dp_token_set(a, b, dp_partial) * 0.95 * scale))


def _strings(seed, n, longest):
    r = random.Random(seed)
    return ["".join(r.choice("abcd é") for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_scorers_against_dynamic_programming():
    queries, titles = _strings(1, 12, 150), _strings(2, 30, 150)
    table = text.Texts(titles)
    for q in queries:
        assert text.lcs(q, table).tolist() == [dp_lcs(q, t) for t in titles]
        assert text.ratio_scores(q, table).tolist() == [dp_ratio(q, t) for t in titles]
        assert text.partial_scores(q, table).tolist() == [dp_partial(t, q) for t in titles]
        assert text.partial_scores(q, table, query_first=True).tolist() == [dp_partial(q, t) for t in titles]


def _sentences(seed, n):
    r = random.Random(seed)
    words = ["harry", "potter", "the", "stone", "book", "of", "a", "sorcerer", "hary", "ston", "x"]
    return [" ".join(r.choice(words) for _ in range(r.randint(1, 9))) for _ in range(n)]


def test_weighted_score_against_its_definition():
    queries, titles = _sentences(5, 25) + _strings(6, 5, 30), _sentences(7, 60) + _strings(8, 20, 60)
    table = text.Texts(titles)
    for q in queries:
        assert text.weighted_scores(q, table).tolist() == [dp_weighted(q, t) for t in titles], q
    q, t = "stone the potter harry", "harry potter the stone book extra words here"
    assert text.weighted_scores(q, text.Texts([t])).tolist() == [86] == [dp_weighted(q, t)]


def test_windows_stand_at_blocks_and_at_the_end():
    # the best of all windows is "xbc" with two letters in common; the blocks lead to others
    assert text.block_starts("abc", "ab--xbc") == [0, 4] and text.block_starts("abcd", "zzcdab") == [2, 4]
    assert text.partial_scores("abcd", text.Texts(["zzcdab"])).tolist() == [dp_partial("zzcdab", "abcd")]


@pytest.mark.parametrize("name", sorted(text.SCORERS))
@pytest.mark.parametrize("threshold", [0, 45, 70, 100])
def test_bound_drops_no_match(name, threshold):
    titles = text.Texts(_strings(3, 60, 40) + ["abc", "abc d", "cba"] + _sentences(9, 40))
    for q in [*_strings(4, 8, 25), "abc", "", *_sentences(10, 8)]:
        scores = text.scorer(name)(q, titles)
        rows, found = text.matches(name, q, titles, threshold)
        want = [i for i, s in enumerate(scores) if s >= threshold]
        assert rows.tolist() == want and found.tolist() == scores[want].tolist()


def test_weighted_score():
    one = lambda a, b: int(text.weighted_scores(a, text.Texts([b]))[0])
    assert one("salt", "salt") == 100
    assert one("iron and salt", "salt and iron") == 95           # same words in another order
    assert one("salt", "bread salt and iron") == 90              # a window, lengths apart
    assert one("a", "a field guide to lichens") == 60            # lengths far apart
    assert one("", "salt") == one("salt", "") == 0


def test_pairwise_columns(spark):
    df = spark.createDataFrame([("salt", "bread, salt"), ("abc", "abd"), ("", "x"), (None, "x")], "a string, b string")
    got = df.select(text.ratio("a", "b"), text.partial_ratio("a", "b")).collect()
    assert [tuple(r) for r in got] == [(53, 100), (67, 67), (0, 0), (None, None)]


def test_ranks_and_ties(spark, titles):
    assert find(spark, titles, "salt", threshold=100) == [(0, 1, 13, 100), (0, 2, 14, 100)]
    assert find(spark, titles, "salt", threshold=100, max_results=1) == [(0, 1, 13, 100)]
    assert find(spark, titles, "LICHEN", "coast", threshold=95) == [(0, 1, 11, 100), (0, 2, 12, 100), (1, 1, 15, 100)]


def test_unlimited_ranks_equal_limited_ones(spark, titles):
    queries = ["lichen", "salt", "the", "north", "zzz"]
    assert find(spark, titles, *queries, threshold=30) == find(spark, titles, *queries, threshold=30, max_results=99)


def test_nothing_found(spark, titles):
    assert find(spark, titles, "qqq", threshold=50) == []
    assert find(spark, titles, "salt", threshold=101) == []
    assert find(spark, titles, None, "", threshold=50) == []
    assert find(spark, titles.limit(0), "salt") == []


def test_unknown_scorer(spark, titles):
    with pytest.raises(ValueError, match="Unknown scorer"):
        find(spark, titles, "salt", scorer="soundex")


def test_best_and_smart(spark, titles):
    asked = spark.createDataFrame([(5, "northern COAST"), (6, "qqqq"), (7, "iron bread salt and")], "query_id bigint, query string")
    assert {r.query_id: r.item_id for r in search.best_match(titles, asked, 80).collect()} == {5: 15, 7: 14}  # "Salt" is part of the query
    assert {(r.query_id, r.item_id) for r in search.smart_search(titles, asked).collect()} >= {(5, 15), (7, 13)}


def test_one_id_per_title_in_a_search(spark):
    twice = spark.createDataFrame([("Tides", 3), ("Tides", 8)], "title string, item_id bigint")
    assert find(spark, twice, "tides") == [(0, 1, 8, 100)]


def test_titles_by_id(spark):
    """Ids that share a title keep it; unknown ids and null titles fall back."""
    titles = spark.createDataFrame([("Tides", 3), ("Tides", 8), (None, 9)], "title string, item_id bigint")
    items = spark.createDataFrame([(3,), (8,), (9,), (10,)], "item_id bigint")
    got = {r.item_id: r.title for r in search.titles_with_fallback(items, titles).collect()}
    assert got == {3: "Tides", 8: "Tides", 9: "Book ID: 9", 10: "Book ID: 10"}
    bridge = spark.createDataFrame([(3, 8), (10, 3), (11, 77)], "book_id_csv bigint, book_id bigint")
    got = {r.item_id: r.title for r in search.titles_with_fallback(items, titles, bridge).collect()}
    assert got == {3: "Tides", 8: "Book ID: 8", 9: "Book ID: 9", 10: "Tides"}
    audit = search.id_audit(items, bridge, titles).first()
    assert (audit.n_items, audit.n_unmapped, audit.n_without_title) == (4, 2, 0)


def test_many_blocks(spark, monkeypatch):
    """Small blocks give what one block gives."""
    from shelfwise.operators import blocks

    titles = spark.createDataFrame([(f"title {i} {i * i % 17}", i) for i in range(90)], "title string, item_id bigint")
    queries = [f"title {i}" for i in range(7)]
    one = find(spark, titles, *queries, threshold=80)
    monkeypatch.setattr(blocks.query_blocks, "__defaults__", (2, 10))
    assert find(spark, titles, *queries, threshold=80) == one and len(one) > 20


def test_all_matches_are_found_once_and_in_many_tasks(spark, monkeypatch):
    """The ranking of all matches does not search again, and block pairs are not merged
    into few tasks by their bytes."""
    from shelfwise import session

    titles = spark.createDataFrame([(i, f"title {i % 37} of book {i}") for i in range(3000)], "item_id bigint, title string")
    queries = spark.createDataFrame([(1, "book"), (2, "title 3")], "query_id bigint, query string")
    seen = []
    monkeypatch.setattr(session, "BEFORE_CUT", [lambda df: seen.append(df.rdd.getNumPartitions() if "CoGroup" in df._jdf.queryExecution().executedPlan().toString() else 0)])
    found = search.search_titles(titles, queries, 70)
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()
    assert max(seen) >= 8
    ranks = found.where("query_id = 2").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, len(ranks) + 1))
    assert [(-r.score, r.item_id) for r in ranks] == sorted((-r.score, r.item_id) for r in ranks)
