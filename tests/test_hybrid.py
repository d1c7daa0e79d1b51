"""Hybrid lists from hand-computed candidates."""

import pytest

from shelfwise.operators.hybrid import hybrid, parse_weights, single_method, weight_name

SCHEMA = "user_id bigint, item_id bigint, similarity double"
# two queries; item 7 is on both sides of the first
COLLAB = [(1, 7, 0.5), (1, 8, 0.25), (2, 9, 1.0)]
CONTENT = [(1, 7, 0.125), (1, 3, 0.75), (1, 4, 0.75)]


def lists(spark, weights, k, collab=COLLAB, content=CONTENT):
    out = hybrid(spark.createDataFrame(collab, SCHEMA), spark.createDataFrame(content, SCHEMA), weights, k).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.recommender, r.user_id, r.rank)):
        found.setdefault((r.recommender, r.user_id), []).append((r.item_id, r.score, r.collab_score, r.content_score))
    return found


def test_scores_ranks_and_ties(spark):
    got = lists(spark, [(0.5, 0.5)], 10)
    assert got["hybrid_0.5_0.5", 1] == [(3, 0.375, 0.0, 0.75), (4, 0.375, 0.0, 0.75), (7, 0.3125, 0.5, 0.125), (8, 0.125, 0.25, 0.0)]
    assert got["hybrid_0.5_0.5", 2] == [(9, 0.5, 1.0, 0.0)]


def test_cut_is_per_query(spark):
    got = lists(spark, [(1.0, 0.0)], 2)
    assert {key: [i for i, *_ in v] for key, v in got.items()} == {("hybrid_1.0_0.0", 1): [7, 8], ("hybrid_1.0_0.0", 2): [9]}


def test_every_pair_of_weights_has_lists_of_its_own(spark):
    weights = [(0.65, 0.35), (0.7, 0.3), (0.7, 0.3), (0.66, 0.34)]
    got = lists(spark, weights, 1)
    assert {name for name, _ in got} == {"hybrid_0.65_0.35", "hybrid_0.7_0.3", "hybrid_0.66_0.34"}
    assert all(len(v) == 1 for v in got.values())
    assert got["hybrid_0.65_0.35", 1][0][0] == 7 and got["hybrid_0.65_0.35", 1][0][1] == pytest.approx(0.65 * 0.5 + 0.35 * 0.125)


@pytest.mark.parametrize("collab, content, items", [(COLLAB, [], [7, 8]), ([], CONTENT, [3, 4, 7]), ([], [], None)])
def test_missing_sides(spark, collab, content, items):
    got = lists(spark, [(0.5, 0.5)], 5, collab, content)
    assert [i for i, *_ in got.get(("hybrid_0.5_0.5", 1), [])] == (items or [])


def test_query_item_is_left_out(spark):
    seeded = spark.createDataFrame([(*r, 7) for r in COLLAB], SCHEMA + ", seed bigint")
    other = spark.createDataFrame([(*r, 7) for r in CONTENT], SCHEMA + ", seed bigint")
    out = hybrid(seeded, other, [(0.5, 0.5)], 9, exclude_col="seed").collect()
    assert {r.item_id for r in out if r.user_id == 1} == {3, 4, 8}


def test_single_method(spark):
    ranked = spark.createDataFrame([(1, 7, 1, 0.5), (1, 8, 2, 0.25)], "user_id bigint, item_id bigint, rank int, similarity double")
    got = single_method(ranked, "content", 1).collect()
    assert [(r.recommender, r.item_id, r.score, r.collab_score, r.content_score) for r in got] == [("content", 7, 0.5, 0.0, 0.5)]


def test_weights_as_text():
    assert parse_weights("0.25:0.75") == (0.25, 0.75)
    assert weight_name(1, 0) == "hybrid_1.0_0.0"
