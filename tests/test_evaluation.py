"""Ranking metrics, coverage, diversity and the holdout sampler."""

import math

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evaluation as ev


def metric(spark, name, recommended, relevant, k):
    recs = spark.createDataFrame([("r", 1, i + 1, item) for i, item in enumerate(recommended)],
                                 "recommender string, user_id bigint, rank bigint, item_id bigint")
    hold = spark.createDataFrame([(1, -1, len(set(relevant)))], "user_id bigint, seed_item bigint, n_positives bigint")
    pos = spark.createDataFrame([(1, x) for x in set(relevant)], "user_id bigint, item_id bigint")
    out = ev.per_query_metrics(recs, hold, pos, ["r"], [k]).collect()
    assert len(out) == 1
    return out[0][name]


# One list, hits at ranks 2, 3 and 6, four relevant items: everything by hand.
LIST, RELEVANT = [50, 61, 62, 53, 54, 63], [61, 62, 63, 64]
D = [1 / math.log2(r + 1) for r in range(1, 10)]  # discounts


@pytest.mark.parametrize("k, precision, recall, hit, ndcg, ap", [
    (1, 0.0, 0.0, 0.0, 0.0, 0.0),
    (2, 1 / 2, 1 / 4, 1.0, D[1] / (D[0] + D[1]), (1 / 2) / 2),
    (3, 2 / 3, 2 / 4, 1.0, (D[1] + D[2]) / sum(D[:3]), (1 / 2 + 2 / 3) / 3),
    (6, 3 / 6, 3 / 4, 1.0, (D[1] + D[2] + D[5]) / sum(D[:4]), (1 / 2 + 2 / 3 + 3 / 6) / 4),
    (9, 3 / 9, 3 / 4, 1.0, (D[1] + D[2] + D[5]) / sum(D[:4]), (1 / 2 + 2 / 3 + 3 / 6) / 4),
    (0, 0.0, 0.0, 0.0, 0.0, 0.0)])
def test_metrics_by_hand(spark, k, precision, recall, hit, ndcg, ap):
    for name, want in (("precision", precision), ("recall", recall), ("hit_rate", hit), ("ndcg", ndcg), ("map", ap)):
        assert metric(spark, name, LIST, RELEVANT, k) == pytest.approx(want), name


@pytest.mark.parametrize("listed, relevant", [([], [5]), ([5, 6], []), ([7], [8])])
def test_metrics_without_hits(spark, listed, relevant):
    assert {metric(spark, m, listed, relevant, 4) for m in ev.METRICS} == {0.0}


def recs_of(spark, lists, name="r"):
    return spark.createDataFrame([(name, q, i + 1, item) for q, lst in enumerate(lists) for i, item in enumerate(lst)],
                                 "recommender string, user_id bigint, rank bigint, item_id bigint")


def test_coverage_of_every_recommender(spark):
    recs = recs_of(spark, [[4, 5, 6], [5, 9]], "a").unionByName(recs_of(spark, [[4]], "b"))
    got = {r.recommender: r.catalog_coverage for r in ev.coverage(recs, 8, 2, ["a", "b", "none"]).collect()}
    assert got == {"a": 3 / 8, "b": 1 / 8, "none": 0.0}
    assert {r.catalog_coverage for r in ev.coverage(recs, 0, 2, ["a", "none"]).collect()} == {0.0}


def features_of(spark, vecs):
    """item -> {block: {feature: value}}, every block of unit length."""
    rows = [(i, b, f, float(v)) for i, blocks in vecs.items() for b, fs in blocks.items() for f, v in fs.items()]
    return spark.createDataFrame(rows, "item_id bigint, block string, feature string, value double")


def diversity(spark, vecs, items):
    got = ev.list_diversity(recs_of(spark, [items]), features_of(spark, vecs), 20).collect()
    return got[0].diversity if got else None


SHELF = {1: {"s": {"x": 1}}, 2: {"s": {"x": 0.6, "y": 0.8}}, 3: {"s": {"z": 1}}, 4: {"s": {"x": 1}, "t": {"q": 1}}, 5: {"s": {"x": -1}}}


@pytest.mark.parametrize("items, want", [
    ([1, 2], 0.4), ([1, 3], 1.0), ([1, 2, 3], (0.4 + 1 + 1) / 3), ([1, 4], 1 - 1 / math.sqrt(2)), ([1, 5], 1.0),
    ([1, 99, 2], 0.4), ([1], None), ([1, 99], None)])
def test_diversity_by_hand(spark, items, want):
    """Distances are 1 - cosine over blocks of equal weight, held to 0..1; 99 has
    no vector; one valid item makes no pair."""
    assert diversity(spark, SHELF, items) == (want if want is None else pytest.approx(want))


def _holdouts(spark):
    hold = spark.createDataFrame([(0, 4, 2), (1, 5, 1)], "user_id bigint, seed_item bigint, n_positives bigint")
    pos = spark.createDataFrame([(0, 5), (0, 9), (1, 4)], "user_id bigint, item_id bigint")
    return hold, pos, spark.createDataFrame([(4,), (5,), (9,), (10,)], "item_id bigint")


def test_evaluator_takes_functions(spark):
    hold, pos, catalog = _holdouts(spark)

    def same(queries, k):
        return queries.selectExpr("user_id", "posexplode(slice(array(5, 4), 1, %d)) AS (p, i)" % k).selectExpr(
            "user_id", "CAST(p + 1 AS BIGINT) AS rank", "CAST(i AS BIGINT) AS item_id")

    def silent(queries, k):
        return same(queries, k).where("false")

    report = ev.evaluate_recommenders({"same": same, "silent": silent}, hold, pos, [1, 2], catalog)
    got = {(r.recommender, r.k, r.metric): r.value for r in report.collect()}
    assert got["same", 1, "precision"] == 0.5 and got["same", 2, "hit_rate"] == 1.0 and got["same", 2, "catalog_coverage"] == 0.5
    assert {v for (name, _, m), v in got.items() if name == "silent" and m in (*ev.METRICS, "catalog_coverage")} == {0.0}
    assert len([1 for name, _, m in got if name == "silent"]) == len(got) / 2


def test_evaluator_refuses_empty_input(spark):
    hold, pos, catalog = _holdouts(spark)
    with pytest.raises(ValueError):
        ev.evaluate_recommenders({}, hold, pos, [1], catalog)
    with pytest.raises(ValueError):
        ev.evaluate(recs_of(spark, [[4]]), hold.limit(0), pos, ["r"], [1], catalog)


def toy_cells(spark):
    # user 0 -> items 0..3, user 1 -> 0,1, user 2 -> 2,3,4, user 3 -> none
    pairs = [(0, 0), (1, 0), (2, 0), (3, 0), (0, 1), (1, 1), (2, 2), (3, 2), (4, 2)]
    return spark.createDataFrame([(i, u, 1.0) for i, u in pairs], "item_id bigint, user_id bigint, rating double")


def test_holdouts_min_interactions(spark):
    cells = toy_cells(spark)
    assert {r.user_id for r in ev.sample_holdouts(cells, 10, 2, 0).collect()} <= {0, 1, 2}
    assert {r.user_id for r in ev.sample_holdouts(cells, 10, 3, 0).collect()} <= {0, 2}
    assert ev.sample_holdouts(cells, 10, 10, 0).count() == 0
    assert ev.sample_holdouts(cells, 0, 2, 0).count() == 0


def test_holdouts_deterministic_and_distinct(spark):
    cells = toy_cells(spark)
    a = sorted(ev.sample_holdouts(cells, 3, 2, 5).collect())
    b = sorted(ev.sample_holdouts(cells, 3, 2, 5).collect())
    assert a == b
    many = ev.sample_holdouts(cells, 100, 2, 1).collect()
    assert len(many) == 3 and len({r.user_id for r in many}) == 3


def test_holdouts_seeds_vary(spark):
    cells = toy_cells(spark)
    picks = {tuple(sorted((r.user_id, r.seed_item) for r in ev.sample_holdouts(cells, 3, 2, s).collect()))
             for s in range(8)}
    assert len(picks) > 1


def test_holdout_positive_invariants(spark):
    cells = toy_cells(spark)
    hold = ev.sample_holdouts(cells, 3, 2, 11)
    pos = ev.holdout_positives(cells, hold).collect()
    items = {0: {0, 1, 2, 3}, 1: {0, 1}, 2: {2, 3, 4}}
    for h in hold.collect():
        p = {r.item_id for r in pos if r.user_id == h.user_id}
        assert h.seed_item in items[h.user_id] and h.seed_item not in p
        assert p == items[h.user_id] - {h.seed_item}
        assert h.n_positives == len(items[h.user_id]) - 1


def test_evaluate_rejects_empty_k(spark):
    with pytest.raises(ValueError):
        ev.per_query_metrics(recs_of(spark, [[1]]), None, None, ["r"], [])


def test_write_report_with_config(spark):
    import tempfile

    tidy = spark.createDataFrame([("r", 10, "ndcg", 0.5), ("r", 10, "recall", 0.25)],
                                 "recommender string, k int, metric string, value double")
    path = tempfile.mkdtemp(prefix="report-") + "/out"
    ev.write_report(tidy, path, {"seed": 42, "k_values": [5, 10, 20], "n_users": 500})
    back = spark.read.json(path).collect()
    assert {(r.metric, r.value, r.config_seed, r.config_k_values) for r in back} == {
        ("ndcg", 0.5, 42, "[5, 10, 20]"), ("recall", 0.25, 42, "[5, 10, 20]")}
