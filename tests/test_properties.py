"""Randomised checks: many cases per Spark job against plain-Python restatements
of the metric and merge definitions."""

import math
import random

import pytest

from shelfwise.operators import evaluation as ev
from shelfwise.operators.hybrid import hybrid


def py_metrics(rec, rel, k):
    top = rec[:k]
    hits = [1 if x in rel else 0 for x in top]
    m = min(len(rel), k)
    dcg = sum(h / math.log2(i + 2) for i, h in enumerate(hits))
    idcg = sum(1 / math.log2(i + 2) for i in range(m))
    ap, run = 0.0, 0
    for i, h in enumerate(hits):
        if h:
            run += 1
            ap += run / (i + 1)
    return {
        "precision": sum(hits) / k if k > 0 else 0.0,
        "recall": sum(hits) / len(rel) if rel else 0.0,
        "ndcg": dcg / idcg if m > 0 else 0.0,
        "map": ap / m if m > 0 else 0.0,
        "hit_rate": 1.0 if any(hits) else 0.0,
    }


def test_ranking_metrics_random(spark):
    rnd = random.Random(7)
    cases = []
    for q in range(300):
        catalog = list(range(30))
        rec = rnd.sample(catalog, rnd.randint(0, 20))
        rel = set(rnd.sample(catalog, rnd.randint(0, 12)))
        cases.append((q, rec, rel))
    ks = [1, 3, 5, 10, 20]
    recs = spark.createDataFrame([("r", q, i + 1, x) for q, rec, _ in cases for i, x in enumerate(rec)],
                                 "recommender string, user_id bigint, rank bigint, item_id bigint")
    hold = spark.createDataFrame([(q, -1, len(rel)) for q, _, rel in cases],
                                 "user_id bigint, seed_item bigint, n_positives bigint")
    pos = spark.createDataFrame([(q, x) for q, _, rel in cases for x in rel], "user_id bigint, item_id bigint")
    got = {(r.user_id, r.k): r for r in ev.per_query_metrics(recs, hold, pos, ["r"], ks).collect()}
    assert len(got) == len(cases) * len(ks)
    for q, rec, rel in cases:
        for k in ks:
            exp = py_metrics(rec, rel, k)
            for name, v in exp.items():
                assert got[(q, k)][name] == pytest.approx(v, abs=1e-12), (q, k, name)


def py_hybrid(collab, content, wc, wt, k):
    scores = {}
    for item, s in collab:
        scores[item] = scores.get(item, 0.0) + wc * s
    for item, s in content:
        scores[item] = scores.get(item, 0.0) + wt * s
    return [i for i, _ in sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))[:k]]


def test_hybrid_random(spark):
    rnd = random.Random(11)
    rows_c, rows_t, cases = [], [], []
    for q in range(200):
        collab = [(i, round(rnd.random(), 6)) for i in rnd.sample(range(40), rnd.randint(0, 15))]
        content = [(i, round(rnd.random(), 6)) for i in rnd.sample(range(40), rnd.randint(0, 15))]
        rows_c += [(q, i, s) for i, s in collab]
        rows_t += [(q, i, s) for i, s in content]
        cases.append((q, collab, content))
    schema = "user_id bigint, item_id bigint, similarity double"
    weights = [(0.6, 0.4), (0.3, 0.7)]
    out = hybrid(spark.createDataFrame(rows_c, schema), spark.createDataFrame(rows_t, schema), weights, 10).collect()
    got = {}
    for r in sorted(out, key=lambda r: r.rank):
        got.setdefault((r.recommender, r.user_id), []).append(r.item_id)
    for q, collab, content in cases:
        for wc, wt in weights:
            exp = py_hybrid(collab, content, wc, wt, 10)
            assert got.get((f"hybrid_{wc:.1f}_{wt:.1f}", q), []) == exp, (q, wc)
