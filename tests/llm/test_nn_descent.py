"""NN-descent: links, components and edge cases against brute force."""

import math

import numpy as np
import pytest

from shelfwise.llm import nn_descent


def _rows():
    r = np.random.default_rng(4)
    rows = []
    for size in (1, 2, 2, 3, 60, *[1] * 60):
        centre = r.standard_normal(24)
        rows += [(centre + 0.12 * r.standard_normal(24)).astype(np.float32).tolist() for _ in range(size)]
    rows += [rows[0], rows[0], [x * 3 for x in rows[1]]]
    return [(1000 - i, v, 0) for i, v in enumerate(rows)]


def brute(rows):
    usable = [i for i, (_, v, _) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], dtype=np.float64) / np.linalg.norm(np.array(rows[i][1], dtype=np.float64)) for i in usable}
    for a in usable:
        for b in usable:
            if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95:
                links[a].add(b)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("odd", [[], [(1, None, 0), (2, [], 0), (3, [0.0] * 24, 0), (4, [None] * 24, 0), (5, [float("nan")] * 24, 0), (6, [float("inf")] + [1.0] * 23, 0),
                                      (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0), (None, [1.0] * 24, 0), (9, [1.0] * 24, 0), (9, [1.0] * 24, 0), (10, [1e30] * 24, 0), (None, [-5.0] * 24, 0)]])
def test_against_brute_force(spark, odd):
    rows = _rows() + odd
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, p int").repartition(3)
    got = sorted((tuple(r) for r in nn_descent.near_duplicates(vectors).collect()), key=repr)
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], p) for i, v, p in rows])
    assert got == want


def test_blocks_of_a_large_component(spark):
    rows = [(1000 - i, v, 0) for i, (_, v, _) in enumerate(_rows())]
    points = spark.createDataFrame([(i, v, 1) for i, v, _ in rows], "p long, v array<float>, copies long")
    labelled = points.selectExpr("p", "0L AS component")
    got = {r.p: r.n_links - 1 for r in nn_descent.link_counts(points, labelled, block=7).collect()}
    assert sorted(got.items()) == sorted((i, n) for i, n, _, _ in brute(rows))


def test_audit(spark):
    rows = _rows()
    points = spark.createDataFrame([(i, v) for i, v, _ in rows], "p long, v array<float>")
    nothing = spark.createDataFrame([], "node long, component long")
    assert nn_descent.audit(points, nothing) == 0.0
    everything = points.selectExpr("p AS node", "0L AS component")
    assert nn_descent.audit(points, everything) == 1.0


def test_empty(spark):
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_touching_groups_larger_than_a_list(spark):
    """Two groups of more than K near-copies: every list is filled by its own
    group, and the links between the groups still count."""
    r = np.random.default_rng(3)
    a, b = np.linalg.qr(r.standard_normal((64, 2)))[0].T
    centres = [a, 0.97 * a + math.sqrt(1 - 0.97 ** 2) * b]
    rows = [(i, (centres[i % 2] + 0.0125 * r.standard_normal(64)).astype(np.float32).tolist(), 0) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, p int").repartition(3)
    got = sorted((tuple(x) for x in nn_descent.near_duplicates(vectors).collect()), key=repr)
    want = brute(rows)
    assert {c for _, _, c, _ in want} == {0} and min(n for _, n, _, _ in want) > 199
    assert got == want


def test_audit_finds_what_the_graph_lacks(spark, monkeypatch):
    """Without any table the graph is empty; one link among 1,202 points is still
    found, as too few links for a recall have more points asked."""
    monkeypatch.setattr(nn_descent, "TABLES", 0)
    r = np.random.default_rng(8)
    rows = [(i, r.standard_normal(24).astype(np.float32).tolist(), 0) for i in range(1201)]
    rows.append((5000, (np.array(rows[700][1]) + 0.01).tolist(), 0))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, p int")
    got = {x.vec_id: (x.n_links, x.component_id) for x in nn_descent.near_duplicates(vectors).collect()}
    assert got == {i: (int(i in (700, 5000)), 700 if i == 5000 else i) for i, _, _ in rows}


def test_low_recall_is_never_returned(spark, monkeypatch):
    """Where no turn reaches the recall, all points are asked."""
    monkeypatch.setattr(nn_descent, "TABLES", 0)
    monkeypatch.setattr(nn_descent, "AUDITS", 1)
    monkeypatch.setattr(nn_descent, "AUDIT_POINTS", 8)
    monkeypatch.setattr(nn_descent.audited, "__defaults__", (0.95, 8, 1, 0, 100))
    rows = [(i, v, 0) for i, (_, v, _) in enumerate(_rows())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, p int")
    got = sorted((tuple(x) for x in nn_descent.near_duplicates(vectors).collect()), key=repr)
    assert got == brute([(i, [float(np.float32(x)) for x in v], p) for i, v, p in rows])
