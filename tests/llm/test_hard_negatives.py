import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import hard_negatives as hn

KIND = "vec_id long, label long, v array<double>"
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def expected(rows, is_anchor, k=5, share=80):
    out = []
    key = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    for i, (a, label, v) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = [(sum(int(x) * int(y) for x, y in zip(v, w)), b, j, m) for j, (b, m, w) in enumerate(rows) if j != i and len(w) == len(v)]
        for s, b, _, _ in sorted((x for x in scored if x[3] == label), key=key)[:k]:
            fits = sorted((x for x in scored if x[3] != label and share * s <= 100 * x[0] <= 100 * s), key=key)[:k]
            out += [(a, b, n + 1, x[1], s, x[0]) for n, x in enumerate(fits)]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def hundredth(a):
    return a is not None and a % 10 == 0


def clustered(seed, n, dim, groups, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 100
    return [(i, int(rng.integers(0, 4)), [float(int(x)) for x in centres[rng.integers(0, groups)] + rng.normal(size=dim) * spread]) for i in range(n)]


@pytest.mark.parametrize("rows", [clustered(1, 300, 8, 5, 3), clustered(2, 200, 3, 200, 1), [(i, i % 2, [1.0, 2.0]) for i in range(120)]],
                         ids=["groups", "scattered", "all equal"])
def test_equal_to_comparing_all(spark, rows):
    got = hn.mine(spark.createDataFrame(rows, KIND), F.col("vec_id") % 10 == 0, clusters=4, first_segment=16)
    assert result(got) == expected(rows, hundredth)


def test_walk_stops_when_certified(spark, monkeypatch):
    """Tight groups: members are certified long before the end of their list."""
    walked = []
    plain = hn.Lists._segment
    monkeypatch.setattr(hn.Lists, "_segment", lambda self, members, k, left, *a: (walked.append((k, members.count())), plain(self, members, k, left, *a))[1])
    rows = clustered(3, 600, 8, 3, 1)
    got = hn.mine(spark.createDataFrame(rows, KIND), F.col("vec_id") % 100 == 0, clusters=3, first_segment=8)
    assert result(got) == expected(rows, lambda a: a % 100 == 0)
    assert max(k for k, _ in walked) < 7 and walked[0] == (0, 6)


def test_no_bound_is_below_a_score():
    rng = np.random.default_rng(4)
    v = rng.integers(-300, 300, size=(400, 6)).astype(float)
    clusters = hn.fit_centres(v[:100].tolist(), 5)
    own = [c for c in clusters if c.dim == 6]
    unit, norm = hn._directions(v[:100])
    cos = unit @ np.array([c.centre for c in own]).T
    best = cos.argmax(axis=1)
    radius = {c.number: float(np.arccos(np.clip(cos[best == i, i], -1, 1)).max(initial=0)) for i, c in enumerate(own)}
    bound = hn.bounds(v, own, radius)
    score = hn.products(v[:100], v)
    for i in range(100):
        assert (score[i] <= np.floor(norm[i] * bound[:, best[i]] * (1 + hn.SLACK) + hn.SLACK)).all()


def test_nulls_ties_repeated_ids_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    table = [(0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (1, [0.5, 0.25], 1), (2, [0.45, 0.2], 2), (3, [0.45, 0.2], 2), (None, [0.5, 0.2], 2),
             (None, [0.5, 0.3], 1), (4, None, 1), (5, [nan, 1.0], 2), (6, [None, 1.0], 2), (8, [inf, 1.0], 2), (9, [0.5, 0.25], None),
             (10, [], 1), (11, [], 2), (12, [], 1), (20, [0.0, 0.0], 1), (30, [1.0, 2.0, 3.0], 1), (14, [-0.5, 0.1], 2)]
    df = spark.createDataFrame([(*r, "x") for r in table], "vec_id long, embedding array<float>, label int, r string")
    rows = [(i, (m + 1) % 10 if i is not None and i % 7 == 0 else m, [float(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, m in table
            if m is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert result(hn.mine(hn.relabelled(df), F.col("vec_id") % 10 == 0)) == expected(rows, hundredth)


def test_scores_beyond_doubles(spark):
    rows = [(0, 1, [2.0**40, 3.0]), (1, 1, [2.0**21 + 1, 5.0]), (2, 2, [2.0**21, 7.0]), (10, 1, [1e300, -1e300]), (3, 2, [2.0**31, 1.0])]
    got = result(hn.mine(spark.createDataFrame(rows[:3], KIND), F.col("vec_id") == 0))
    assert got == expected(rows[:3], lambda a: a == 0)
    assert hn.mine(spark.createDataFrame(rows, KIND), F.col("vec_id") % 10 == 0).count() >= 0


def test_empty_table_and_no_anchor(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert result(hn.mine(hn.relabelled(empty), F.col("vec_id") % 100 == 0)) == []
    one = spark.createDataFrame([(1, 1, [1.0])], KIND)
    assert result(hn.mine(one, F.col("vec_id") % 100 == 0)) == []
