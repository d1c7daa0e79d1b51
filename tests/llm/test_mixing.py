"""Mixing: targets by the resharing loop, and the schedule against its definition."""

import collections
import random

import pytest

from shelfwise.llm import mixing


def by_resharing(sizes, weights=(5, 2, 1), most=3):
    """Targets as the rule says: share by weight, stop at the cap, share the rest."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= full
    return target


def _rows(seed, n=120):
    r = random.Random(seed)
    rows = [(i, " ".join("w" * r.randint(1, 5) for _ in range(r.choice((0, 1, 3, 40, 900)))), r.choice(("b", "a", "a", "a", "é", "Z", None))) for i in range(n)]
    return rows + [(n, None, "only-null"), (3, rows[3][1], rows[3][2]), (None, "no id", "b")]


@pytest.mark.parametrize("seed, block", [(1, 7), (2, 64)])
def test_mix(make_docs, seed, block):
    rows = _rows(seed)
    docs = make_docs([(*r, 1, 2) for r in rows], ", size int, row_key int")
    got = mixing.mix_totals(docs, block_words=block).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = by_resharing(dict(sizes))
    assert sum(r.taken for r in got) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    source = {r[0]: r[2] for r in rows}
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 0.5 for s, t in want.items())
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix_totals(docs.repartition(5), block_words=block).collect()))


def test_equal_rows_without_words_stay_rows(make_docs):
    docs = make_docs([(1, None, "a"), (1, None, "a"), (None, "", "a"), (None, "", "a"), (2, "one two three", "a"), (2, "one two three", "a")])
    got = mixing.mix_totals(docs).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == {(1, 0): 2, (None, 0): 2, (2, 3): 2}
    assert sum(r.taken for r in got) == 6


def test_schedule(spark):
    """Every prefix of the mix is near the target shares; ranks have no gaps."""
    sources = spark.createDataFrame([("a", 1, 900, 0.0, 1500, 90, 150), ("b", 2, 50, 0.0, 50, 5, 5), ("c", 3, 9, 0.0, 9, 1, 1), ("d", 4, 0, 0.0, 0, 0, 0)],
                                    "source string, source_no long, source_size long, target double, wanted long, blocks long, need long")
    slots = sorted(mixing.schedule(sources).collect(), key=lambda r: r.slot)
    assert collections.Counter(r.source_no for r in slots) == {1: 150, 2: 5, 3: 1}
    seen = collections.Counter()
    for i, r in enumerate(slots):
        assert r.rank == seen[r.source_no] and (r.block, r.epoch) == (r.rank % {1: 90, 2: 5, 3: 1}[r.source_no], r.rank // {1: 90, 2: 5, 3: 1}[r.source_no])
        seen[r.source_no] += 1
        assert abs(seen[1] - (i + 1) * 150 / 156) < 4


def test_mixed_documents(make_docs):
    rows = _rows(3, 60)
    docs = make_docs([(*r, 5, "x") for r in rows], ", takes int, take string")
    out = mixing.mixed_documents(docs, length_col="n_chars", block_words=50)
    assert out.columns == docs.columns
    out = out.collect()
    words = collections.Counter()
    for r in out:
        whole = dict((x[0], x[1]) for x in rows)[r.doc_id]
        assert r.text == whole or whole.split()[:len(r.text.split())] == r.text.split()
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
    want = collections.Counter()
    for r in mixing.mix_totals(docs, block_words=50).collect():
        want[r.doc_id] += r.taken
    assert words == +want


def test_empty(make_docs):
    assert mixing.mix_totals(make_docs([])).count() == 0
    assert mixing.mixed_documents(make_docs([])).count() == 0
    assert [r.taken for r in mixing.mix_totals(make_docs([(1, None, None), (2, " ", "s")])).collect()] == [0, 0]
