"""SimHash: fingerprints from the definition, links and components by brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from shelfwise.llm import simhash
from shelfwise.llm.components import components


def by_definition(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _texts(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "ÀB", "x y", "😀"]
    base = [" ".join(r.choice(words) for _ in range(r.choice((1, 2, 3, 4, 5, 60, 400)))) for _ in range(25)]
    texts = list(base)
    for t in base:
        for _ in range(r.choice((0, 2, 9))):
            w = t.split(" ")
            w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
    return texts + ["", None, " \n\t", base[0].upper(), base[3], base[3]]


def test_fingerprints():
    for t in [*_texts(), "word " * 70000]:
        assert simhash.simhash(t) == by_definition(t)


def test_spark_hash_agrees(spark):
    """The shingle hash is Spark's own xxhash64."""
    got = spark.sql("SELECT xxhash64('some shingle é of words') AS h").first().h
    assert got % 2 ** 64 == xxhash.xxh64_intdigest("some shingle é of words".encode(), 42)


def _components(prints, max_bits):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


@pytest.mark.parametrize("block", [2048, 5])
def test_links_connect_what_brute_force_connects(spark, block):
    r = random.Random(1)
    centre = [r.getrandbits(64) for _ in range(30)]
    prints = {0, 2 ** 64 - 1, 1}
    for c in centre:
        for _ in range(r.choice((1, 3, 25))):
            x = c
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, block)
    found = {x.node: x.component for x in components(links).collect()}
    want = _components(prints, 4)
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(w, set()).add(s)
    got = {}
    for s in signed:
        got.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_pivots_discard_only_what_differs():
    r = np.random.default_rng(5)
    fp = r.integers(0, 2 ** 63, 200, dtype=np.uint64)
    fp[100:] = fp[:100] ^ np.uint64(0b1011)
    pivots = np.array([[int(p ^ np.uint64(q & (2 ** 64 - 1))).bit_count() for q in simhash._pivots()] for p in fp], dtype=np.int16)
    a, b = simhash.links_in_blocks(fp, pivots, np.zeros(200, dtype=int), np.array([200]), 4)
    assert len(a) == 100


def test_near_duplicates(make_docs):
    texts = _texts()
    rows = [(1000 - i, t, "s", 1) for i, t in enumerate(texts)] + [(7, texts[30], "s", 1), (7, texts[30], "s", 1), (None, "alone and without any id", "s", 1)]
    docs = make_docs(rows, ", fp int").repartition(4)
    prints = [by_definition(r[1]) for r in rows]
    label = _components(prints, 4)
    least = {}
    for r, c in zip(rows, label):
        least[c] = min((x for x in (least.get(c), r[0]) if x is not None), default=None)
    got = sorted(simhash.near_duplicates(docs).select("doc_id", simhash.fingerprint_text(simhash.F.col("fp")), "component_id").collect(), key=repr)
    assert got == sorted([(r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, label)], key=repr)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(least.values(), key=repr)


def test_empty(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.without_near_duplicates(make_docs([])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)], "a long, b long")
    assert {r.node: r.component for r in components(edges).collect()} == {**{i: 0 for i in range(1, 61)}, 201: 200}
