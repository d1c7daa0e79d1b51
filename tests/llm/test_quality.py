"""Quality rules against their definition; host verdicts; both classifiers."""

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality_classifier, quality_rules, toxicity
from shelfwise.llm.labelled import fit_rows

TEXTS = ["a b c d e a b c d e f", "one two three", "", None, "x\ny\nx\n\n \nx\n", "Symbols # * $ % & | < > !", "A B C\tD\x0bE\x0cF\rG  h",
         "É é ß 😀 z", "r r r r r r r", "w " * 5000, "one two three four five " * 3 + "six", "\n".join(["same line of text here"] * 4)]


def definition(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures_one_by_one_and_together():
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = [definition(t) for t in TEXTS]
    assert list(quality_rules.measures(TEXTS)[cols].itertuples(index=False, name=None)) == want
    assert [quality_rules.measures([t])[cols].iloc[0].tolist() for t in TEXTS] == [list(w) for w in want]


def test_letters():
    assert quality_rules.letters("AbC é É 12") == (5, 3)
    assert quality_rules.letters("Straße ABC") == (8, 4)


GOOD = "plain words stand here in a line that says what it means number{} and no more than that"


def test_hosts(make_docs):
    """A failing text goes on a bad host and on a common one; on a clean host with
    a weak failure rate the odds decide; a host of junk goes as a whole."""
    junk = "buy$$$ now### here*** and%%% more&&& again$$$ there### once*** this%%% time&&& only$$$ {}"
    rows = [(i, GOOD.format(i), "clean") for i in range(300)]
    rows += [(1000 + i, junk.format(i), "junk") for i in range(300)] + [(1999, GOOD.format(5), "junk")]
    rows += [(2000 + i, (junk if i % 4 == 0 else GOOD).format(i), None) for i in range(200)]
    rows += [(3000, None, "clean"), (3001, "", "clean"), (3002, "few words", "lone"), (3, GOOD.format(3), "clean")]
    docs = make_docs([(*r, 1.0, True, "x") for r in rows], ", rate double, blocked boolean, measures string")
    kept = quality_rules.clean_documents(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert all(ids[i] == 1 + (i == 3) for i in range(300))
    assert not any(1000 <= i < 2000 for i in ids)
    assert all((2000 + i in ids) == (i % 4 != 0) for i in range(200))
    assert not {3000, 3001, 3002} & set(ids)
    few = quality_rules.BROADCAST_HOSTS
    try:
        quality_rules.BROADCAST_HOSTS = 0  # the join for many hosts gives the same
        assert Counter(r.doc_id for r in quality_rules.clean_documents(docs).collect()) == ids
    finally:
        quality_rules.BROADCAST_HOSTS = few
    rates = {r[0].host: r.rate for r in quality_rules.host_verdicts(docs.selectExpr("struct(coalesce(source, '') AS host) AS host", "source = 'junk' AS failed").na.fill(False)).collect()}
    assert rates["junk"] > 0.99 and rates["clean"] < 0.01 < rates["lone"]
    assert quality_rules.clean_documents(docs.limit(0)).count() == 0


def test_fit_rows_leaves_held_out_ids(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (3, None), (4, 7), (1, 1)], "doc_id long, quality int")
    rows = fit_rows(labels, "quality", max_rows=40).collect()
    assert len(rows) == 80 and len({r.fit_id for r in rows}) == 80
    assert all(zlib.crc32(str(r.fit_id).encode()) % 3 != 1 for r in rows)
    assert all(r.weight > 2 for r in rows)


def _classified(spark, make_docs, module, label, good, bad):
    rows = [(i, (bad if i % 4 == 0 else good).format(i, i % 7), "s") for i in range(240)]
    docs = make_docs([*rows, (500, None, "s"), (501, "", "s"), (None, good.format(1, 2), None), (7, rows[7][1], "s")])
    one = int(label == "toxic")
    labels = spark.createDataFrame([(i, one if i % 4 == 0 else 1 - one) for i in range(240)], f"doc_id long, {label} int")
    got = module.scores(docs, labels).collect()
    assert len(got) == 244
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 240:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            assert r.predicted == (one if r.doc_id % 4 == 0 else 1 - one), r
    assert module.scores(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in module.scores(docs, labels.limit(0)).collect()} <= {0, 1}


def test_quality_classifier(spark, make_docs):
    _classified(spark, make_docs, quality_classifier, "quality", GOOD + " {}", "BUY!! NOW!! {} ### $$$ *** buy!! now!! {} ### $$$ ***")


def test_toxicity(spark, make_docs):
    _classified(spark, make_docs, toxicity, "toxic", "they came {} to the village and were kind {}", "they came {} you horrid lumpkin and went {}")


def test_strengths_order_pairs():
    r = np.random.default_rng(0)
    good, bad = r.normal(1, 1, (300, 3)), r.normal(-1, 1, (300, 3))
    w = quality_classifier.fit_strengths(good, bad)
    assert (w > 0).all() and ((good @ w)[:, None] > (bad @ w)[None, :]).mean() > 0.97


def test_counterfactual_penalty_silences_identity_terms():
    """Where a group is named in toxic labelled texts only, the penalty takes the
    name's weight away and leaves that of the insult."""
    vocabulary = ["lumpkin", "kind", *[t for terms in toxicity.IDENTITY_TERMS.values() for t in terms]]
    held = toxicity.Presence(vocabulary)
    texts = [("muslim lumpkin", 1), ("christian lumpkin", 1), ("lumpkin", 1), ("muslim", 1), ("christian kind", 0), ("kind", 0), ("kind friends", 0)] * 20
    x, y = [held(t) for t, _ in texts], np.array([c for _, c in texts], dtype=float)
    pairs = [(i, held.of_words(w)) for i, (t, _) in enumerate(texts) for w in toxicity.swapped_words(set(t.split()))]
    fitted = lambda c: dict(zip(vocabulary, toxicity.fit(x, y, np.ones(len(y)), len(vocabulary), pairs, c)[0]))
    weight, loose = fitted(toxicity.COUNTERFACTUAL), fitted(0.0)
    assert abs(weight["muslim"]) < 0.3 * weight["lumpkin"]
    assert abs(weight["muslim"] - weight["christian"]) < 0.2 * weight["lumpkin"]
    assert loose["muslim"] > 2 * abs(weight["muslim"])


def test_swaps_are_of_the_terms_in_the_text():
    words = toxicity.swapped_words({"muslim.", "men", "kind"})
    assert {"christian", "men", "kind"} not in words and {"jewish", "men", "kind"} in words and {"person", "men", "kind"} in words
    assert {"muslim.", "women", "kind"} in words and {"muslim.", "person", "kind"} in words and len(words) == 4
    assert toxicity.swapped_words({"kind"}) == []


def test_clashing_labels_of_one_text_do_not_depend_on_the_partitions(spark, make_docs):
    """Copies of one text with both labels: the larger counts, however the rows lie."""
    rows = [(i, "they came you horrid lumpkin" if i % 5 == 0 else f"they were kind to the {i % 40} friends", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, toxic int")
    quality = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, quality int")
    for module, marked in ((toxicity, labels), (quality_classifier, quality)):
        got = [sorted((r.doc_id, round(r.score, 9)) for r in module.scores(make_docs(rows).repartition(n), marked.repartition(n)).collect()) for n in (3, 8)]
        assert got[0] == got[1]


def test_accuracy_on_held_out_rows(spark):
    """sf0.1's own labels, held-out rows only."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    want = labels.toPandas().drop_duplicates("doc_id").set_index("doc_id")
    for module, label, least in ((quality_classifier, "quality", 0.98), (toxicity, "toxic", 0.95)):
        got = module.scores(docs, labels).where("held_out").toPandas()
        got = got[got.doc_id.isin(want.index)]
        truth = want.loc[got.doc_id, label].to_numpy()
        assert (got.predicted.to_numpy() == truth).mean() >= least
        ranks = pd.Series(got.score.to_numpy()).rank().to_numpy()
        n1, n0 = (truth == 1).sum(), (truth == 0).sum()
        assert (ranks[truth == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.97


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """All rows are dealt, whatever their number, and every bucket has both classes."""
    monkeypatch.setattr(quality_classifier, "BUCKET", 50)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), *[F.lit(0.5).alias(f) if f != "digits" else F.col("id").cast("double").alias(f) for f in quality_classifier.FEATURES],
                                    (F.col("id") % 600 == 0).cast("int").alias("y"))
    got = quality_classifier.dealt(rows, 5, 2995).collect()
    of = lambda x: [int(v) for v in x[len(quality_classifier.FEATURES) - 1::len(quality_classifier.FEATURES)]]
    assert len(got) == 60 and all(sorted(of(r.good)) == [0, 600, 1200, 1800, 2400] for r in got)
    assert {i for r in got for i in of(r.bad)} == {i for i in range(3000) if i % 600}


def test_measures_hold_few_words_at_a_time():
    texts = ["ab " * 10, "", "x" * 90, "y z"]
    assert list(quality_rules.parts(texts, 40)) == [["ab " * 10, ""], ["x" * 90], ["y z"]]
    assert [len(x) for x in quality_rules.parts(["a b " * 250_000] * 3)] == [1, 1, 1]
    assert quality_rules.measures(texts).n_words.tolist() == [10, 0, 1, 2] and len(quality_rules.measures([])) == 0
