"""Personal data: spans against Python's own matcher, and disclosing terms."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in hit.split(".")),
            "card": 13 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if _valid(k, m[0])]


TEXTS = [None, "", "plain", "a@b.c", "a@b.com_x@y.com .@-.- @x.y", "1.2.3.4.5.6.7.8 300.1.1.1.2 0001.002.3.4 1.2.3.256", "4111 1111 1111 1111 and 4111-1111-1111-1112",
         "4111 1111 1111 1111 4111111111111111", "😀 é+49 (30) 123-456 7-. +1 2 ++1 (262) 555-3752)", "x@y.co 😀 z@w.io.", "1" * 30000 + " " + "a" * 50000 + "@b", "me@x.org, " * 400]


def test_spans(spark, make_docs):
    docs = make_docs([(i, t, "s") for i, t in enumerate(TEXTS)] + [(1, "", "s"), (None, "n@n.nn", None)])
    found = pii.find(docs.withColumn("base", F.lit(1)).withColumn("terms", F.lit("x"))).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r[-2]] == brute(r.text)
    assert pii.find(docs.limit(0)).count() == 0
    digest = {r.doc_id: r for r in pii.span_digest(pii.find(docs)).collect()}
    assert digest[3].n_email == 1 and digest[3].spans == "email:0:5" and digest[1].spans == ""


def test_redaction(make_docs):
    docs = make_docs([(1, "Mail a@b.co or +49 30 1234567, 10.0.0.1!", "s"), (2, None, "s"), (3, "clean", "s"), (3, "clean", "s")])
    out = [tuple(r) for r in pii.sanitised_documents(docs, length_col="n_chars").orderBy("doc_id").collect()]
    assert out == [(1, "Mail [EMAIL] or [PHONE], [IP]!", "en", "s", 30), (2, None, "en", "s", None), (3, "clean", "en", "s", 5), (3, "clean", "en", "s", 5)]


def test_disclosing_terms(make_docs):
    """A name that only stands beside one address tells it; common words, terms of
    copies of one text and terms of other documents do not."""
    told = [(i, f"Quarlo wrote text{i} from q@x.org here", "s") for i in range(6)]
    copies = [(100 + i, "Velmar said c@x.org here", "s") for i in range(8)]
    clean = [(200 + i, f"somebody wrote from here text{i}", "s") for i in range(200)]
    found = pii.find(make_docs(told + copies + clean))
    terms = {r.doc_id: [(r.text[s.start:s.end], s.removed) for s in r.terms] for r in found.collect()}
    assert all(terms[i] == [("Quarlo", True)] for i in range(6))
    assert not any(v for k, v in terms.items() if k >= 100)
    out = pii.sanitised_documents(make_docs(told[:6] + clean)).where("doc_id = 0").first()
    assert out.text == " wrote text0 from [EMAIL] here"


@pytest.mark.parametrize("text", TEXTS[3:10])
def test_patterns_keep_the_contracts_matches(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(pii.base_spans("t")).first()[0]
    assert [(s.kind, s.start, s.end) for s in got] == brute(text)


def _brute_terms(texts):
    """Told terms by counting every entity with every term, over all texts."""
    import math
    from collections import Counter, defaultdict

    def of(text):
        spans = brute(text)
        ents = set()
        for kind, a, b in spans:
            hit = text[a:b]
            value = hit.lower() if kind == "email" else hit if kind == "ip" else re.sub("[^0-9]", "", hit)
            wider = value.rsplit("@")[-1] if kind == "email" else ".".join(value.split(".")[:3]) if kind == "ip" else value[:6]
            ents |= {(kind, value), (kind + "+", wider)}
        every = lambda t: {w.lower() for w in re.findall(r"[^\W_]+", t)}
        bare = list(text)
        for _, a, b in spans:
            bare[a:b] = " " * (b - a)
        return ents, every("".join(bare)), every(text)

    n, docs, both = Counter(), defaultdict(set), Counter()
    for text, copies in Counter(t for t in texts if t).items():
        ents, free, every = of(text)
        for w in every:
            n[w] += copies
        for e in ents:
            for w in free:
                both[e, w] += copies
                docs[e, w].add(text)
    told = {}
    for (e, w), k in both.items():
        p, m, z = k / n[w], len(docs[e, w]), pii.Z
        low = (p + z * z / (2 * m) - z * math.sqrt(max(0, p * (1 - p)) / m + z * z / (4 * m * m))) / (1 + z * z / m)
        if -math.log2(low) <= pii.GENERALISE:
            told[w] = told.get(w, False) or -math.log2(low) <= pii.REMOVE
    return told


def test_told_terms_equal_counting_every_pair(spark):
    import random

    r = random.Random(8)
    names, common = [f"n{i}" for i in range(25)] + ["王", "Ö"], [f"w{i}" for i in range(12)]
    texts = []
    for _ in range(400):
        words = [r.choice(common) for _ in range(r.randint(1, 6))]
        if r.random() < 0.5:
            i = r.randrange(len(names))
            value = [f"p{i}@site{i % 6}.org", f"10.0.{i}.{r.randrange(250)}", f"+4930{i:02d}123{r.randrange(100):02d}"][i % 3]
            words += [names[i]] * (r.random() < 0.9) + [value] * (r.random() < 0.95)
        texts.append(" ".join(words))
    texts += texts[:60] + [None, "", "n1 n1"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    dirty = df.withColumn("base", pii.base_spans("text")).where(F.size("base") > 0)
    got = {x.term: x.removed for x in pii.disclosing_terms(dirty, df).collect()}
    assert got == _brute_terms(texts) and 5 < len(got) < 27 and {True, False} == set(got.values())


def test_told_terms_go_from_all_documents(make_docs):
    """Three texts are enough for a class; short and CJK names count; a document without the address is treated too."""
    told = [(i, f"王 al wrote text{i} from q{i}@one.org here", "s") for i in range(3)]
    alone = [(50, "so 王 wrote, and AL.", "s"), (50, "so 王 wrote, and AL.", "s"), (None, "nothing from here", None)]
    clean = [(200 + i, f"somebody wrote from here text{i}", "s") for i in range(60)]
    rows = {r.doc_id: r for r in pii.find(make_docs(told + clean)).collect()}
    assert [(rows[0].text[s.start:s.end], s.removed) for s in rows[0].terms] == [("王", False), ("al", False)]
    out = pii.sanitised_documents(make_docs(told + [(900 + i, f"王 {i} al t@one.org", "s") for i in range(12)] + alone[1:] + clean))
    assert [r.text for r in out.where("doc_id = 50").collect()] == ["so  wrote, and ."]
    assert out.where("doc_id is null").first().text == "nothing from here"


def test_a_list_of_many_addresses(spark):
    rows = [(" ".join(f"u{j}@d{j}.org name{j}" for j in range(800)) + f" list {i}",) for i in range(3)]
    df = spark.createDataFrame(rows, "text string")
    found = pii.find(df).collect()
    assert all(len(r[-2]) == 800 and len(r[-1]) >= 800 for r in found)


def test_joins_beyond_the_broadcast_bound(make_docs, monkeypatch):
    docs = make_docs([(i, f"Quarlo wrote text{i} from q@x.org here", "s") for i in range(6)] + [(200 + i, f"somebody wrote from here {i}", "s") for i in range(60)])
    rows = lambda: sorted(map(repr, pii.span_digest(pii.find(docs)).collect()))
    small = rows()
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert rows() == small and any("term:" in r for r in small)
