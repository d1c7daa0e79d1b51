import random
import re

from pyspark.sql import functions as F

from shelfwise.llm import licenses

KIND = "doc_id long, text string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text):
    """Detections by trying every rule on the words, and every pair of detections."""
    words = words_of(text)
    joined = " " + " ".join(words) + " "
    found = []
    if re.search(licenses.GATE, text or ""):
        for r in licenses.rules():
            if r["besides"] in joined and any(k in joined for k in r["keywords"]):
                for m in re.finditer(r["pattern"], joined):
                    major, minor = m.group(1) or "", m.group(2) or ""
                    label = r["label"] + (f"-{major}" if major else "") + (f".{minor}" if minor not in ("", "0") else "")
                    start = joined[:m.start()].count(" ") - 1
                    found.append((start, -(start + len(m.group(0).split(" "))), r["priority"], r["place"], label, r["confidence"], r["base"]))
    found.sort()
    out = []
    for i, x in enumerate(found):
        holds = any(y[0] <= x[0] and -y[1] >= -x[1] and y[2] <= x[2] for y in found[:i])
        stronger_inside = any(y[0] >= x[0] and -y[1] <= -x[1] and y[2] < x[2] for y in found)
        if not holds and not stronger_inside:
            out.append(x)
    return found, out


def base(text):
    words = words_of(text)
    return sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split())


PARTS = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License",
         "Apache License,\nVersion 2.0", "SPDX-License-Identifier: GPL-2.0-or-later", "All rights reserved.", "Copyright (c) 2019-2021", "lgplv2.1",
         "under the mit license", "cc by nc", "BSD 3-Clause License", "foo", "ü", "Version", "license", "the MIT license", "MPL-2.0", "\x00\n",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "public domain", "under the Boost license 1.0",
         "licensed under the Frobnicate Vendor License", "terms of this license", "dual-licensed under Creative Commons Attribution Share-Alike 3.0 unported",
         "İ mit", "under", "mit", "K license"]


def texts(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([" ", ", ", "\n", " - "]).join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))) for i in range(n)]


def test_equal_to_trying_every_rule_and_pair(spark):
    rows = [*texts(150, 3), (900, None), (901, ""), (902, "cc" * 30), (None, "under the mit license"), (903, "accept ccby nc")]
    got = {(r["doc_id"]): r for r in licenses.scan_licenses(spark.createDataFrame(rows, KIND)).collect()}
    for i, text in rows:
        found, kept = brute(text)
        assert got[i]["n_words"] == len(words_of(text))
        assert [tuple(x) for x in got[i]["found"]] == found, text
        assert [tuple(x) for x in got[i]["kept"]] == kept, text


def test_base_columns(spark):
    rows = [*texts(120, 4), *[(500, None)] * 2, (501, "CC-BY/NC cc_by_nc Cc By Nc! under the MIT licence")]
    df = spark.createDataFrame(rows, KIND).withColumn("words", F.lit(1)).withColumn("found", F.lit(2))
    got = sorted((tuple(r) for r in licenses.license_digest(licenses.scan_licenses(df)).select(
        "doc_id", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()), key=str)
    assert len(got) == len(rows)
    for (i, text), row in zip(sorted(rows, key=lambda r: str(r[0]) + ","), sorted(got, key=lambda r: str(r[0]) + ",")):
        places = base(text)
        assert row[:5] == (i, len(places), places[0][0] if places else None, places[-1][0] if places else None,
                           ",".join(sorted({x for _, x in places}))), text
        want = {x for _, x in places} | {x[4] for x in brute(text)[1]}
        assert row[5] == ",".join(sorted(want)) and 0 <= row[6] <= 1 and (row[6] > 0) == bool(want)


def test_stronger_and_longer_detections_win(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0"), (2, "GNU Lesser General Public License v2.1 or later"), (3, "cc by nc sa 4.0 license")]
    got = {r["doc_id"]: r["labels"] for r in licenses.license_digest(licenses.scan_licenses(spark.createDataFrame(rows, KIND))).collect()}
    assert got == {1: "apache-2", 2: "lgpl-2.1", 3: "cc-by-nc,cc-by-nc-sa-4"}


def test_a_long_run_of_license_lines(spark):
    text = "Licensed under CC BY-NC 4.0. " * 3000
    (row,) = licenses.license_digest(licenses.scan_licenses(spark.createDataFrame([(1, text)], KIND))).collect()
    assert (row["n_base"], row["first_word"], row["last_word"], row["n_kept"]) == (3000, 2, 2999 * 7 + 2, 3000)


def test_python_free_and_without_shuffle(spark):
    df = spark.createDataFrame([(1, "mit license")], KIND)
    plan = licenses.license_digest(licenses.scan_licenses(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "Exchange" not in plan


def test_empty_table(spark):
    assert licenses.license_digest(licenses.scan_licenses(spark.createDataFrame([], KIND))).collect() == []


def test_no_pattern_repeats_without_bound():
    for r in licenses.rules():
        assert "*" not in r["pattern"] and not re.search(r"(?<!\])\+", r["pattern"]), r["pattern"]
