"""License scans: ordered signature rules over a text's words.

A rule is a regular expression over the text's lower-case words, joined by single
spaces; it stands at word borders.  Rules are made from families (what a license is
called) and forms (how a text speaks of it), and there are fixed sentences of well
known license texts.  A rule has

* a keyword: the rule is tried only in texts that hold it, and rules at all only in
  texts that pass one cheap pattern over the raw text (``GATE``);
* a priority (0 is the strongest) and a confidence;
* a label, to which the version that the rule reads is added ("gpl-3").

Overlapping detections are resolved by priority and containment.  A detection goes
if another of the same or a stronger priority contains it (of the same priority and
place, the rule that stands first stays), or if one of a strictly stronger priority
lies inside it.  Detections that overlap without containment both stay.

The phrases of ``BASE`` are rules like the others; all their places are reported
besides, whatever the resolution does.

DataFrame functions only, and no shuffle: a text's detections are arrays in its own
row.  Running sums and maxima over an array go through it in chunks (``scan``), so a
text that is one long run of license lines takes linear time.  Every pattern has
bounded repeats only.

Defined results: a null text is empty (no words, no detections, score 0); very long
texts are scanned whole; ties are resolved by the order of the rules; repeated rows
and null ids give a row each; columns of the table other than the id and the text are
not read, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import blank_if_null, scan, with_value

#: Characters between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of the text as it is.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases whose places are always reported, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, what the license is called, keywords of which every such name holds one.
FAMILIES = (
    ("mit", "mit|expat|x11", ("mit", "expat", "x11")),
    ("apache", "apache(?: software)?", ("apache",)),
    ("gpl", "(?:gnu )?(?:gpl|general public licen[cs]e)", ("gpl", "general public")),
    ("lgpl", "(?:gnu )?(?:lgpl|lesser general public licen[cs]e|library general public licen[cs]e)", ("lgpl", "lesser general", "library general")),
    ("agpl", "(?:gnu )?(?:agpl|affero general public licen[cs]e|affero gpl)", ("agpl", "affero")),
    ("gfdl", "(?:gnu )?(?:gfdl|free documentation licen[cs]e)", ("gfdl", "free documentation")),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", ("bsd",)),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", ("bsd",)),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", ("bsd",)),
    ("0bsd", "(?:0bsd|zero clause bsd|free public)", ("0bsd", "zero clause", "free public")),
    ("bsd", "bsd(?: style)?", ("bsd",)),
    ("mpl", "(?:mpl|mozilla(?: public)?)", ("mpl", "mozilla")),
    ("epl", "(?:epl|eclipse(?: public)?)", ("epl", "eclipse")),
    ("edl", "(?:edl|eclipse distribution)", ("edl", "eclipse")),
    ("cddl", "(?:cddl|common development and distribution)", ("cddl", "common development")),
    ("cpl", "(?:cpl|common public)", ("cpl", "common public")),
    ("eupl", "(?:eupl|european union public)", ("eupl", "european union")),
    ("isc", "isc", ("isc",)),
    ("zlib", "(?:zlib|zlib libpng)", ("zlib",)),
    ("libpng", "libpng", ("libpng",)),
    ("bsl", "(?:bsl|boost(?: software)?)", ("bsl", "boost")),
    ("busl", "(?:busl|business source)", ("busl", "business source")),
    ("artistic", "(?:perl )?artistic", ("artistic",)),
    ("python", "(?:psf|python(?: software foundation)?)", ("psf", "python")),
    ("php", "php", ("php",)),
    ("ruby", "ruby", ("ruby",)),
    ("postgresql", "(?:postgresql|postgres)", ("postgres",)),
    ("openssl", "openssl", ("openssl",)),
    ("openldap", "openldap(?: public)?", ("openldap",)),
    ("ofl", "(?:ofl|(?:sil )?open font)", ("ofl", "open font")),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("unlicense", "unlicense", ("unlicense",)),
    ("ms-pl", "(?:ms pl|microsoft public)", ("ms pl", "microsoft public")),
    ("ms-rl", "(?:ms rl|microsoft reciprocal)", ("ms rl", "microsoft reciprocal")),
    ("ncsa", "(?:ncsa|university of illinois ncsa)", ("ncsa",)),
    ("afl", "(?:afl|academic free)", ("afl", "academic free")),
    ("osl", "(?:osl|open software)", ("osl", "open software")),
    ("odbl", "(?:odbl|open database)", ("odbl", "open database")),
    ("odc-by", "(?:odc by|open data commons attribution)", ("odc by", "open data")),
    ("pddl", "(?:pddl|public domain dedication and)", ("pddl", "public domain")),
    ("sspl", "(?:sspl|server side public)", ("sspl", "server side")),
    ("elastic", "elastic", ("elastic",)),
    ("upl", "(?:upl|universal permissive)", ("upl", "universal permissive")),
    ("cecill", "cecill", ("cecill",)),
    ("cc0", "(?:cc0|cc zero|creative commons zero)", ("cc0", "cc zero", "commons zero")),
    ("cc-by", "(?:cc by|creative commons attribution)", ("cc by", "commons attribution")),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", ("cc by", "commons attribution")),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)", ("cc by", "commons attribution")),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", ("cc by", "commons attribution")),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", ("cc by", "commons attribution")),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)", ("cc by", "commons attribution")),
)

_L = "licen[cs]es?"
#: A version: its first number is group 1, the second, after a point, group 2.
_V = "(?:(?: version| v| )? ?v?([1-9])(?: ([0-9]))?(?: or (?:any )?later(?: version)?)?)"
_INTL = "(?: international| unported| generic)?"

#: Priority, pattern of a family N, keyword besides the family's, confidence.
FORMS = (
    (0, f"spdx license identifier {{N}}{_V}?", "spdx", 1.0),
    (1, f"(?:sub|re|dual )?licensed under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{{N}}(?: {_L})?{_V}?{_INTL}", "licensed", 0.95),
    (1, f"(?:released|distributed|provided|published|available|covered|offered|shared) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{{N}} {_L}{_V}?", "under", 0.9),
    (1, f"subject to (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{{N}} {_L}{_V}?", "subject", 0.9),
    (2, f"under (?:the )?(?:terms of (?:the )?)?{{N}} {_L}{_V}?", "under", 0.85),
    (2, f"(?:opensource org|spdx org|choosealicense com|gnu org) {_L} {{N}}{_V}?", "licen", 0.85),
    (2, f"{{N}}(?: public| free| software)? {_L}{_V}?{_INTL}", "licen", 0.8),
    (2, f"{_L}(?: type| name| is)?(?: the)? {{N}}{_V}?", "licen", 0.7),
    (3, f"{{N}}{_V}{_INTL}", "", 0.5),
)

#: Priority, pattern, keyword, label, confidence.
SENTENCES = (
    (0, "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted", "mit", 1.0),
    (0, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby granted", "isc", 1.0),
    (0, "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", "bsd", 0.95),
    (0, "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used", "neither the name", "bsd-3-clause", 0.95),
    (0, "all advertising materials mentioning features or use of this software", "advertising materials", "bsd-4-clause", 0.95),
    (0, "unless required by applicable law or agreed to in writing software distributed under the license", "required by applicable", "apache-2", 1.0),
    (0, "you may obtain a copy of the license at https? www apache org licenses license 2 0", "apache", "apache-2", 1.0),
    (0, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute", "gpl", 1.0),
    (0, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute", "lgpl", 1.0),
    (0, "this source code form is subject to the terms of the mozilla public license", "mozilla", "mpl", 1.0),
    (0, "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty", "zlib", 0.9),
    (0, "this is free and unencumbered software released into the public domain", "unencumbered", "unlicense", 1.0),
    (0, "boost software license version 1 0", "boost", "bsl-1", 1.0),
    (0, "do what the fuck you want to public license", "you want to public", "wtfpl", 1.0),
    (1, "to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright", "waived", "cc0", 0.95),
    (1, "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain", "public domain", "public-domain", 0.9),
    (2, "(?:in the|a) public domain(?: work| text| image)?", "public domain", "public-domain", 0.4),
    (2, "all rights reserved", "rights reserved", "all-rights-reserved", 0.7),
    (2, "(?:proprietary|confidential) and (?:proprietary|confidential)", "proprietary", "proprietary", 0.6),
    (2, "without (?:the )?(?:prior )?written permission of", "written permission", "permission-required", 0.5),
    (3, "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright", "copyright-notice", 0.4),
    (3, "for non ?commercial (?:use|purposes) only", "commercial", "non-commercial", 0.5),
    (3, f"(?:sub|re)?licensed under (?:the )?(?:[^ ]+ ){{1,4}}{_L}", "licensed", "other-license", 0.3),
    (4, f"(?:terms of (?:the|this) {_L}|{_L} agreement|end user {_L})", "licen", "license-mention", 0.2),
)
PRIORITIES = 5
BASE_CONFIDENCE = 0.9

#: What a text must hold for any rule to be tried; ASCII letters of any case.
GATE = r"(?i)licen[cs]|copyright|spdx|gpl|unencumbered|hereby|warrant|redistribut|public[^A-Za-z0-9]+domain|rights[^A-Za-z0-9]+reserved|written[^A-Za-z0-9]+permission|proprietary|(?<![A-Za-z0-9])cc(?![A-Za-z0-9])"

RULE = "array<struct<place:int,pattern:string,keywords:array<string>,besides:string,priority:int,label:string,confidence:double,base:boolean>>"
DETECTION = "struct<start:int,less_end:int,priority:int,place:int,label:string,confidence:double,base:boolean>"

@cache
def rules() -> tuple[dict, ...]:
    """All rules, in order: base phrases, sentences, then every form of every family."""
    made = [(3, phrase, [" ".join(phrase.split()[:2])], "", label, BASE_CONFIDENCE, True) for phrase, label in BASE.items()]
    made += [(n, p, [k], "", label, c, False) for n, p, k, label, c in SENTENCES]
    made += [(n, form.replace("{N}", f"(?:{name})"), list(own), k, label, c, False)
             for n, form, k, c in FORMS for label, name, own in FAMILIES]
    return tuple({"place": i, "pattern": f"(?<![^ ])(?:{p})(?![^ ])" + ("" if "([1-9])" in p else "()()"), "keywords": k, "besides": also,
                  "priority": n, "label": label, "confidence": c, "base": b} for i, (n, p, k, also, label, c, b) in enumerate(made))


def normalised(text: Column) -> Column:
    """The text's words in lower case, each between single spaces."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, BETWEEN, " ")), F.lit(" "))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _version(hit: Column, pattern: Column) -> Column:
    major, minor = (F.call_function("regexp_extract", hit, pattern, F.lit(i)) for i in (1, 2))
    return F.concat(F.when(major != "", F.concat(F.lit("-"), major)).otherwise(""),
                    F.when(~minor.isin("", "0"), F.concat(F.lit("."), minor)).otherwise(""))


def _of_rule(words: Column, rule: Column) -> Column:
    """A rule's detections, by place."""
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(words, rule["pattern"], -1), F.lit(1), F.size(hits))
        pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(_spaces(g).alias("gap"), _spaces(h).alias("inner"), h.alias("hit")))
        return scan(pairs, F.lit(-1), lambda s, x: s + x["gap"] + x["inner"], lambda s, x: F.struct(
            (s + x["gap"]).alias("start"), (-(s + x["gap"] + x["inner"] + 1)).alias("less_end"), rule["priority"].alias("priority"),
            rule["place"].alias("place"), F.concat(rule["label"], _version(x["hit"], rule["pattern"])).alias("label"),
            rule["confidence"].alias("confidence"), rule["base"].alias("base")), DETECTION)

    return with_value(hits, lambda h: F.when(F.size(h) > 0, placed(h)).otherwise(F.array().cast(f"array<{DETECTION}>")))


def detections(words: Column) -> Column:
    """What all rules find in normalised words, in order of place, longest first."""
    every = F.from_json(F.lit(json.dumps(rules())), RULE)
    named = sorted({k for r in rules() for k in (*r["keywords"], r["besides"])})
    keywords = F.from_json(F.lit(json.dumps(named)), "array<string>")

    def tried(present: Column) -> Column:
        return F.transform(F.filter(every, lambda r: F.array_contains(present, r["besides"]) & F.arrays_overlap(present, r["keywords"])), lambda r: _of_rule(words, r))

    return F.array_sort(F.flatten(with_value(F.filter(keywords, lambda k: F.contains(words, k)), tried)))


def resolved(found: Column) -> Column:
    """The detections that stay; ``found`` is sorted as ``detections`` sorts."""
    # furthest end (forwards) and nearest end (backwards) so far, by priority
    def reached(better: Callable, limit: int) -> tuple[Column, Callable]:
        zero = F.array(*[F.lit(limit)] * PRIORITIES)
        return zero, lambda s, x: F.transform(s, lambda v, p: F.when(p == x["priority"], better(v, -x["less_end"])).otherwise(v))

    zero, step = reached(F.greatest, -1)
    outer = scan(found, zero, step, lambda s, x: F.array_max(F.slice(s, F.lit(1), x["priority"] + 1)) >= -x["less_end"], "boolean")
    zero, step = reached(F.least, 2**31 - 1)
    inner = scan(F.reverse(found), zero, step, lambda s, x: F.coalesce(
        F.array_min(F.slice(s, F.lit(1), x["priority"])) <= -x["less_end"], F.lit(False)), "boolean")
    marked = F.arrays_zip(found.alias("d"), outer.alias("outer"), F.reverse(inner).alias("inner"))
    return F.transform(F.filter(marked, lambda m: ~m["outer"] & ~m["inner"]), lambda m: m["d"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, found, kept``: every detection of a document and those
    that the resolution leaves, as arrays of (start, less_end, priority, place,
    label, confidence, base); words from ``start`` to before ``-less_end``."""
    text = blank_if_null(f"`{text_col}`")
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
                      F.when(text.rlike(GATE), normalised(text)).alias("words"))
    none = F.array().cast(f"array<{DETECTION}>")
    out = out.select("doc_id", "n_words", F.when(F.col("words").isNotNull(), detections(F.col("words"))).otherwise(none).alias("found"))
    return out.withColumn("kept", F.when(F.size("found") > 0, resolved(F.col("found"))).otherwise(none))


def license_digest(scanned: DataFrame) -> DataFrame:
    """The digest columns of the contract from the rows of ``scan_licenses``."""
    base = F.filter("found", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])
    names = lambda c: F.transform(c, lambda d: d["label"])
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    sure = F.coalesce(F.array_max(F.transform(F.concat("kept", base), lambda d: d["confidence"])), F.lit(0.0))
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                          F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                          listed(names(base)).alias("base_labels"), listed(F.concat(names(base), names(F.col("kept")))).alias("labels"),
                          sure.alias("score"), F.size("kept").cast("long").alias("n_kept"))
