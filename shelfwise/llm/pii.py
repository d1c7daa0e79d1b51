"""Personal data: patterns, and terms that disclose what the patterns protect.

Patterns find e-mail addresses, IP addresses, card and telephone numbers with
their places.  A protected entity is such a value, or what it belongs to: an address's
domain, an IP's subnet of 256, the first six digits of a number.  A term is any word.
What a reader of term t learns about entity c is

    PMI(t; c) = ln( p(c | t) / p(c) ),   of   IC(c) = -ln p(c)

that there is to know.  Few texts prove little, so p(c | t) is the lower end of its
confidence interval (Wilson, ``Z`` standard errors): k of the n documents with t hold c,
and the evidence is the number of different texts that hold both, as copies of one text
prove nothing.  A term is generalised if it leaves at most ``GENERALISE`` bits of c
unknown, removed if it leaves at most ``REMOVE`` bits.  A term that always stands beside
c is generalised from three texts on, removed from six on.  Told terms are treated in
all documents, whether they hold the entity or not.

DataFrame functions only.  Places come from split (the stretches between matches)
and regexp_extract_all (the matches) by a running sum within the row.  A pair that
passes has at least ``least_texts`` texts, so entities and terms of fewer are left out
beforehand, and terms with more documents than the share allows.  Entities that stand
in the same texts are one class, and so are terms; pairs are formed of classes, so a
list of ten thousand addresses in three texts is one row for each of them.

The patterns are those of the contract with possessive repeats, and with starts
inside a run of characters barred that could only repeat a failure; both keep the
matches and take linear time and no stack on long runs.

Defined results: null texts have no spans and stay null; empty texts stay empty; very
long texts are searched whole; a term told for several entities is removed if one of
them says so; repeated rows are treated alike; null ids are ids like others; columns
of the table may have any names; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import blank_if_null, cut_lineage, free_name, row_key, scan, with_value

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth a search.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = r"[\p{L}\p{M}\p{N}]++"
TERM_KIND = "term"
#: Bits about an entity that a term may leave unknown to be generalised, or removed.
GENERALISE = 1.0
REMOVE = 0.5
#: Standard errors of the lower end of p(entity | term).
Z = 1.5
#: Digits of a number that name whom it belongs to.
PREFIX = 6
#: A written table of at most so many terms, or documents' lists of told terms, goes to
#: every task, so that the documents' words and texts are not shuffled; a larger one
#: is joined.
BROADCAST_ROWS = 200_000


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(hit)).between(13, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, hit: Column) -> Column:
    """One spelling for a value."""
    same = {"email": F.lower, "ip": lambda h: h, "card": _digits, "phone": _digits}[kind](hit)
    return F.concat(F.lit(kind + ":"), same)


SPAN = "array<struct<kind:string,start:int,end:int,entity:string>>"


def _spans(text: Column, kind: str) -> Column:
    """The valid matches of a kind with their places, in code points."""
    pattern = F.lit(PATTERNS[kind])
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    # a match follows the stretch of the same number; the stretch after the last match is left out
    lengths = F.zip_with(F.slice(between, F.lit(1), F.size(hits)), hits,
                         lambda b, h: F.struct(F.length(b).alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))
    placed = F.aggregate(lengths, start, lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + F.length(x["hit"])).alias("at"),
        F.when(_valid(kind, x["hit"]), F.concat(acc["found"], F.array(F.struct(
            F.lit(kind).alias("kind"), (acc["at"] + x["gap"]).alias("start"),
            (acc["at"] + x["gap"] + F.length(x["hit"])).alias("end"), _entity(kind, x["hit"]).alias("entity")))))
        .otherwise(acc["found"]).alias("found")))
    return F.when(text.rlike(HINTS[kind]), placed["found"]).otherwise(F.array().cast(SPAN))


def base_spans(text: Column | str) -> Column:
    """All pattern spans of a text, by kind, then place."""
    c = blank_if_null(text)
    return F.concat(*[_spans(c, k) for k in KINDS])


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _wider(entity: Column) -> Column:
    """What an entity belongs to."""
    kind, value = F.substring_index(entity, ":", 1), F.substring(entity, F.instr(entity, ":") + 1, F.length(entity))
    return F.when(kind == "email", F.concat(F.lit("domain:"), F.substring_index(value, "@", -1))).when(
        kind == "ip", F.concat(F.lit("subnet:"), F.substring_index(value, ".", 3))).otherwise(
        F.concat(kind, F.lit("-prefix:"), F.substring(value, 1, PREFIX)))


def entities(base: Column) -> Column:
    """The protected entities of a row's spans, each once."""
    own = F.transform(base, lambda s: s["entity"])
    return F.array_distinct(F.concat(own, F.transform(own, _wider)))


def least_texts(bits: float, z: float = Z) -> int:
    """The fewest texts from which a term may leave so few bits unknown."""
    return max(1, math.ceil(z * z / (2.0**bits - 1) - 1e-9)) if bits > 0 else 1 << 31


def wilson(k: Column, n: Column, evidence: Column, z: float = Z) -> Column:
    """The lower end of the confidence interval of k / n, known from ``evidence`` cases."""
    p, m = (k / n).cast("double"), evidence.cast("double")
    half = z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))
    return (p + z * z / (2 * m) - half) / (1 + z * z / m)


def _if_small(written: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def _terms(text: Column) -> Column:
    """A text's terms, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _outside(text: Column, base: Column) -> Column:
    """The text with base spans replaced by spaces."""
    ordered = F.array_sort(F.transform(base, lambda s: F.struct(s["start"], s["end"])))
    parts = scan(ordered, F.lit(0), lambda at, s: F.greatest(at, s["end"]),
                 lambda at, s: F.substring(text, at + 1, F.greatest(F.lit(0), s["start"] - at)), "string")
    last = F.array_max(F.transform(base, lambda s: s["end"]))
    return F.concat(F.array_join(parts, " "), F.lit(" "), F.substring(text, last + 1, F.length(text)))


def document_terms(docs: DataFrame, text_col: str, among: DataFrame) -> DataFrame:
    """``term, n``: the number of documents that hold each term of ``among``, a
    written table."""
    terms = docs.select(F.explode(_terms(F.col(f"`{text_col}`"))).alias("term"))
    return terms.join(_if_small(among.select("term")), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _classes(held: DataFrame, key: str, *also: str) -> DataFrame:
    """``held`` (key, text_key, copies) with ``texts`` and ``docs`` of every key and a
    ``cls`` that keys in the same texts share (and of equal ``also``)."""
    sums = held.groupBy(key, *also).agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("docs"), F.bit_xor("text_key").alias("_x"),
                                        F.sum(F.xxhash64("text_key").bitwiseAND(F.lit(0xFFFFFFFFFF))).alias("_s"))
    return sums.withColumn("cls", F.md5(F.concat_ws(":", "texts", "docs", "_x", "_s", *also))).drop("_x", "_s")


def disclosing_terms(dirty: DataFrame, docs: DataFrame, text_col: str = "text", generalise: float = GENERALISE,
                     remove: float = REMOVE, z: float = Z) -> DataFrame:
    """``term, removed``: the terms that disclose an entity.  ``dirty`` (text, base): the
    documents with base spans; ``docs`` is the whole corpus."""
    bits = max(generalise, remove)
    least = least_texts(bits, z)
    alike = dirty.groupBy(F.xxhash64("text").alias("text_key")).agg(
        F.count(F.lit(1)).alias("copies"), F.first(F.struct("text", "base")).alias("one"))
    alike = cut_lineage(alike.select("text_key", "copies", entities(F.col("one.base")).alias("entities"),
                                     _terms(_outside(F.col("one.text"), F.col("one.base"))).alias("terms")))
    held = alike.select("text_key", "copies", F.explode("entities").alias("entity"))
    known = _classes(held, "entity").where(F.col("texts") >= least).select("entity", "cls", F.col("docs").alias("n_entity"))
    met = held.join(known, "entity").select("cls", "n_entity", "text_key", "copies").distinct()
    met = cut_lineage(met.withColumnRenamed("cls", "e_cls"))
    # terms of texts with such entities, in enough of them; those in more documents than
    # the share allows tell no entity
    some = alike.join(met.select("text_key").distinct(), "text_key", "left_semi")
    said = some.select("text_key", "copies", F.explode("terms").alias("term"))
    often = said.groupBy("term").agg(F.count(F.lit(1)).alias("m"), F.sum("copies").alias("d")).where(F.col("m") >= least)
    often = cut_lineage(often)
    counts = document_terms(docs, text_col, often).join(often, "term").where(F.col("n") <= F.col("d") * 2.0**bits).select("term", "n")
    counts = cut_lineage(counts)
    classed = _classes(said.join(counts, "term"), "term", "n").select("term", F.col("cls").alias("t_cls"), "n")
    classed = cut_lineage(classed)
    spoken = said.join(classed, "term").select("t_cls", "n", "text_key").distinct()
    pairs = met.join(spoken, "text_key").where(F.col("n") <= F.col("n_entity") * 2.0**bits)
    pairs = pairs.groupBy("e_cls", "t_cls", "n").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("k"))
    left = -F.log2(wilson(F.col("k"), F.col("n"), F.col("texts"), z))  # IC - PMI, in bits
    told = pairs.where(left <= bits).groupBy("t_cls", "n").agg(F.max(left <= remove).alias("removed"))
    return classed.join(told, ["t_cls", "n"]).select("term", "removed")


def _places(text: Column) -> Column:
    """Every term of a text with its place."""
    hits = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, TERM, -1), F.lit(1), F.size(hits))
        pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
        return scan(pairs, F.lit(0), lambda at, x: at + x["gap"] + F.length(x["hit"]), lambda at, x: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["hit"])).alias("end"), F.lower(x["hit"]).alias("term")),
            "struct<start:int,end:int,term:string>")

    return with_value(hits, placed)


def _told_spans(text: Column, base: Column, told: Column) -> Column:
    """The places of the told terms (term, removed) of a row outside base spans."""
    def found(told: Column) -> Column:
        those = F.filter(_places(text), lambda w: F.map_contains_key(told, w["term"]))
        free = F.filter(those, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
        return F.transform(free, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), told[w["term"]].alias("removed")))

    return with_value(F.map_from_entries(told), found)


def redacted(text: Column, base: Column, terms: Column) -> Column:
    """The text with base spans replaced by their kind, terms by a class or
    nothing.  Where spans overlap, what they cover together is replaced once."""
    marks = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["removed"], "").otherwise("[TERM]").alias("by"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.array_sort(marks), start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["by"]))
        .otherwise(acc["out"]).alias("out")))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


TERM_SPANS = "array<struct<start:int,end:int,removed:boolean>>"


def find(docs: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """The rows of ``docs`` with ``base`` and ``terms`` (names are changed where
    ``docs`` has them): the spans of patterns and of disclosing terms."""
    base, terms = free_name("base", docs.columns), free_name("terms", docs.columns)
    own, key, told_col = (free_name(n, docs.columns) for n in ("_doc", "_told_doc", "_told"))
    text = F.col(f"`{text_col}`")
    # documents with personal data only
    dirty = cut_lineage(docs.select(text.alias("text"), base_spans(f"`{text_col}`").alias("base")).where(F.size("base") > 0))
    told = cut_lineage(disclosing_terms(dirty, docs, text_col, **thresholds))
    keyed = docs.withColumn(own, row_key(docs))
    # the told terms that each document holds; rows alike share a key
    holds = keyed.select(F.col(own).alias(key), F.explode(_terms(text)).alias("term")).join(_if_small(told), "term")
    holds = cut_lineage(holds.groupBy(key).agg(F.collect_set(F.struct("term", "removed")).alias(told_col)))
    met = keyed.join(_if_small(holds), F.col(own) == F.col(key), "left")
    spanned = met.withColumn(base, base_spans(f"`{text_col}`"))
    spanned = spanned.withColumn(terms, F.when(F.col(told_col).isNull(), F.array().cast(TERM_SPANS)).otherwise(
        _told_spans(text, F.col(base), F.col(told_col))))
    return spanned.select(*[f"`{c}`" for c in docs.columns], base, terms)


def sanitised_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = None, **thresholds) -> DataFrame:
    """``docs`` with personal data and disclosing terms taken out of the texts.
    ``length_col``, if given, is set to the text's code points."""
    found = find(docs, text_col, **thresholds)
    base, terms = found.columns[-2:]
    text = F.col(f"`{text_col}`")
    out = found.withColumn(text_col, F.when(F.size(base) + F.size(terms) == 0, text).otherwise(
        redacted(text, F.col(base), F.col(terms))))
    if length_col:
        out = out.withColumn(length_col, F.length(f"`{text_col}`").cast(docs.schema[length_col].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the contract from the rows of ``find``."""
    base, terms = found.columns[-2:]
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    listed = F.concat(F.col(base), F.transform(terms, lambda s: F.struct(
        F.lit(TERM_KIND).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("").alias("entity"))))
    return found.select(F.col(f"`{id_col}`").alias("doc_id"), *[count(k) for k in KINDS],
                        F.sha2(span_text(F.col(base)), 256).alias("base_sha256"), span_text(listed).alias("spans"))
