"""Quality rules with verdicts on hosts.

1. Measures of a text (Python, whole texts): words, their characters, symbols,
   repeated lines, words in repeated 5-word windows, capitals.
2. Rules on the measures.  The base rules reject by themselves.  The others count
   as failures of the document.
3. Hosts: failures are summed by host (partial sums first, so a host with a third
   of all documents is one row per task).  A host's rate is shrunk towards that of
   all hosts by a beta prior whose two parameters are fitted to the hosts' rates by
   the method of moments, so a host with few documents is not judged by them alone.
4. The host's verdict goes back to its documents: a document that fails rules is
   rejected if the odds that its host's documents are junk, multiplied by what a
   failure tells, pass a limit; on a host whose shrunken rate passes ``BLOCK_RATE``
   every document is rejected.

The measures of a document are small and are written once; texts are read once by
the query.

Defined results: null texts have no words (and fail); null hosts are one host; an
empty table gives no rows; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import bound_batches, cut_lineage, free_name, words

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
#: Most words in repeated windows, in hundredths of the words.
MOST_REPEATED = 20
#: Limits of the other rules.
MOST_SYMBOLS = 0.25     # symbols for each word
MOST_DUP_LINES = 0.30   # of the lines with a word, where more than one is repeated
MOST_CAPITALS = 0.60    # of the letters, in texts of MIN_LETTERS letters
MIN_LETTERS = 40
LONGEST_MEAN = 25       # mean word length
#: How many times likelier a failed rule is in junk than in a clean text.
FAILURE_ODDS = 50.0
REJECT_ODDS = 4.0
#: At most so many hosts (some 100 bytes each) are broadcast.
BROADCAST_HOSTS = 100_000
#: A shrunken failure rate at which a host is rejected as a whole.
BLOCK_RATE = 0.80

#: Characters of texts whose words are held at a time (some 20 times as many bytes).
CHARACTERS = 1_000_000

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_letters long, n_capitals long"


def repeated_words(lists: list[list[bytes]]) -> np.ndarray:
    """For each list of words, how many stand in a window of WINDOW words that
    occurs in the list twice or more.  Exact: windows are numbered by pairing the
    numbers of shorter windows, never by a hash alone."""
    sizes = np.array([len(w) for w in lists], dtype=np.int64)
    total = int(sizes.sum())
    if total < WINDOW:
        return np.zeros(len(lists), dtype=np.int64)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for w in lists for x in w), dtype=np.int64, count=total)
    doc = np.repeat(np.arange(len(lists)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # words from here to the text's end

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].reshape(-1).astype(np.int64)

    at = np.flatnonzero(left >= WINDOW)
    if not len(at):
        return np.zeros(len(lists), dtype=np.int64)
    two = paired(ids[:-1], ids[1:])
    same = paired(paired(two[at], two[at + 2]), ids[at + 4])
    same = paired(same, doc[at])
    often = at[np.bincount(same)[same] > 1]
    covered = np.zeros(total + 1, dtype=np.int64)
    np.add.at(covered, often, 1)
    np.add.at(covered, often + WINDOW, -1)
    return np.bincount(doc, weights=np.cumsum(covered[:-1]) > 0, minlength=len(lists)).astype(np.int64)


def letters(text: str) -> tuple[int, int]:
    """Characters that have two cases, and how many of them are capitals.  Where
    a change of case changes the length, only A-Z and a-z count."""
    forms = text, text.lower(), text.upper()
    if len({len(x) for x in forms}) > 1:
        codes = np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)
        big = int(((codes >= 65) & (codes <= 90)).sum())
        return big + int(((codes >= 97) & (codes <= 122)).sum()), big
    own, low, up = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for x in forms)
    return int((low != up).sum()), int((own != low).sum())


def parts(texts: list[str], most: int = CHARACTERS) -> Iterator[list[str]]:
    """The texts in order, in lists of at most ``most`` characters or of one text."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    yield part


def measures(texts: list[str | None]) -> pd.DataFrame:
    """The measures of some texts, a row each; words are held for a part of them."""
    return pd.concat([_measures(x) for x in parts([t or "" for t in texts])], ignore_index=True)


def _measures(texts: list[str]) -> pd.DataFrame:
    lists = [words(t) for t in texts]
    rows = []
    for t, w in zip(texts, lists):
        lines = [x for x in t.split("\n") if x.strip(WHITE)]
        rows.append((len(w), len(t) - sum(map(t.count, WHITE)), sum(map(t.count, SYMBOLS)), len(lines), len(lines) - len(set(lines))))
    out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"], dtype="int64")
    out["n_repeat_words"] = repeated_words(lists)
    cased = [letters(t) for t in texts]
    out["n_letters"] = [x for x, _ in cased]
    out["n_capitals"] = [x for _, x in cased]
    return out


def measured(text: Column) -> Column:
    """The measures of a text column as a struct."""
    @pandas_udf(MEASURES)
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield measures(list(texts))
    # so marked, the planner does not run it again below a filter on its result
    return made.asNondeterministic()(text)


def _of(name: str):
    return lambda field: F.col(f"{name}.{field}")


def base_failed(name: str) -> Column:
    m = _of(name)
    return (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > MOST_REPEATED * m("n_words"))


def failures(name: str) -> Column:
    """How many of the other rules the text fails."""
    m = _of(name)
    rules = [m("n_symbols") > MOST_SYMBOLS * m("n_words"), (m("n_dup_lines") > 1) & (m("n_dup_lines") > MOST_DUP_LINES * m("n_lines")),
             (m("n_letters") >= MIN_LETTERS) & (m("n_capitals") > MOST_CAPITALS * m("n_letters")),
             m("word_chars") > LONGEST_MEAN * m("n_words")]
    return sum(r.cast("int") for r in rules)


def host_verdicts(judged: DataFrame) -> DataFrame:
    """``host, n, n_failed, rate, blocked`` from rows (host, failed).

    Method of moments over the hosts: with mean m and variance v of their rates,
    less what chance adds at their sizes, the prior has a + b = m (1 - m) / v - 1
    documents.  Few or alike hosts give a strong prior at the common mean.
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = cut_lineage(hosts)
    own = F.col("n_failed") / F.col("n")
    whole = hosts.agg(F.sum("n").alias("docs"), F.sum("n_failed").alias("bad"), F.avg(own).alias("mean_rate"),
                      F.var_pop(own).alias("spread"), F.avg(1 / F.col("n")).alias("inverse"))
    m = F.least(F.greatest(F.col("bad") / F.col("docs"), F.lit(1e-6)), F.lit(1 - 1e-6))
    real = F.greatest(F.col("spread") - m * (1 - m) * F.col("inverse"), F.lit(1e-6))
    whole = whole.select(m.alias("m"), F.least(F.greatest(m * (1 - m) / real - 1, F.lit(2.0)), F.lit(1e6)).alias("strength"))
    prior = whole.first()  # two numbers
    mean, strength = (prior["m"], prior["strength"]) if prior["m"] is not None else (0.5, 2.0)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("blocked", rate >= BLOCK_RATE)


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", write_measures: bool = False,
          keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) with a struct ``verdict``:
    the measures, ``base_failed``, ``failures``, ``host_rate``, ``kept``.

    ``write_measures`` writes the rows to the checkpoint folder once: right where
    ``keep`` is narrow.  Otherwise the texts are measured twice (once for the
    hosts, once for the rows), which at scale is cheaper than writing them.
    """
    bound_batches(docs.sparkSession)
    cols = keep if keep is not None else docs.columns
    m, h = free_name("measures", docs.columns), free_name("host", docs.columns)
    rows = docs.select(*[f"`{c}`" for c in cols], F.coalesce(F.col(f"`{host_col}`"), F.lit("")).alias(h),
                       F.col(f"`{host_col}`").isNull().alias(h + "less"), measured(F.col(f"`{text_col}`")).alias(m))
    if write_measures:
        rows = cut_lineage(rows)
    failed = base_failed(m) | (failures(m) > 0)
    hosts = host_verdicts(rows.select(F.struct(h, h + "less").alias("host"), failed.alias("failed")))
    own, n = free_name("verdict_of_host", rows.columns), free_name("failed_rules", rows.columns)
    small = hosts.count() <= BROADCAST_HOSTS  # a written table of one row a host
    hosts = hosts.select(F.struct("host", "rate", "blocked").alias(own))
    # few hosts go to the rows, so that texts are not shuffled by host; else a skewed join, in which
    # adaptive execution splits a hot host's rows and the other side has one row for it
    hosts = F.broadcast(hosts) if small else hosts
    met = rows.withColumn(n, failures(m)).join(
        hosts, (F.col(h) == F.col(f"{own}.host.{h}")) & (F.col(h + "less") == F.col(f"{own}.host.{h}less")))
    rate = F.col(f"{own}.rate")
    odds = rate / (1 - rate) * F.pow(F.lit(FAILURE_ODDS), F.col(n))
    fine = ~(base_failed(m) | F.col(f"{own}.blocked") | ((F.col(n) > 0) & (odds >= REJECT_ODDS)))
    fields = [F.col(f"{m}.{f.split()[0]}") for f in MEASURES.split(", ")]
    verdict = F.struct(*fields, base_failed(m).alias("base_failed"), F.col(n).alias("failures"),
                       rate.alias("host_rate"), fine.alias("kept"))
    return met.select(*[f"`{c}`" for c in cols], verdict.alias(free_name("verdict", cols)))


def clean_documents(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    judged = judge(docs, host_col, text_col)
    return judged.where(F.col(f"`{judged.columns[-1]}`.kept")).select(*[f"`{c}`" for c in docs.columns])
