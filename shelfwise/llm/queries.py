"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.llm import (conversations, hard_negatives, html_extraction, licenses, mixing, nn_descent, packing, pii,
                           quality_classifier, quality_rules, simhash, toxicity, warc)
from shelfwise.llm.common import bound_batches
from shelfwise.sources.fixtures import table

QUERIES = {}
ORACLE_SQL = {"op4_mixing": mixing.ORACLE}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_mixing(spark, sf_dir):
    return mixing.mix_totals(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op9_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), write_measures=True, keep=["doc_id", "source"])
    v = [F.col(f"verdict.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "kept", "failures", "host_rate")]
    return judged.select("doc_id", *v)


def tokenizer_file() -> str:
    """The public tokenizer that the packing query is fixed to."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)


@query
def op3_pii(spark, sf_dir):
    return pii.span_digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op5_warc(spark, sf_dir):
    folder = warc.new_folder(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.read_urls(pages, warc.archive(pages, folder), folder).drop("url")


ORACLE_SQL["op5_warc"] = warc.ORACLE


@query
def op8_quality_classifier(spark, sf_dir):
    return quality_classifier.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_html(spark, sf_dir):
    bound_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extraction.main_text(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_nn_descent(spark, sf_dir):
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_hard_negatives(spark, sf_dir):
    rows = hard_negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


ORACLE_SQL["op11_hard_negatives"] = hard_negatives.ORACLE


@query
def op12_licenses(spark, sf_dir):
    return licenses.license_digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query
def op13_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_all(rows, conversations.damaged(rows))
