"""The pipeline against plain code for each stage, and its registration."""

import struct

import __spark_entry__
import corpus_pipeline
from shelfwise.llm import pii, quality_rules, simhash
from shelfwise.llm.queries import tokenizer_file
from tests.llm.test_simhash import _components, by_definition

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "pii", "mixing", "packing"]


def test_stages(spark):
    """Every stage's rows from plain code on what the stage before kept."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = docs.collect()
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality rules"](spark, docs, SF).cache()
    kept = docs.collect()
    assert docs.columns == columns
    measures = quality_rules.measures([r.text for r in source])
    fails = ((measures.n_words < 10) | (100 * measures.n_repeat_words > 20 * measures.n_words)).tolist()
    assert not {r.doc_id for r, f in zip(source, fails) if f} & {r.doc_id for r in kept}
    plain = (measures.n_symbols == 0) & (measures.n_dup_lines == 0) & (measures.n_capitals < 0.3 * measures.n_letters)
    assert {r.doc_id for r, f, p in zip(source, fails, plain) if p and not f} <= {r.doc_id for r in kept}

    docs = stages["simhash near-dedup"](spark, docs, SF).cache()
    first = {}
    for r, c in zip(kept, _components([by_definition(r.text) for r in kept], 4)):
        first[c] = min(first.get(c, r.doc_id), r.doc_id)
    left = docs.collect()
    assert docs.columns == columns and sorted(r.doc_id for r in left) == sorted(first.values())

    docs = stages["pii"](spark, docs, SF).cache()
    clean = docs.collect()
    assert docs.columns == columns and len(clean) == len(left)
    before = {r.doc_id: r.text for r in left}
    spans = {r.doc_id: r for r in pii.find(spark.createDataFrame(left)).collect()}
    for r in clean:
        found = spans[r.doc_id]
        assert (r.text == before[r.doc_id]) == (not found.base and not found.terms) and r.n_chars == len(r.text)

    docs = stages["mixing"](spark, docs, SF).cache()
    mixed = docs.collect()
    total = sum(len(r.text.split()) for r in clean)
    assert docs.columns == columns and abs(sum(len(r.text.split()) for r in mixed) - total) <= 30

    packed = stages["packing"](spark, docs, SF).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file())
    ids = [[*tokenizer.encode(r.text, add_special_tokens=False).ids, 2] for r in mixed]
    assert sum(r.length for r in packed) == sum(map(len, ids))
    assert {(r.doc_id, r.doc_tokens) for r in packed} == {(r.doc_id, len(i)) for r, i in zip(mixed, ids)}
    assert all(struct.unpack(f"<{r.length}I", r.ids) for r in packed)


def test_run_on_an_empty_table(spark, tmp_path, make_docs):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
