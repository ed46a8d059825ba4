"""Rows that share an id, or have none, in the stages that drop documents."""

from conftest import SF_DIR

import corpus_pipeline
from listingflow.llm.pii import find_spans, redact


def test_rows_are_dropped_one_by_one(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(30))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (None, text("a")), (None, text("c")), (None, text("c"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("false").collect() + [docs.collect()[k] for k in (0, 2, 4)]))
    leak = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    rows = [(1, leak), (1, text("a")), (None, leak), (None, text("b"))]
    left = corpus_pipeline.drop_leaks(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_DIR)
    assert {tuple(r) for r in left.collect()} == {rows[1], rows[3]}


def test_names_that_clash_stay(spark):
    names = ["_key", "_found", "_kept", "_leak", "_id", "_text", "_parts", "_p_ip", "_N_IP", "kind", "features", "labelled", "node"]
    rows = [(k, " ".join(f"word{k}x{j}" for j in range(9)) + " ip 10.0.0.1", *range(len(names))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    docs = docs.selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars")
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    want = sorted(map(tuple, docs.select(*others).collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_DIR)
        assert got.columns == docs.columns and sorted(map(tuple, got.select(*others).collect())) == want, name
    assert corpus_pipeline.encode(spark, docs, SF_DIR).count() == 3
    assert sorted(map(tuple, find_spans(docs).select(*others).collect())) == want
    assert {r.text.split()[-1] for r in redact(docs).collect()} == {"<ip>"}
