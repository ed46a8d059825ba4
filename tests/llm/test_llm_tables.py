"""Operators on vectors, conversations, urls, benchmark passages, and the pipeline."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_DIR, plan_of
from odd_rows import no_docs, odd_docs  # noqa: F401

import __spark_entry__
import corpus_pipeline
from listingflow.llm import queries as llm
from listingflow.llm.chats import maximal_conversations
from listingflow.llm.components import components
from listingflow.llm.decontaminate import contaminated
from listingflow.llm.projections import near_vectors
from listingflow.llm.urls import judge


def test_components(spark):
    draw = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((40, 16))
    vectors = [c + 0.12 * draw.standard_normal(16) for c in centres for _ in range(12)]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(900 + k, vectors[0].tolist()) for k in range(3)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [math.nan] + [1.0] * 15), (1004, [None] + [1.0] * 15)]
    rows += [(1005, [math.inf] * 16), (1006, [1.0, 2.0]), (1006, [1.0, 2.0]), (None, [5.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as unit")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors(frame).collect()), key=str)
    units = {k: np.array(v) / np.linalg.norm(v) for k, v in rows[: len(vectors) + 3]}
    near = {a: [b for b in units if a != b and units[a] @ units[b] >= 0.9] for a in units}
    assert sum(map(len, near.values())) > 1000
    by_id = {g[0]: g for g in got if g[0] != 1006}
    found = sum(by_id[k][1] for k in near)
    assert found >= 0.99 * sum(map(len, near.values())) and all(by_id[k][1] <= len(near[k]) for k in near)
    assert all(by_id[k] == (k, 0, k) for k in range(1000, 1006))
    assert [g for g in got if g[0] == 1006] == [(1006, 1, 1006)] * 2
    assert near_vectors(frame.where("false")).count() == 0


def test_conversations_agree_with_sql(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "more"), (4, 0, "user", "hi"), (4, 1, "assistant", "hello"),
        (4, 2, "user", "more"), (5, 0, None, None), (5, 0, None, None), (5, 1, "user", ""), (6, 0, "user", ""), (7, 0, None, None),
        (8, 3, "user", "b"), (8, 3, "user", "a"), (9, None, "user", "x" * 50000),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as at", "2 as h1")
    result = maximal_conversations(frame)
    assert "Python" not in plan_of(result)
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in result.collect()}
    assert got == {3: (3, 2), 5: (2, 1), 6: (1, 1), 8: (2, 1), 9: (1, 1)}
    chats = {r.conv_id: r.chat for r in result.collect()}
    assert chats[5] == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert maximal_conversations(frame.where("false")).count() == 0


def test_registered_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    for name, sql in llm.SQL.items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        own = llm.QUERIES[name](spark, SF_DIR).select(*columns)
        assert Counter(map(tuple, own.collect())) == Counter(want.fetchall()), name


def test_urls(spark):
    rows = [
        (1, "http://A.Example.ORG/es/1?x#y"), (2, "https://example.org/en/12"), (3, "https://example.org/fr/12"),
        (4, "http://x.com/fr/a"), (5, "http://x.com/de/a"), (6, None), (7, "no scheme"), (8, "http://notorg/x"),
        (9, "http://myexample.org/es/"), (10, "a://b://c/d"), (11, "http://x.com?q=/fr/"), (11, "http://x.com?q=/fr/"),
        (None, "http://x.com/" + "y/" * 5000), (12, ""),
    ]
    rows += [(100 + k, f"http://bad.net/de/{k}") for k in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as purity")
    result = judge(frame)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in result.collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6][:3] == got[7][:3] == got[12][:3] == ("", "", None)
    assert got[8][2] is None and got[9][2] == "org/" and got[10][:2] == ("b:", "//c/d") and got[11][:3] == ("x.com", "", None)
    assert result.count() == len(rows) and {r.verdict for r in result.collect()} == {"allow", "block"}
    assert judge(frame.where("false")).count() == 0


def test_impure_templates_are_blocked(spark):
    rows = [(k, f"http://h.com/{'de' if k % 9 else 'fr'}/{k}") for k in range(90)] + [(900, "http://h.com/it/5")]
    rows += [(1000 + k, f"http://g.com/fr/{k}") for k in range(90)] + [(1900, "http://g.com/it/5")]
    got = {r.page_id: r.verdict for r in judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[900] == "block" and got[1900] == "allow"


def test_contaminated(spark, odd_docs, no_docs):
    draw = np.random.default_rng(8)
    word = lambda: "".join(draw.choice(list("abcdefgh"), 6))
    item = [[word() for _ in range(n)] for n in (40, 40, 55, 12, 3)]
    noise = lambda n: [word() for _ in range(n)]
    text = " ".join
    docs = [
        (1, text(noise(90) + item[0] + noise(50))), (2, text(item[1]).upper()), (3, text(noise(9) + item[0][:20])),
        (4, text(noise(9) + item[2][2:] + noise(70) + item[3])), (5, text(noise(30) + item[4] + noise(5))), (6, text(noise(400))),
        (7, text(item[0][:39] + ["other"] + noise(60) + item[0])), (None, text(item[0])), (1, text(noise(9))),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string").unionByName(
        odd_docs.select(odd_docs.doc_id + 100, "text").toDF("doc_id", "text")
    ).selectExpr("*", "1 as item", "'x' as shingle")
    bench = [(k, text(w)) for k, w in enumerate(item)] + [(70, None), (71, ""), (2, text(item[2]))]
    bench = spark.createDataFrame(bench, "item_id int, text string").selectExpr("*", "1 as size")
    result = contaminated(docs, bench)
    assert "Python" not in plan_of(result)
    got = {(r.doc_id, r.item_id): round(r.similarity, 3) for r in result.collect()}
    assert set(got) == {(1, 0), (2, 1), (4, 2), (4, 3), (5, 4), (7, 0)}
    assert got[1, 0] == got[7, 0] == 1.0 and got[4, 2] < 1
    assert contaminated(no_docs, bench).count() == 0 and contaminated(docs, bench.where("false")).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-duplicates", "decontamination", "personal data", "byte-level BPE",
    ]
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0.5 * sizes[0]
    out = __spark_entry__.queries()["pipeline"](spark, SF_DIR)
    assert out.count() == sizes[-1]


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_stand_odd_rows(spark, odd_docs, stage):
    docs = odd_docs.select("doc_id", "text").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars", "'x' as digest")
    run = dict(corpus_pipeline.STAGES)[stage]
    assert run(spark, docs, SF_DIR).count() <= docs.count()
    assert run(spark, docs.where("false"), SF_DIR).count() == 0
