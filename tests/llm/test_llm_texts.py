"""Text operators against brute force and plain libraries."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR, plan_of
from odd_rows import no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from listingflow.llm import quality, toxicity
from listingflow.llm.bpe import encode_decode, encoder, read_ranks
from listingflow.llm.common import remainder, words
from listingflow.llm.lm import score_documents
from listingflow.llm.minmax import near_duplicates, shingle_set
from listingflow.llm.pii import personal_data, redact

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_bpe_equals_merging(spark, odd_docs, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    rows = docs.collect()
    got = encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for row in rows:
        ids = np.array(reference.encode_ordinary(row.text or ""), "<u4").tobytes()
        want[row.doc_id, ids, hashlib.sha256((row.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.decoded_sha256) for r in got) == want
    assert all(r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() for r in got)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 999, "ab" * 2000, " \n a  b\n\n c ", "it's 12  ñandú\x1c x", "日本 語"])
def test_bpe_odd_pieces(reference, text):
    own = encoder(RANKS, public_tokenizers.PATTERN)
    packed = own.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
    assert own.decode(packed) == text.encode()


def test_bpe_of_nothing(no_docs):
    assert encode_decode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def groups_by_brute_force(rows, size, percent):
    sets = [(i, set(shingle_set(t, size).tolist())) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    postings = defaultdict(list)
    for k, (_, own) in enumerate(sets):
        common = Counter(j for s in own for j in postings[s])
        for s in own:
            postings[s].append(k)
        for j, c in common.items():
            if 100 * c >= percent * (len(own) + len(sets[j][1]) - c):
                parent[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((str(i), len(own), str(least.get(root(k)))) for k, (i, own) in enumerate(sets))


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd_docs, size, percent):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.withColumn("doc_id", F.col("doc_id") + 100)
    edited = docs.where("length(text) > 600").limit(60).selectExpr(
        "doc_id + 10000 as doc_id", "concat(substring(text, 1, 300), ' changed ', substring(text, 301)) as text"
    )
    docs = docs.unionByName(edited).unionByName(odd_docs.select("doc_id", "text"))
    got = near_duplicates(docs, size, percent).collect()
    want = groups_by_brute_force([(r.doc_id, r.text) for r in docs.collect()], size, percent)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(no_docs, odd_docs):
    assert near_duplicates(no_docs, 3, 85).count() == 0
    assert near_duplicates(odd_docs, 3, 85).count() == odd_docs.count()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def stands(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def test_personal_data(spark, odd_docs):
    more = [
        (20, "x@y.z_a@b.c and 1.2.3.4.5.6.7.8"), (21, "300.1.1.1 001.02.3.255"), (22, "é😀 a@b.c 日+1 (017) 555-7713"),
        (23, "1" * 30000), (24, "a" * 30000), (25, "a@" * 9000), (26, "1.2.3.4 " * 3000), (27, "\ue000a@b.c\ue001"),
    ]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.unionByName(spark.read.parquet(f"{SF_DIR}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    texts = Counter()
    for row in docs.collect():
        found = sorted(
            (m.start(), rank, kind, m.end())
            for rank, (kind, pattern) in enumerate(PATTERNS.items())
            for m in re.finditer(pattern, row.text or "")
            if stands(kind, m.group())
        )
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        texts[row.doc_id, hashlib.sha256(joined.encode()).hexdigest(), sum(f[2] == "card" for f in found)] += 1
    result = personal_data(docs)
    assert "Python" not in plan_of(result) and "Arrow" not in plan_of(result)
    assert Counter((r.doc_id, r.base_sha256, r.n_card) for r in result.collect()) == texts


def test_personal_data_more_kinds_and_redaction(spark, no_docs):
    docs = spark.createDataFrame(
        [(1, "account GB82 WEST 1234 5698 7654 32 ok"), (2, "GB83 WEST 1234 5698 7654 32"), (3, 'token = "' + "0a" * 20 + '"'),
         (4, "0a" * 20), (5, None), (6, "to a@b.co, 10.0.0.1")], "doc_id long, text string",
    )
    spans = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    assert spans == {1: "iban:8:35", 2: "", 3: "secret:9:49", 4: "", 5: "", 6: "email:3:9,ip:11:19"}
    texts = {r.doc_id: r.text for r in redact(docs).collect()}
    assert texts[1] == "account <iban> ok" and texts[5] is None and texts[6] == "to <email>, <ip>"
    assert personal_data(no_docs).count() == 0 and redact(no_docs).count() == 0


def test_language_model(spark, odd_docs):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text"))
    got = score_documents(docs, remainder(F.col("doc_id")) != 1).collect()
    rows = [(r.doc_id, [*words(r.text), b""]) for r in docs.collect()]
    learn = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    counts = Counter(w for i, own in rows if learn(i) for w in own)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, own in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want[i, not learn(i), len(own), sum(counts[w] > 0 for w in own), round(base, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_of_nothing(odd_docs, no_docs):
    assert score_documents(no_docs, F.lit(True)).count() == 0
    rows = score_documents(odd_docs, F.lit(False)).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) and r.n_known == 0 for r in rows)


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learn = labels.where(remainder(F.col("doc_id")) != 0)
    scored = quality.score(docs, quality.train(docs, learn)).join(labels, "doc_id")
    rows = scored.where(remainder(F.col("doc_id")) == 0).collect()
    good, bad = [[r.score for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= quality.GOOD for g in good]) > 0.95
    learn = learn.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    models = toxicity.train(docs, learn, ["junk", "toxic"])
    scored = toxicity.score(docs, models, ["junk", "toxic"]).join(labels, "doc_id")
    rows = scored.where(remainder(F.col("doc_id")) == 0).collect()
    yes, no = [[r.p_toxic for r in rows if r.toxic == t] for t in (1, 0)]
    assert np.mean([a > b for a in yes for b in no]) > 0.9


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_share_of_positives_of_a_known_mixture(share):
    """Estimated from positives and a mixture only; the bins overlap."""
    draw = np.random.default_rng(7)
    count = lambda x: np.bincount(np.clip((x * 100).astype(int), 0, 99), minlength=100)
    n = 20_000
    good = draw.beta(6, 2, int(n * share))
    bad = draw.beta(1, 8, n - len(good))
    found = quality.share_of_positives(count(draw.beta(6, 2, 3000)), count(np.concatenate([good, bad])))
    assert share - 0.06 < found < share + 0.02


def test_the_prior_comes_from_texts_not_from_negatives(spark, monkeypatch):
    """Labels of negatives change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(2500)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = []
    own = quality.share_of_positives
    monkeypatch.setattr(quality, "share_of_positives", lambda *counts: found.append(own(*counts)) or found[-1])
    with_all = quality.train(docs, labels)
    without = quality.train(docs, labels.where("quality = 1"))
    assert found[0] == found[1] and 0.75 < found[0] < 0.9
    assert np.allclose(with_all[0], without[0]) and np.isclose(with_all[1], without[1])


def test_classifiers_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.where("false")
    for own in (labels, none):
        model = quality.train(odd_docs, own)
        assert quality.score(odd_docs, model).count() == odd_docs.count()
        assert quality.score(no_docs, model).count() == 0
        models = toxicity.train(odd_docs, own.withColumn("quality", 1 - F.col("quality")), ["quality", "toxic"])
        rows = toxicity.score(odd_docs, models, ["quality", "toxic"]).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.p_toxic <= 1 for r in rows)


def test_later_categories_use_earlier_ones():
    draw = np.random.default_rng(0)
    rows = [np.unique(draw.integers(0, 50, 6)).astype(np.int32) for _ in range(800)]
    first = np.array([float(3 in r) for r in rows])
    labels = np.column_stack([first, first])
    index, starts = toxicity._joined(rows)
    models = toxicity.fit_chain(index, starts, labels, np.arange(800) % 4)
    assert models[1].chain[0] > 0
    found = toxicity.apply_chain(models, index, starts)
    assert ((found > 0.5) == (labels > 0.5)).mean() > 0.99
