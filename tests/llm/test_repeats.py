"""Runs of repeated words against trying every period."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from conftest import SF_DIR
from odd_rows import LONG, no_docs, odd_docs  # noqa: F401

from listingflow.llm import queries as llm
from listingflow.llm import repeats


def brute(words, least, times):
    found = {}
    for q in range(1, len(words) // times + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            if at + q - start >= max(least, times * q):
                found.setdefault((start, at + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (5, 3), (1, 2)])
def test_random_words_equal_brute_force(least, times):
    draw = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(draw.randint(0, 10)):
            words = [b"%d" % draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(0, 70))]
            if len(words) > 4 and draw.random() < 0.5:
                p, at = draw.randint(1, 6), draw.randrange(len(words))
                for i in range(at + p, len(words)):
                    words[i] = words[i - p]
            docs.append(words)
        for words, (n, found, text) in zip(docs, repeats._worked(docs, least, times), strict=True):
            own = [(r["start"], r["length"], r["period"]) for r in found]
            want = brute(words, least, times)
            assert n == len(words) and own == want and text == b" ".join(kept(words, want))


def test_odd_rows(spark, odd_docs, no_docs):
    extra = spark.createDataFrame([(50, "a b " * 6), (51, "x X " * 9), (52, "b\x0bb\x0cb\rb\nb\tb")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra).selectExpr("*", "1 as runs", "2 as collapsed", "3 as words")
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in repeats.find_runs(docs).collect())
    want = []
    for r in docs.collect():
        words = (r.text or "").encode().split()
        found = brute(words, 6, 4) if len(words) < 1000 else [(0, 12000, 3)]
        want.append((r.doc_id, len(words), tuple(found), b" ".join(kept(words, found)).decode()))
    assert got == Counter(want)
    assert repeats.find_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        repeats.find_runs(docs, times=1)


def test_long_documents():
    cases = [([b"a"] * 300_000, (0, 300_000, 1)), (LONG.encode().split() * 20, (0, 240_000, 3))]
    for words, run in cases:
        ((_, found, _),) = repeats._worked([words], 6, 4)
        assert [(r["start"], r["length"], r["period"]) for r in found] == [run]


def test_query_equals_brute_force(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words, 6, 4)
        start, length, period = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        text = "".join(f"{s},{e},{q}\n" for s, e, q in found)
        milli = 1000 * length // period if found else None
        want.add((r.doc_id, len(found), start, length, period, milli, sha(text), sha(" ".join(kept(words, found)))))
    got = llm.QUERIES["op13_repeated_runs"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {tuple(r) for r in got.collect()} == want and sum(w[1] for w in want) > 5
    assert dict(got.dtypes)["start"] == dict(got.dtypes)["exponent_milli"] == "bigint"
