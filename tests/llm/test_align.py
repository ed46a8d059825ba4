"""Alignment of two tokenizers against a plain computation."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
from conftest import SF_DIR
from odd_rows import no_docs, odd_docs  # noqa: F401
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from listingflow.llm import align as tested
from listingflow.llm import queries as llm

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    "a  b ", " lead", "tab\tand\n\nlines", "<s> x </s> <unk> <0x41> <|endoftext|>", "ﬁ ① 漢字 🙂", "a▁b", "x\x00y", "﻿a", "\xa0", " ",
    "don't   stop", "Ġweird Ċ", "é é", "a" * 5000, "supercalifragilistic " * 700,
]


def tokens_of(texts):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)
    alphabet = tested.byte_alphabet()
    for text in texts:
        found_a = a.encode(" " + (text or ""), add_special_tokens=False)
        left = [(k, bytes(alphabet[c] for c in entry)) for k, entry in zip(found_a.ids, found_a.tokens, strict=True)]
        right = []
        for k in b.encode(text or ""):
            piece = b.id_to_piece(k)
            right.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        data = (" " + (text or "")).encode()
        good = text and all(b"".join(t for _, t in side) == data for side in (left, right))
        yield (left, right) if good else ([], [])


def brute(texts):
    rows, pairs = [], Counter()
    for sides in tokens_of(texts):
        spans = []
        for side in sides:
            at, own = 0, []
            for k, token in side:
                own.append((k, at, at + len(token)))
                at += len(token)
            spans.append(own)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, begin = [], 0
        for end in cuts:
            inside = [[str(k) for k, s, e in own if begin <= s and e <= end] for own in spans]
            groups.append(",".join(inside[0]) + "|" + ",".join(inside[1]))
            begin = end
        links, first = [], 0
        for k, s, e in spans[0]:
            while first < len(spans[1]) and spans[1][first][2] <= s:
                first += 1
            at = first
            while at < len(spans[1]) and spans[1][at][1] < e:
                links.append((k, spans[1][at][0]))
                at += 1
        pairs.update(links)
        rows.append((len(spans[0]), len(spans[1]), len(groups), ";".join(groups), links))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    for n_a, n_b, n_groups, groups, links in rows:
        yield n_a, n_b, n_groups, len(links), groups, sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links)


def listed(frame):
    names = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    return Counter((r.doc_id, *(r[n] for n in names)) for r in frame.collect())


def test_odd_texts_equal_brute_force(spark, odd_docs, no_docs):
    extra = spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra).selectExpr("*", "1 as key", "2 as a", "'x' as code", "3 as groups")
    rows = docs.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows]), strict=True))
    assert listed(tested.align(docs, A, B)) == want
    for heavy in (0, 5):  # most pairs, or all, go through the join
        assert listed(tested.align(docs, A, B, heavy=heavy)) == want
    assert tested.align(no_docs, A, B).count() == 0


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest() if text else ""
    want = {r.doc_id: (*w[:4], sha(w[4]), *w[5:]) for r, w in zip(docs, brute([r.text for r in docs]), strict=True)}
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    got = {r.doc_id: tuple(r[n] for n in names) for r in llm.QUERIES["op12_token_alignment"](spark, SF_DIR).collect()}
    assert got == want


def test_long_groups_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(tested, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(tested, "CHUNKS_AT_ONCE", 3)
    sizes = tested.token_sizes(A, B)
    left, right = tested.pair_of_tokenizers(A, B)
    texts = ["one two three four five", "six", "don't"]
    own = tested.Aligned(left.pack(texts), right.pack(texts), sizes)
    assert [(a, b, c, e) for a, b, c, _, e, *_ in brute(texts)] == list(
        zip(own.counts[0].tolist(), own.counts[1].tolist(), own.texts()[1].tolist(), own.texts()[0], strict=True)
    )


def test_links_are_counted_a_bounded_number_at_a_time(monkeypatch):
    monkeypatch.setattr(tested, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(tested, "LINKS_AT_ONCE", 40)
    left, right = tested.pair_of_tokenizers(A, B)
    texts = ["one two three four five six seven eight"] * 30
    rows = pa.RecordBatch.from_pydict({"a": left.pack(texts), "b": right.pack(texts)})
    found = list(tested._linked([rows], tested.token_sizes(A, B)))
    links = [sum(batch.column("links").to_pylist()) for batch in found]
    assert sum(links) == sum(n for _, _, _, n, *_ in brute(texts))
    assert len(links) > 1 and max(links) < 40 + 50
