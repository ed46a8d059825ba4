"""Chunks that both tokenizers remember."""

from __future__ import annotations

import public_tokenizers
from listingflow.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "\ta\t", "a \tb c", "▁", "x ▁y z", "a▁ b", "a b c　 d", "\x00 \x00",
    "<s> </s> <unk> <|endoftext|> <0x41> a", "é ́ f", "👍 👍🏽 x", "\n\n a\n b", "a" * 300 + " " + "b" * 70 + " c",
    "\x85 a", "a \x85", "\x1f a \x1f b", "é̂ ﬁ ½ x", "one two, three.", "one two, three. one",
]


def apart(texts: list[str]) -> list[tuple[bytes, bytes]]:
    left, right = align.pair_of_tokenizers(A, B)
    both = zip(texts, left.pack(texts), right.pack(texts), strict=True)
    return [(a, b) if text and a is not None and b is not None else (b"", b"") for text, a, b in both]


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    want = apart(TEXTS)
    assert want[-1][0] and want[-1][1] and (b"", b"") in want
    for chunks, in_text in ((4096, 128), (2, 1), (3, 2)):
        monkeypatch.setattr(align, "CHUNKS_AT_ONCE", chunks)
        monkeypatch.setattr(align, "CHUNKS_IN_TEXT", in_text)
        both = align.Both(*align.pair_of_tokenizers(A, B))
        assert both.right.by_chunk
        assert both.pack(TEXTS) == want and both.pack(TEXTS[::-1]) == want[::-1]
        assert [both.pack([text])[0] for text in TEXTS] == want
        both.forget()
        assert not both.known and not both.older and both.pack([]) == []
        both.right.by_chunk = False
        assert both.pack(TEXTS) == want
        both.right.by_chunk = True


def test_a_chunk_is_encoded_once_by_both(monkeypatch):
    both = align.Both(*align.pair_of_tokenizers(A, B))
    learned: list[str] = []
    learn = both._learn
    monkeypatch.setattr(both, "_learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    monkeypatch.setattr(align, "CACHE_CHUNKS", 3)
    texts = ["one two three", "two three four", "three five", "two six"]
    assert [both.pack([text])[0] for text in texts] == apart(texts)
    assert sorted(learned) == ["five", "four", "one", "six", "three", "two"]
    assert len(both.known) + len(both.older) <= 7
