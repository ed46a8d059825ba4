"""What workers remember: a bounded number of pieces, and one operator's at a time."""

from __future__ import annotations

import public_tokenizers
from listingflow.llm import bpe, common


def test_pieces_stay_that_are_asked_for_again():
    made: list[str] = []
    own = bpe.Remembered(lambda key: made.append(key) or key.encode(), 2)
    assert [own[key] for key in "abcacada"] == [key.encode() for key in "abcacada"]
    assert made == ["a", "b", "c", "d"]
    assert len(own) <= 2 and len(own.older) <= 2
    long = "x" * 49
    assert own[long] == long.encode() and long not in own and long not in own.older
    own.forget()
    assert not own and not own.older


def test_encoder_forgets_and_encodes_the_same():
    own = bpe.Encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = own.encode("some words, some more")
    assert own.chunks and own.pieces
    own.forget()
    assert not own.chunks and not own.pieces and not own.pairs
    assert own.encode("some words, some more") == ids


def test_one_operator_remembers_at_a_time():
    dropped: list[str] = []

    def first() -> None:
        dropped.append("first")

    def second() -> None:
        dropped.append("second")

    common.hold_alone(first)
    common.hold_alone(first)
    assert dropped == []
    common.hold_alone(second)
    assert dropped == ["first"]
    common.hold_alone()
    common.hold_alone()
    assert dropped == ["first", "second"]
