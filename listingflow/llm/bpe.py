"""Byte-level BPE encoding and decoding with an Aho-Corasick automaton.

A piece of text is encoded by walking over its longest matches and going back to
shorter ones where two neighbouring tokens could not stand side by side in a
merged text. For each prefix of a piece there is exactly one valid encoding, so a
position that cannot be continued is marked once and never tried again: the time
is linear in the length of the piece, whatever it holds.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from listingflow.llm.common import hold_alone, prepare, records

# Distinct chunks, pieces and token pairs that a worker remembers: as many again are
# kept for as long as they are asked for. Some 100 MB in a worker at most.
CACHE_CHUNKS = 200_000
CACHE_PIECES = 100_000
CACHE_PAIRS = 200_000

# A space between two characters that are none always begins a piece: no
# alternative of the splitting pattern holds a space behind another character,
# and none looks further than over white space.
SINGLE_SPACE = re.compile(r" (?<=\S )(?=\S)")

SCHEMA = "n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain BPE: always join the leftmost pair of the lowest rank. For short pieces."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        joined = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        found = [rank for rank in joined if rank is not None]
        if not found:
            break
        at = joined.index(min(found))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Remembered(dict):
    """The latest `size` results by argument, and the `size` before them until they are
    replaced; of those, what is asked for again stays. Long arguments are rare and not kept."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        self.make, self.size = make, size
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) <= 48:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}


class Encoder:
    """Encodes and decodes with the ranks of one vocabulary file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.length = [0] * (max(self.tokens) + 1)
        self.shorter = [-1] * len(self.length)
        self.matcher = ahocorasick.Automaton()
        # A token that merging does not arrive at stands for whole pieces only.
        reached = {token for token in self.ranks if merge(token, self.ranks) == [token]}
        for token in reached:
            rank = self.ranks[token]
            self.length[rank] = len(token)
            prefixes = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((self.ranks[p] for p in prefixes if p in reached), -1)
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = Remembered(self.pack_piece, CACHE_PIECES)
        self.chunks = Remembered(lambda chunk: self.pack_chunk(" " + chunk), CACHE_CHUNKS)

    def forget(self) -> None:
        self.pairs.clear()
        self.pieces.forget()
        self.chunks.forget()

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes gives these two tokens again."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        a, b = self.tokens[left], self.tokens[right]
        known = self.pairs[left << 32 | right] = merge(a + b, self.ranks) == [a, b]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one match of the splitting pattern."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        length, shorter, known = self.length, self.shorter, self.pairs.get
        size = len(piece)
        longest = [0] * (size + 1)  # the token of the longest match at each start
        for end, rank in self.matcher.iter(piece.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank
        open_at = [True] * (size + 1)
        ids: list[int] = []
        at, last, rank = 0, -1, longest[0]
        while at < size:
            while rank >= 0:
                if open_at[at + length[rank]]:
                    fits = last < 0 or known(last << 32 | rank)
                    if fits is None:
                        fits = self.compatible(last, rank)
                    if fits:
                        break
                rank = shorter[rank]
            if rank >= 0:
                ids.append(rank)
                at += length[rank]
                last, rank = rank, longest[at]
            else:  # no way on from here: take a shorter token before
                open_at[at] = False
                rank = ids.pop()
                at -= length[rank]
                last, rank = ids[-1] if ids else -1, shorter[rank]
        return ids

    def pack_piece(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode("utf-8", "replace")), "<u4").tobytes()

    def pack_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        first, *rest = SINGLE_SPACE.split(text)
        return self.pack_chunk(first) + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path, pattern)


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """Ids of every whole text, with digests of the ids and of the decoded bytes.

    `ranks_path` names a rank file that every worker can open. `pattern` splits a
    text before merging. A null or empty text has no tokens. Each input row gives
    one output row, repeated rows too; other columns are not read. `ids=False`
    leaves the packed ids out of the result.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()
    schema = f"{id} {kind}, {SCHEMA if ids else SCHEMA.replace('ids binary, ', '')}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks_path, pattern)
        hold_alone(own.forget)
        for batch in batches:
            rows = []
            for (value,) in records(batch, text):
                packed = own.encode(value or "")
                decoded = hashlib.sha256(own.decode(packed)).hexdigest()
                rows.append((len(packed) // 4, packed, hashlib.sha256(packed).hexdigest(), decoded))
            n, packs, digests, back = map(list, zip(*rows, strict=True)) if rows else ([], [], [], [])
            columns = {id: batch.column(id), "n_tokens": pa.array(n, pa.int64())}
            if ids:
                columns["ids"] = pa.array(packs, pa.binary())
            columns |= {
                "ids_sha256": pa.array(digests, pa.string()),
                "decoded_sha256": pa.array(back, pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(id, text).mapInArrow(run, schema)
