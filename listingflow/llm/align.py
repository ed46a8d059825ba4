"""Two tokenizers' tokens of the same bytes, cut into groups that cover the same range.

Both tokenizers encode a text with a space before it. Their tokens, as byte ranges,
are sorted together by start; where a start reaches the greatest end so far, both
have a token's end, and a group is done. Within groups, ranges that overlap are
links. How often two ids are linked in the whole corpus tells which id of one
vocabulary stands for which of the other.

The ids of all texts are stored once, packed; groups, links and counts are made
from them by numpy, many documents at a time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import hold_alone, prepare, stored

# Linked pairs of ids whose counts go to every task; all others are joined. None of
# the others holds more than one link in HEAVY, so no key of that join is hot.
HEAVY = 1 << 18
# Bounds of what a worker holds at once: bytes of text to encode, chunks remembered
# and encoded in one call, tokens aligned (one longer document goes alone), links counted.
TEXT_AT_ONCE = 1 << 19
CACHE_CHUNKS = 100_000
CHUNKS_AT_ONCE = 4096
CHUNKS_IN_TEXT = 128
# Tells the ids of the second tokenizer among those of both.
MARK = np.uint32(1 << 31)
TOKENS_AT_ONCE = 1 << 17
LINKS_AT_ONCE = 1 << 20

# A space between two characters that are none begins a piece in byte-level BPE, and in
# a vocabulary whose pieces hold spaces at their start only (see `Pieces.by_chunk`).
SINGLE_SPACE = re.compile(r" (?<=\S )(?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE of the `tokenizers` library; special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker per core already
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.own.get_vocab()
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            if all(c in alphabet for c in entry):
                self.tokens[number] = bytes(alphabet[c] for c in entry)
        self.sizes = np.array([len(token) for token in self.tokens], np.int64)

    def _ids(self, text: str) -> np.ndarray | None:
        """Ids of a text; None if they do not give its bytes again."""
        ids = self.own.encode_batch_fast([text], add_special_tokens=False)[0].ids
        whole = b"".join(map(self.tokens.__getitem__, ids)) == text.encode()
        return np.array(ids, "<u4") if whole else None

    def _one(self, text: str) -> bytes | None:
        ids = self._ids(text)
        return None if ids is None else ids.tobytes()

    def pack(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text with a space before it, as little-endian 32-bit integers.

        None if they do not give the text's bytes again.
        """
        return [self._one(" " + text) for text in texts]

    def joined(self, chunks: list[str]) -> np.ndarray | None:
        """Ids of chunks that stand behind a space each; None if they do not give the bytes again."""
        return self._ids(" " + " ".join(chunks))


class Pieces:
    """A model of the `sentencepiece` library, which adds the space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.own = SentencePieceProcessor(model_file=path)
        self.tokens = []
        for number in range(self.own.vocab_size()):
            piece = self.own.id_to_piece(number)
            if self.own.is_byte(number):
                self.tokens.append(bytes([int(piece[3:5], 16)]))
            elif self.own.is_control(number) or self.own.is_unknown(number):
                self.tokens.append(b"")
            else:
                self.tokens.append(piece.replace("▁", " ").encode())

        self.sizes = np.array([len(token) for token in self.tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        # Whether a piece that holds a space behind its start is one of spaces alone.
        self.by_chunk = all(b" " not in token[1:] or not token.strip(b" ") for token in self.tokens)
        self.at = np.cumsum(self.sizes) - self.sizes

    def pack(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text as little-endian 32-bit integers; None if they do not give
        the bytes of the text with a space before it again."""
        return [self._whole(np.array(ids, "<u4"), text) for ids, text in zip(self.own.encode(texts, num_threads=1), texts, strict=True)]

    def joined(self, chunks: list[str]) -> np.ndarray | None:
        """Ids of chunks that stand behind a space each; None if they do not give the bytes again."""
        texts = [" ".join(chunks[at : at + CHUNKS_IN_TEXT]) for at in range(0, len(chunks), CHUNKS_IN_TEXT)]
        ids = np.fromiter(chain.from_iterable(self.own.encode(texts, num_threads=1)), "<u4")
        return ids if self._gives(ids, " ".join(texts)) else None

    def _whole(self, ids: np.ndarray, text: str) -> bytes | None:
        return ids.tobytes() if self._gives(ids, text) else None

    def _gives(self, ids: np.ndarray, text: str) -> bool:
        """Whether the ids give the bytes of the text with a space before it."""
        data = np.frombuffer(b" " + text.encode(), np.uint8)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids) or ends[-1] != len(data):
            return False
        places = np.repeat(self.at[ids] - ends + sizes, sizes) + np.arange(len(data))
        return np.array_equal(self.bytes[places], data)


class Both:
    """The ids of two tokenizers for whole texts, by chunks between single spaces.

    No piece of either tokenizer spans a single space between two characters that are
    none, so what stands between such spaces is encoded once and remembered; of many
    chunks only those stay that come again.
    """

    def __init__(self, left: ByteLevel, right: Pieces):
        self.left, self.right = left, right
        # Per chunk the ids of the left, then those of the right one with MARK.
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks that stand behind a space.

        A chunk that neither begins nor ends with white space is a text by itself, so
        many are encoded in one call and told apart by the bytes of their tokens.
        """
        plain = [c for c in chunks if c and not (c[0].isspace() or c[-1].isspace())]
        odd = [c for c in chunks if not c or c[0].isspace() or c[-1].isspace()]
        for at in range(0, len(plain), CHUNKS_AT_ONCE):
            some = plain[at : at + CHUNKS_AT_ONCE]
            a = self.left.joined(some)
            b = None if a is None else self.right.joined(some)
            if b is None:
                odd += some
                continue
            ends = np.cumsum([len(chunk.encode()) + 1 for chunk in some])
            of = np.concatenate([np.searchsorted(ends, np.cumsum(own.sizes[ids])) for own, ids in ((self.left, a), (self.right, b))])
            packed = np.concatenate([a, b | MARK])[np.argsort(of, kind="stable")].tobytes()
            cuts = [0, *(4 * np.cumsum(np.bincount(of, minlength=len(some)))).tolist()]
            self.known.update(zip(some, (packed[x:y] for x, y in zip(cuts, cuts[1:], strict=False)), strict=True))
        for chunk, a, b in zip(odd, self.left.pack(odd), self.right.pack(odd), strict=True):
            whole = a is not None and b is not None
            self.known[chunk] = a + (np.frombuffer(b, "<u4") | MARK).tobytes() if whole else None

    def pack(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of both for each text, empty if either does not give the text's bytes again."""
        if not self.right.by_chunk:
            both = zip(texts, self.left.pack(texts), self.right.pack(texts), strict=True)
            return [(a, b) if text and a is not None and b is not None else (b"", b"") for text, a, b in both]
        parts = [SINGLE_SPACE.split(text) for text in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*parts) - known.keys()
        again = new & older.keys()
        known.update((chunk, older.pop(chunk)) for chunk in again)
        new = list(new - again)
        self._learn(new)
        packed = []
        for text, own in zip(texts, parts, strict=True):
            try:
                packed.append(b"".join(map(known.__getitem__, own)) if text else b"")
            except TypeError:  # a chunk is not given back
                packed.append(b"")
        for chunk in new:
            if len(chunk) > 64:  # long chunks are rare and not kept
                del known[chunk]
        ids = np.frombuffer(b"".join(packed), "<u4")
        cuts = np.cumsum([0, *(len(own) // 4 for own in packed)])
        right = ids >= MARK
        before = np.concatenate([[0], np.cumsum(right)])[cuts]
        a, b = ids[~right].tobytes(), (ids[right] & ~MARK).tobytes()
        ranges = ((4 * at).tolist() for at in (cuts - before, before))
        a, b = ([own[x:y] for x, y in zip(at, at[1:], strict=False)] for own, at in zip((a, b), ranges, strict=True))
        return list(zip(a, b, strict=True))


@lru_cache(maxsize=2)
def pair_of_tokenizers(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """One pair per worker process and files."""
    return ByteLevel(a_path), Pieces(b_path)


@lru_cache(maxsize=2)
def both_tokenizers(a_path: str, b_path: str) -> Both:
    return Both(*pair_of_tokenizers(a_path, b_path))


def encoded(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, a, b): the ids of both tokenizers for every whole text, stored.

    `key` tells rows apart, also those that share an id or have none; `a` and `b`
    are packed little-endian 32-bit integers. They are empty if the text is null or
    empty, or if the tokens of either tokenizer do not give the text's bytes again.
    Both files must be at the same path on every worker. Other columns are not read.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = both_tokenizers(a_path, b_path)
        hold_alone(both.forget)

        def packed(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = both.pack([value or "" for value in rows.column(text).to_pylist()])
            return pa.RecordBatch.from_pydict(
                {
                    id: rows.column(id),
                    "key": pa.array([os.urandom(16) for _ in found], pa.binary()),
                    "a": pa.array([a for a, _ in found], pa.binary()),
                    "b": pa.array([b for _, b in found], pa.binary()),
                }
            )

        for batch in batches:
            begin = held = 0
            for k, size in enumerate(pc.binary_length(batch.column(text)).to_pylist(), 1):
                held += size or 0
                if held >= TEXT_AT_ONCE or k == batch.num_rows:
                    yield packed(batch.slice(begin, k - begin))
                    begin, held = k, 0

    return stored(docs.select(id, text).mapInArrow(run, f"{id} {kind}, key binary, a binary, b binary"), "token-ids")


class Aligned:
    """The tokens of some documents, aligned. Documents follow each other in one range
    of bytes; at a document's end both tokenizers have a token's end."""

    def __init__(self, a: list[bytes], b: list[bytes], sizes: tuple[np.ndarray, np.ndarray]):
        self.ids = [np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in (a, b)]
        self.counts = [np.array([len(own) // 4 for own in side], np.int64) for side in (a, b)]
        self.documents = len(a)
        self.vocabulary = max(map(len, sizes))
        self.ends = [np.cumsum(size[ids]) for size, ids in zip(sizes, self.ids, strict=True)]
        self.starts = [end - size[ids] for end, size, ids in zip(self.ends, sizes, self.ids, strict=True)]

    def document(self, side: int) -> np.ndarray:
        return np.repeat(np.arange(self.documents), self.counts[side])

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, begins, kind): all tokens by start, and which of them begin a group."""
        start = np.concatenate(self.starts)
        end = np.concatenate(self.ends)
        kind = np.repeat([0, 1], [len(own) for own in self.ids])
        order = np.lexsort((kind, start))
        begins = np.ones(len(order), bool)
        begins[1:] = start[order][1:] >= np.maximum.accumulate(end[order])[:-1]
        return order, begins, kind

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(A token, B token) of every two that overlap; both as positions, by A.

        The B tokens that overlap one A token follow each other, so no pairs are
        made that do not overlap, however long a group is.
        """
        first = np.searchsorted(self.ends[1], self.starts[0], "right")
        last = np.searchsorted(self.starts[1], self.ends[0], "left")
        count = last - first
        a = np.repeat(np.arange(len(count)), count)
        return a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count - first, count)

    def texts(self) -> tuple[list[str], np.ndarray]:
        """Per document: its groups as `a1,a2|b1;a3|b2,b3`, and how many there are."""
        order, begins, kind = self.groups()
        document = np.concatenate([self.document(0), self.document(1)])
        number = np.cumsum(begins) - 1
        n_groups = np.bincount(document[order][begins], minlength=self.documents)
        group = np.empty(len(order), np.int64)
        group[order] = number
        by = np.lexsort((kind, group))  # positions rise with starts, and the sort is stable
        kind, group = kind[by], group[by]
        # The first token of a group follows `;`, its first B token `|`, any other `,`.
        mark = np.zeros(len(by), np.int64)
        mark[1:][kind[1:] != kind[:-1]] = 2
        mark[np.concatenate([[True], group[1:] != group[:-1]])[: len(by)]] = 1
        parts = marked_numbers(self.vocabulary)[mark, np.concatenate(self.ids)[by]]
        cuts = np.concatenate([[0], np.cumsum(self.counts[0] + self.counts[1])]).tolist()
        flat = parts.tolist()
        return ["".join(flat[x:y])[1:] for x, y in zip(cuts, cuts[1:], strict=False)], n_groups


@lru_cache(maxsize=1)
def marked_numbers(n: int) -> np.ndarray:
    """Decimal numbers below `n` behind `,`, `;` and `|`."""
    return np.array([[mark + str(k) for k in range(n)] for mark in ",;|"], object)


def _alignments(
    batches: Iterable[pa.RecordBatch], sizes: tuple[np.ndarray, np.ndarray]
) -> Iterator[tuple[Aligned, pa.RecordBatch]]:
    """Alignments of a bounded number of tokens, with the rows that they are of."""
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        begin = held = 0
        for k in range(len(a) + 1):
            size = (len(a[k]) + len(b[k])) // 4 if k < len(a) else 0
            if k > begin and (k == len(a) or held + size > TOKENS_AT_ONCE):
                yield Aligned(a[begin:k], b[begin:k], sizes), batch.slice(begin, k - begin)
                begin, held = k, 0
            held += size


@lru_cache(maxsize=2)
def token_sizes(a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every token of both vocabularies."""
    left, right = pair_of_tokenizers(a_path, b_path)
    return left.sizes, right.sizes


def _linked(batches: Iterable[pa.RecordBatch], sizes: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(code, links) of the pairs of ids in these rows, of a bounded number of links at a time."""
    codes, held = [], 0

    def counted() -> pa.RecordBatch:
        code, links = np.unique(np.concatenate(codes), return_counts=True)
        return pa.RecordBatch.from_pydict({"code": code, "links": links})

    for own, _ in _alignments(batches, sizes):
        a, b = own.links()
        codes.append(own.ids[0][a] * len(sizes[1]) + own.ids[1][b])
        held += len(a)
        if held >= LINKS_AT_ONCE:
            yield counted()
            codes, held = [], 0
    if held:
        yield counted()


def pair_counts(ids: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(code, a_id, b_id, links, best): how often two ids are linked in all documents.

    `best`: no other A id is linked with this B id more often. `code` is one number
    for the two. Counted within a task before anything is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _linked(batches, token_sizes(a_path, b_path))

    n_b = len(pair_of_tokenizers(a_path, b_path)[1].tokens)
    counts = ids.select("a", "b").mapInArrow(run, "code long, links long").groupBy("code").agg(F.sum("links").alias("links"))
    counts = stored(
        counts.select("code", F.expr(f"int(code div {n_b})").alias("a_id"), F.expr(f"int(code % {n_b})").alias("b_id"), "links"),
        "id-pairs",
    )
    # One row per id of a fixed vocabulary.
    most = counts.groupBy(F.col("b_id").alias("b_")).agg(F.max("links").alias("most"))
    known = counts.join(F.broadcast(most), F.col("b_id") == F.col("b_"))
    return known.select("code", "a_id", "b_id", "links", (F.col("links") == F.col("most")).alias("best"))


def aligned(ids: DataFrame, a_path: str, b_path: str, id: str = "doc_id") -> DataFrame:
    """(id, key, n_a, n_b, n_groups, n_links, groups) of every document.

    `groups` lists the ids of both sides, `a1,a2|b1;a3|b2,b3`. Documents without
    tokens have zeros and an empty text.
    """
    kind = ids.schema[id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, rows in _alignments(batches, token_sizes(a_path, b_path)):
            texts, n_groups = own.texts()
            a, _ = own.links()
            yield pa.RecordBatch.from_pydict(
                {
                    id: rows.column(id),
                    "key": rows.column("key"),
                    "n_a": own.counts[0],
                    "n_b": own.counts[1],
                    "n_groups": n_groups,
                    "n_links": np.bincount(own.document(0)[a], minlength=own.documents),
                    "groups": pa.array(texts, pa.string()),
                }
            )

    schema = f"{id} {kind}, key binary, n_a long, n_b long, n_groups long, n_links long, groups string"
    return ids.mapInArrow(run, schema)


def agreement(ids: DataFrame, counts: DataFrame, a_path: str, b_path: str, heavy: int = HEAVY) -> DataFrame:
    """(key, n_best, count_sum) per document that has links.

    `n_best`: links whose pair is its B id's best; `count_sum`: the corpus-wide
    counts of the pairs of all links. The `heavy` most frequent pairs are looked up
    in the task (a bounded table), the others are joined by their code.
    """
    top = counts.orderBy(F.desc("links"), "code").limit(heavy).select("code", "links", "best").toArrow()
    code = top.column("code").to_numpy()
    by = np.argsort(code)
    spark = ids.sparkSession
    known = spark.sparkContext.broadcast(
        (code[by], top.column("links").to_numpy()[by], top.column("best").to_numpy(zero_copy_only=False)[by])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = token_sizes(a_path, b_path)
        codes, links, best = known.value
        for own, rows in _alignments(batches, sizes):
            a, b = own.links()
            document = own.document(0)[a]
            code = own.ids[0][a] * len(sizes[1]) + own.ids[1][b]
            at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            found = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            # Links follow each other by document, so its sums are differences of running sums.
            ends = np.cumsum(np.bincount(document, minlength=own.documents))
            own_best = best[at] & found if len(codes) else found
            own_links = np.where(found, links[at], 0) if len(codes) else np.zeros(len(code), np.int64)
            sums = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends] for x in (own_best, own_links))
            n_best, count_sum = (np.diff(x, prepend=0) for x in sums)
            of = np.flatnonzero(count_sum)
            none = pa.nulls(len(of), pa.int64())
            keys = rows.column("key")
            columns = (keys.take(pa.array(of)), none, none, pa.array(n_best[of]), pa.array(count_sum[of]))
            yield pa.RecordBatch.from_pydict(dict(zip(names, columns, strict=True)))
            missing = np.flatnonzero(~found)
            if len(missing):  # pairs that are not in the table, once per document
                # One number for both, as sorting numbers is far cheaper than sorting columns.
                ids = len(sizes[0]) * len(sizes[1])
                rare, times = np.unique(document[missing] * ids + code[missing], return_counts=True)
                of, pair = np.divmod(rare, ids)
                none = pa.nulls(len(of), pa.int64())
                columns = (keys.take(pa.array(of)), pa.array(pair), pa.array(times), none, none)
                yield pa.RecordBatch.from_pydict(dict(zip(names, columns, strict=True)))

    names = ("key", "code", "times", "n_best", "count_sum")
    sums = stored(
        ids.select("key", "a", "b").mapInArrow(run, "key binary, code long, times long, n_best long, count_sum long"), "link-sums"
    )
    rare = sums.where("code is not null").select("key", F.col("code").alias("c"), "times")
    rare = rare.join(counts, F.col("c") == F.col("code")).select(
        "key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("links")).alias("count_sum")
    )
    both = sums.where("code is null").select("key", "n_best", "count_sum").unionByName(rare)
    return both.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", digest: bool = False, heavy: int = HEAVY
) -> DataFrame:
    """Groups, links and agreement of two tokenizers on every whole text.

    Returns per input row `id`, `n_a`, `n_b`, `n_groups`, `n_links`, `groups`
    (a text, see `aligned`), `n_best` and `count_sum` (see `agreement`). With
    `digest`, `groups` is the sha256 of that text (and empty for an empty one), so that no long
    texts are shuffled.

    Null and empty texts, and texts that either tokenizer does not give back byte
    by byte, have zeros and no groups. Repeated rows and ids and rows without an id
    give a row each and count in the corpus each. Other columns are not read. An
    empty table gives an empty result.
    """
    ids = encoded(docs, a_path, b_path, id, text)
    counts = pair_counts(ids, a_path, b_path)
    sums = agreement(ids, counts, a_path, b_path, heavy).withColumnRenamed("key", "key_")
    rows = aligned(ids, a_path, b_path, id)
    if digest:
        rows = rows.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    zero = F.lit(0).cast("long")
    return rows.join(sums, F.col("key") == F.col("key_"), "left").select(
        id, "n_a", "n_b", "n_groups", "n_links", "groups",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
    )
