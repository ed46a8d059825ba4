"""Scoring documents with a language model: a word-count base and a recurrent network.

Counts are taken over all training words, and the network is trained on all training
documents: each partition learns on its own from the weights given, and the weights
are averaged by the words seen. Frequent words (a bounded number) are broadcast with
their counts; the others, of which there may be any number, are looked up by a join.

Texts are split and looked up once: the slots of their words are stored, and learning
and scoring read those. As each partition learns from its own documents, the weights
depend on how the table is split into partitions.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm import gru
from listingflow.llm.common import prepare, records, stored, words

# The token behind a document's last word; no word is empty.
END = b""
# Words that are broadcast with their counts, at most.
FREQUENT = 1 << 17
# Groups of the words that have no slot of their own, by how they end.
TAILS = 64
# Words counted, and tokens learned from or scored, at once in a task.
COUNTED = 300_000
CHUNK = 4_000_000
# The share of the training documents (in sixteenths) that each round learns from.
ROUNDS = ((0, 4), (4, 16))
BLOCK = 4096
PARTS = 64


def tail(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, tail, c): how often each token occurs, the end of documents included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(list(counts), pa.binary()),
                    "tail": pa.array([tail(w) for w in counts], pa.int32()),
                    "c": pa.array(list(counts.values()), pa.int64()),
                }
            )
            counts.clear()
            return out

        for batch in batches:
            for (value,) in records(batch, text):
                counts.update(words(value))
                counts[END] += 1
                if len(counts) >= COUNTED:
                    yield flushed()
        yield flushed()

    part = docs.select(text).mapInArrow(run, "word binary, tail int, c long")
    return part.groupBy("word", "tail").agg(F.sum("c").alias("c"))


class Lexicon:
    """The frequent words with counts and slots, and the totals over all words."""

    def __init__(self, counts: DataFrame):
        bucket = F.floor(F.log2("c") * 8).cast("int")
        sizes = counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).orderBy(F.desc("bucket")).collect()
        n, least = 0, 1 << 30
        for row in sizes:
            if n + row["n"] > FREQUENT:
                break
            n, least = n + row["n"], row["bucket"]
        frequent = counts.where(bucket >= least).select("word", "c").collect() if n else []
        frequent = sorted(((bytes(r["word"]), r["c"]) for r in frequent), key=lambda r: (-r[1], r[0]))
        totals = {r["tail"]: (r["n"], r["v"]) for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
        self.n = sum(n for n, _ in totals.values())
        self.v = sum(v for _, v in totals.values())
        self.index = {word: k for k, (word, _) in enumerate(frequent)}
        self.counts = np.array([c for _, c in frequent], np.float64)
        # Slots: the most frequent words, then a slot per tail, all by falling mass.
        own = [word for word, _ in frequent[: gru.SLOTS - TAILS]]
        rest = np.array([totals.get(t, (0, 0)) for t in range(TAILS)], np.float64)
        for word in own:
            rest[tail(word)] -= (self.counts[self.index[word]], 1)
        mass = np.zeros(gru.SLOTS)
        mass[: len(own)] = self.counts[: len(own)]
        mass[gru.SLOTS - TAILS :] = rest[:, 0]
        order = np.argsort(-mass, kind="stable")
        slot = np.empty(gru.SLOTS, np.int32)
        slot[order] = np.arange(gru.SLOTS)
        self.mass = mass[order]
        self.tail_slots = slot[gru.SLOTS - TAILS :]
        tails = np.array([tail(word) for word, _ in frequent], np.int32)
        self.slots = np.concatenate([slot[: len(own)], self.tail_slots[tails[len(own) :]]])
        self.tails = np.where(np.arange(len(frequent)) < len(own), -1, tails)
        # Within a tail a word has its share of the tail's words, smoothed as in the base.
        self.tail_norm = np.log10(rest[:, 0] + 0.5 * (rest[:, 1] + 1))
        self.base_norm = math.log10(self.n + 0.5 * (self.v + 1))

    def look_up(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the lexicon (-1: none), slot, and tail (-1: a slot of its own) of each token."""
        at = np.fromiter(map(self.index.get, tokens, repeat(-1)), np.int64, len(tokens))
        rare = np.flatnonzero(at < 0)
        if not len(self.counts):
            slots, tails = np.empty(len(at), np.int32), np.empty(len(at), np.int32)
        else:
            slots, tails = self.slots[at], self.tails[at]
        tails[rare] = [tail(tokens[k]) for k in rare]
        slots[rare] = self.tail_slots[tails[rare]]
        return at, slots, tails


def _unpacked(packed: Iterable[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(data, np.int16) for data in packed]


def _learned(rows: DataFrame, flat: np.ndarray) -> np.ndarray:
    """One round: weights learned by every partition from `flat`, averaged by words seen."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, seen = gru.Learner(gru.unpack(flat)), 0
        chunk, size = [], 0
        for batch in batches:
            for own in _unpacked(batch.column("slots").to_pylist()):
                chunk.append(own)
                size += len(own)
                if size >= CHUNK:
                    seen += learner.learn(chunk)
                    chunk, size = [], 0
        if chunk:
            seen += learner.learn(chunk)
        if seen:
            weights = gru.pack(learner.model).astype(np.float64) * seen
            blocks = [weights[k : k + BLOCK].tobytes() for k in range(0, len(weights), BLOCK)]
            n = len(blocks)
            part = TaskContext.get().partitionId() % PARTS
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(range(n), pa.int32()),
                    "part": pa.array([part] * n, pa.int32()),
                    "seen": pa.array([seen] * n, pa.int64()),
                    "weights": pa.array(blocks, pa.binary()),
                }
            )

    schema = "block int, part int, seen long, weights binary"

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, first = None, 0, None
        for batch in batches:
            for block, part, n, data in records(batch, "block", "part", "seen", "weights"):
                own = np.frombuffer(data)
                total, seen, first = own if total is None else total + own, seen + n, first or (block, part)
        if first:
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([first[0]], pa.int32()),
                    "part": pa.array([0], pa.int32()),
                    "seen": pa.array([seen], pa.int64()),
                    "weights": pa.array([total.tobytes()], pa.binary()),
                }
            )

    models = rows.select("slots").mapInArrow(run, schema)
    summed = models.groupBy("block", "part").applyInArrow(added, schema).groupBy("block").applyInArrow(added, schema)
    blocks = sorted(summed.collect(), key=lambda r: r["block"])
    if not blocks:
        return flat
    return np.concatenate([np.frombuffer(r["weights"]) / r["seen"] for r in blocks]).astype(np.float32)


def _looked_up(docs: DataFrame, id: str, text: str, others: list[str], lexicon) -> DataFrame:
    """Per document: its slots, sums over frequent words and tails, and its other words
    with their numbers. `row` tells rows apart once the result is stored."""
    kinds = {field.name: field.dataType.simpleString() for field in docs.schema}
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in (id, *others)) + (
        ", row long, n_tokens long, n_frequent long, base double, tails double, slots binary,"
        " rare array<struct<word: binary, n: long>>"
    )
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        logs = np.log10(lex.counts + 0.5)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = []
            for (value,) in records(batch, text):
                tokens = [*words(value), END]
                at, slots, tails = lex.look_up(tokens)
                known = at >= 0
                base = logs[at[known]]
                in_tail = known & (tails >= 0)
                # Of words in a tail the count's part; for those not broadcast it follows by a join.
                rest = logs[at[in_tail]].sum() - lex.tail_norm[tails[tails >= 0]].sum()
                rare = Counter(tokens[j] for j in np.flatnonzero(~known).tolist())
                rows = [{"word": w, "n": n} for w, n in rare.items()]
                found.append((len(tokens), int(known.sum()), float(base.sum()), float(rest), slots.astype(np.int16).tobytes(), rows))
            if not found:
                continue
            n_tokens, frequent, base, rest, slots, rare = map(list, zip(*found, strict=True))
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in (id, *others)}
                | {
                    "row": pa.array(range(row, row + len(found)), pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "n_frequent": pa.array(frequent, pa.int64()),
                    "base": pa.array(base, pa.float64()),
                    "tails": pa.array(rest, pa.float64()),
                    "slots": pa.array(slots, pa.binary()),
                    "rare": pa.array(rare, rare_type),
                }
            )
            row += len(found)

    return docs.select(id, *others, text).mapInArrow(run, schema)


def _scored(rows: DataFrame, flat: np.ndarray) -> DataFrame:
    """(row, slots): the log probability of each document's slots, and of its words in tails."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.unpack(flat)

        def scored(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk = [own for batch in held for own in _unpacked(batch.column("slots").to_pylist())]
            found = gru.log_probabilities(model, chunk) / math.log(10)
            number = np.concatenate([batch.column("row").to_numpy() for batch in held])
            tails = np.concatenate([batch.column("tails").to_numpy() for batch in held])
            yield pa.RecordBatch.from_pydict({"row": pa.array(number), "slots": pa.array(found + tails)})

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("slots").nbytes // 2
            if size >= CHUNK:
                yield from scored(held)
                held, size = [], 0
        if size:
            yield from scored(held)

    return rows.select("row", "tails", "slots").mapInArrow(run, "row long, slots double")


def score_documents(docs: DataFrame, learn_from: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log probabilities (base 10) of every whole text.

    Tokens are the words between ASCII white space, A-Z in lower case, then one end.
    `learn_from` marks the rows that may be learned from. Returns per input row
    `id`, `held_out`, `n_tokens`, `n_known` (tokens seen in training), `train_tokens`,
    `base_score` (the smoothed word counts) and `score` (the network's).

    Null and empty texts are an end alone. Rows that repeat an id are rows of their
    own. Without training rows, every word is as likely as any and both scores go by
    counts of nothing. Other columns are not read, but for those of `learn_from`.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(learn_from, F.lit(False)).alias("learn"))
    counts = stored(count_words(rows.where("learn"), "text"), "counts")
    lex = Lexicon(counts)
    lexicon = spark.sparkContext.broadcast(lex)
    flat = gru.pack(gru.new_model(lex.mass))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(16)).alias("part")
    rows = rows.select("id", "learn", part, "text")
    found = stored(_looked_up(rows, "id", "text", ["learn", "part"], lexicon), "slots")
    for begin, end in ROUNDS:
        flat = _learned(found.where(F.col("learn") & (F.col("part") >= begin) & (F.col("part") < end)), flat)
    scores = _scored(found, flat).withColumnRenamed("row", "scored")

    rare = found.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("w"), F.col("r.n").alias("n"))
    seen = rare.join(counts.select("word", "c"), F.col("w") == F.col("word"), "left")
    sums = seen.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
    )
    found = found.select("id", "learn", "row", "n_tokens", "n_frequent", "base").join(scores, F.col("row") == F.col("scored"))
    logs = F.coalesce("logs", F.lit(0.0))
    return found.join(sums, F.col("row") == F.col("of"), "left").select(
        F.col("id").alias(id),
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(lex.n)).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(lex.base_norm)).alias("base_score"),
        (F.col("slots") + logs).alias("score"),
    )
