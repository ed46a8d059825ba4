"""Document quality by positive-unlabelled learning.

A linear model on how a text looks (shapes of its words, case, signs, repeats) is
fitted with the non-negative unbiased risk: trusted positives stand for good text,
any text for the mixture, and an estimated share of good text takes the positives'
part out of the mixture again. Known negatives are not used at all.

The share is estimated from positives and unlabelled text alone. A first model tells
the two apart; whatever score is asked for, the part of all texts that reaches it is
at least the share times the part of the positives that does, and comes down to it
where no negative scores so high. The least of these quotients is taken, over the
scores of all texts and of positives that the first model has not seen.

The risk is first minimised on bounded samples, which gives the scale of the features
and a start; then every partition passes over all its texts in mini-batches, and the
weights are averaged by the number of texts. All fitting is done in tasks: the
driver sees the bounded positives, counts per bin of scores and the weights.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from operator import eq, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import hold_alone, prepare, records, stored

# At most about so many positives are learned from, and about so many unlabelled texts
# give the start; the pass after it takes all unlabelled texts.
POSITIVES = 4_000
START = 8_000
# Bins of scores, and the least part of the positives that a quotient is taken of.
BINS = 400
LEAST_PART = 0.25
BATCH = 512
BUCKETS = 256
# The score from which a document is taken as good.
GOOD = 0.3
SEED = 11

_LETTERS = bytes(
    ord("A") if 65 <= c <= 90 else ord("9") if 48 <= c <= 57 else ord("a") if 97 <= c <= 122 or c >= 128 else c
    for c in range(256)
)
_FIRST, _LAST = itemgetter(slice(None, 1)), itemgetter(slice(-2, None))
N_MEASURES = 11
N_FEATURES = N_MEASURES + 2 * BUCKETS


def features(text: str | None) -> np.ndarray:
    """What a text looks like; zeros for a text without words."""
    out = np.zeros(N_FEATURES, np.float32)
    data = text.encode("utf-8", "replace") if text else b""
    own = data.split()
    if not own:
        return out
    n = len(own)
    shapes = data.translate(_LETTERS)
    tokens = shapes.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    size = len(data)
    upper, digits, lower = shapes.count(b"A"), shapes.count(b"9"), shapes.count(b"a")
    counts = Counter(own)
    out[:N_MEASURES] = (
        np.log1p(n) / 10,
        size / n / 10,
        upper / size,
        digits / size,
        (size - upper - digits - lower - n) / size,
        len(counts) / n,
        sum(map(eq, own, own[1:])) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        len(lines) / n,
        sum(c for c in counts.values() if c > 1) / n,
    )
    for start, pick in ((N_MEASURES, _FIRST), (N_MEASURES + BUCKETS, _LAST)):
        for shape, count in Counter(map(pick, tokens)).items():
            out[start + zlib.crc32(shape) % BUCKETS] += count / n
    out[N_MEASURES:] = np.sqrt(out[N_MEASURES:])
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Risk:
    """Steps (Adam) on the non-negative unbiased logistic risk of a linear model.

    The risk on negatives is that of the mixture less the positives' share. Where a
    batch drives it below zero the model fits noise: the step then goes back on that
    part alone, as the method has it.
    """

    def __init__(self, weights: np.ndarray, prior: float, decay: float = 1e-4):
        self.weights, self.prior, self.decay = weights.copy(), prior, decay
        self.m, self.v = np.zeros_like(weights), np.zeros_like(weights)
        self.steps = 0

    def step(self, x: np.ndarray, z: np.ndarray, rate: float) -> None:
        """One step on a batch of positives `x` and one of unlabelled rows `z`."""
        prior, w = self.prior, self.weights
        gx, gz = x @ w[:-1] + w[-1], z @ w[:-1] + w[-1]
        rest = np.logaddexp(0, gz).mean() - prior * np.logaddexp(0, gx).mean()
        d_rest_x, d_rest_z = -prior * sigmoid(gx) / len(x), sigmoid(gz) / len(z)
        if rest >= 0:
            dx, dz = -prior * sigmoid(-gx) / len(x) + d_rest_x, d_rest_z
        else:
            dx, dz = -d_rest_x, -d_rest_z
        self.move(np.append(dx @ x + dz @ z, dx.sum() + dz.sum()), rate)

    def move(self, gradient: np.ndarray, rate: float) -> None:
        gradient[:-1] += self.decay * self.weights[:-1]
        self.steps += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        self.weights -= rate * (self.m / (1 - 0.9**self.steps)) / (np.sqrt(self.v / (1 - 0.99**self.steps)) + 1e-8)


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.02) -> np.ndarray:
    """Weights, the bias last, for rows that have been put to scale."""
    draw = np.random.default_rng(SEED)
    risk = Risk(np.zeros(positive.shape[1] + 1), prior)
    average = np.zeros_like(risk.weights)
    for step in range(1, steps + 1):
        x = positive[draw.integers(0, len(positive), BATCH)]
        z = unlabelled[draw.integers(0, len(unlabelled), BATCH)]
        risk.step(x, z, rate * min(1.0, 2 * (1 - step / (steps + 1))))
        if step > steps // 2:
            average += risk.weights
    return average / (steps - steps // 2)


def tell_apart(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, rate: float = 0.02) -> np.ndarray:
    """Weights of a logistic model that tells positives from unlabelled rows, each kind
    counting as much as the other."""
    draw = np.random.default_rng(SEED)
    model = Risk(np.zeros(positive.shape[1] + 1), 0.5, decay=1e-3)
    for step in range(1, steps + 1):
        x = positive[draw.integers(0, len(positive), BATCH)]
        z = unlabelled[draw.integers(0, len(unlabelled), BATCH)]
        dx = -sigmoid(-(x @ model.weights[:-1] + model.weights[-1])) / BATCH
        dz = sigmoid(z @ model.weights[:-1] + model.weights[-1]) / BATCH
        model.move(np.append(dx @ x + dz @ z, dx.sum() + dz.sum()), rate * min(1.0, 2 * (1 - step / (steps + 1))))
    return model.weights


def share_of_positives(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share from counts per bin of scores, lowest bin first.

    The least quotient of the parts at or above a score, less two standard errors:
    a share a little too low costs little, one too high takes negatives for positives.
    """
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    part_p = np.cumsum(positive[::-1])[::-1] / n_p
    part_u = np.cumsum(unlabelled[::-1])[::-1] / n_u
    use = part_p >= LEAST_PART
    p, u = part_p[use], part_u[use]
    error = np.sqrt(u * (1 - u) / n_u + (u / p) ** 2 * p * (1 - p) / n_p) / p
    least = np.argmin(u / p)
    return float(np.clip((u / p - 2 * error)[least], 0.01, 0.99))


def _bin(features: np.ndarray, model: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    found = sigmoid((features - mean) / scale @ model[:-1] + model[-1])
    return np.bincount(np.minimum((found * BINS).astype(int), BINS - 1), minlength=BINS)


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, N_FEATURES)


def _featured(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        for batch in batches:
            rows = [features(value).tobytes() for (value,) in records(batch, text)]
            yield pa.RecordBatch.from_pydict({"features": pa.array(rows, pa.binary())})

    return docs.select(text).mapInArrow(run, "features binary")


def _about(key: Column, size: int, of: int) -> Column:
    """Holds for about `size` of `of` rows: those with the lowest hashes."""
    return F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, size / max(of, 1)))


def _positive_rows(docs: DataFrame, ids: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Features of the labelled documents. Of an id with several texts the least counts."""
    ids = ids.distinct()
    chosen = ids.where(_about(F.col("labelled"), size, ids.count()))
    rows = docs.join(chosen, F.col(id) == F.col("labelled"), "left_semi").groupBy(id).agg(F.min(text).alias(text))
    return _featured(rows, text)


def _start(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, first model, bins of the positives it has not seen)."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0, np.float64).astype(np.float32), both.std(0, dtype=np.float64).astype(np.float32) + np.float32(0.02)
    seen, unseen = (positive[0::2], positive[1::2]) if len(positive) > 1 else (positive, positive)
    first = tell_apart((seen - mean) / scale, (unlabelled - mean) / scale)
    return mean, scale, first, _bin(unseen, first, mean, scale)


def _in_one_task(samples: DataFrame, work: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """What `work` makes of the two bounded samples, in a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        rows: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for kind, row in records(batch, "kind", "features"):
                rows[kind].append(row)
        if rows[0] and rows[1]:
            made = work(_matrix(rows[1]), _matrix(rows[0]))
            yield pa.RecordBatch.from_pydict({"made": pa.array([np.asarray(m, np.float64).tolist() for m in made], pa.list_(pa.float64()))})

    ordered = samples.repartition(1).sortWithinPartitions("kind", "features")
    return [np.array(r.made) for r in ordered.mapInArrow(run, "made array<double>").collect()]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
    positives: int = POSITIVES, prior: float | None = None,
) -> tuple[np.ndarray, float]:
    """Fit on positives of `labels` and all texts of `docs`.

    `labels` holds only rows that may be learned from; about `positives` of the
    positive ones are used, chosen by hashes of their ids. Null labels and ids are
    no labels; of an id with several texts the least in order counts. The prior is
    estimated (`share_of_positives`) unless given. Without any positive or any text the
    model is constant, at the prior or 0.5. Other columns are not read.
    """
    prepare(docs.sparkSession)
    docs = docs.select(id, text)
    known = labels.select(F.col(id).alias("labelled"), F.col(label).cast("double").alias("found"))
    known = known.where("found > 0.5 and labelled is not null").select("labelled")
    some = docs.where(_about(F.hash(id, text), START, docs.count()))
    trusted = _positive_rows(docs, known, id, text, positives).withColumn("kind", F.lit(1))
    samples = stored(trusted.unionByName(_featured(some, text).withColumn("kind", F.lit(0))), "quality-samples")
    made = _in_one_task(samples, _start)
    if not made:
        share = 0.5 if prior is None else min(max(prior, 0.01), 0.99)
        return np.zeros(N_FEATURES), float(np.log(share / (1 - share)))
    mean, scale, first, seen = made
    if prior is None:
        prior = share_of_positives(seen, _all_bins(docs, text, first, mean, scale))
    prior = min(max(prior, 0.01), 0.99)
    (start,) = _in_one_task(samples, lambda p, u: (fit_nnpu((p - mean) / scale, (u - mean) / scale, prior),))
    weights = _all_rows(docs, samples, text, start, mean, scale, prior)
    return weights[:-1] / scale, float(weights[-1] - (weights[:-1] * mean / scale).sum())


def _all_bins(docs: DataFrame, text: str, model: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """How many of all texts score in each bin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            rows = np.array([features(value) for (value,) in records(batch, text)], np.float32).reshape(-1, N_FEATURES)
            counts += _bin(rows, model, mean, scale)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(np.arange(BINS)), "n": pa.array(counts)})

    found = docs.select(text).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    return np.array([r.n for r in found.orderBy("bin").collect()])


def _all_rows(
    docs: DataFrame, samples: DataFrame, text: str, start: np.ndarray, mean: np.ndarray, scale: np.ndarray,
    prior: float, rate: float = 0.002,
) -> np.ndarray:
    """The weights after each partition has passed over all its texts once, averaged."""
    rows = samples.where("kind = 1").select("features").toArrow().column("features").to_pylist()
    trusted = docs.sparkSession.sparkContext.broadcast(b"".join(sorted(rows)))  # bounded by the positives
    del rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        positive = (np.frombuffer(trusted.value, np.float32).reshape(-1, N_FEATURES) - mean) / scale
        draw = np.random.default_rng(SEED)
        risk = Risk(start, prior)
        average, seen = np.zeros_like(start), 0

        def learn(own: list[np.ndarray]) -> None:
            nonlocal average, seen
            # A batch that is not full counts for as much as it holds.
            x = positive[draw.integers(0, len(positive), BATCH)]
            risk.step(x, (np.array(own) - mean) / scale, rate * len(own) / BATCH)
            average += len(own) * risk.weights
            seen += len(own)

        waiting: list[np.ndarray] = []
        for batch in batches:
            for (value,) in records(batch, text):
                waiting.append(features(value))
                if len(waiting) == BATCH:
                    learn(waiting)
                    waiting = []
        if waiting:
            learn(waiting)
        if seen:
            yield pa.RecordBatch.from_pydict(
                {"at": pa.array(np.arange(len(start))), "total": pa.array(average), "seen": pa.array(np.full(len(start), seen))}
            )

    sums = docs.select(text).mapInArrow(run, "at long, total double, seen long")
    sums = sums.groupBy("at").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen")).orderBy("at").collect()
    return np.array([r.total / r.seen for r in sums])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `score`, the probability of good quality, for every whole text.

    One row per input row; null and empty texts have the score of a text without
    words. Other columns are not read.
    """
    prepare(docs.sparkSession)
    weights, bias = model[0].astype(np.float64), model[1]
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        for batch in batches:
            found = np.array([features(value) @ weights for (value,) in records(batch, text)], float)
            yield pa.RecordBatch.from_pydict(
                {id: batch.column(id), "score": pa.array(sigmoid(found + bias), pa.float64())}
            )

    return docs.select(id, text).mapInArrow(run, f"{id} {kind}, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float, text: str = "text") -> DataFrame:
    """The rows of `docs`, whole, whose text scores at least `threshold`."""
    prepare(docs.sparkSession)
    weights, bias = model

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone()
        for batch in batches:
            found = np.array([features(value) @ weights for (value,) in records(batch, text)], float)
            yield batch.filter(pa.array(sigmoid(found + bias) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def accepted(score: Column, threshold: float = GOOD) -> Column:
    return score >= threshold
