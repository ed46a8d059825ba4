"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after another. Each model sees the words of a text
and the probabilities of the categories before it. Those it learns from are
out-of-fold, so that they are as uncertain as they will be for new texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import prepare, records

# At most so many labelled rows are fitted on.
SAMPLE = 10_000
FOLDS = 4
BUCKETS = 1 << 18
# Chained probabilities are features like words, as log odds with this weight.
CHAIN_WEIGHT = 0.25
# Lengths in bytes of the beginnings of words.
STEMS = (4, 5, 6, 7)
# A word counts if it is in so many texts of the sample, and if its log odds are
# so many standard errors from 0: words that tell nothing are by far the most.
MIN_TEXTS = 4
CERTAIN = 3.5

# Letters in lower case stay; digits, signs and white space separate words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def buckets(text: str | None) -> np.ndarray:
    """Hashed distinct words of a text, and the beginnings that inflected words share."""
    own = set(text.encode("utf-8", "replace").translate(_LETTERS).split()) if text else set()
    stems = {word[:n] + b"-" for n in STEMS for word in own if len(word) >= n}
    return np.unique(np.fromiter((zlib.crc32(w) % BUCKETS for w in own | stems), np.int32))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches values[starts[i]:starts[i + 1]]; 0 for empty ones."""
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


class Linear:
    """A logistic model on words, each scaled by its smoothed log odds of the label."""

    def __init__(self, n_chain: int):
        self.weights = np.zeros(BUCKETS)
        self.chain = np.zeros(n_chain)
        self.bias = 0.0

    def raw(self, index: np.ndarray, starts: np.ndarray, chain: np.ndarray) -> np.ndarray:
        return _sums(self.weights[index], starts) + chain @ self.chain + self.bias

    def fit(self, index: np.ndarray, starts: np.ndarray, chain: np.ndarray, y: np.ndarray, steps: int = 60) -> Linear:
        row = np.repeat(np.arange(len(y)), np.diff(starts))
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.bias = float(np.log(rate / (1 - rate)))
        if not len(y) or y.min() == y.max():
            return self
        yes = np.bincount(index, y[row], BUCKETS)
        no = np.bincount(index, 1 - y[row], BUCKETS)
        scale = np.log((yes + 0.5) / (y.sum() + 1)) - np.log((no + 0.5) / ((1 - y).sum() + 1))
        error = np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
        scale *= (yes + no >= MIN_TEXTS) & (np.abs(scale) >= CERTAIN * error)
        used = np.flatnonzero(scale)
        place = np.full(BUCKETS, -1)
        place[used] = np.arange(len(used))
        keep = place[index] >= 0
        column, own, factor = place[index][keep], row[keep], scale[index][keep]
        w, c, b = np.zeros(len(used)), np.zeros(chain.shape[1]), self.bias
        gw, gc, gb = (np.full(np.shape(x), 1e-6) for x in (w, c, b))
        for _ in range(steps):
            z = np.bincount(own, w[column] * factor, len(y)) + chain @ c + b
            d = (0.5 + 0.5 * np.tanh(0.5 * z) - y) / len(y)
            dw = np.bincount(column, d[own] * factor, len(used)) + 1e-5 * w
            dc, db = d @ chain, d.sum()
            gw, gc, gb = gw + dw**2, gc + dc**2, gb + db**2
            w, c, b = (x - 0.3 * dx / np.sqrt(gx) for x, dx, gx in ((w, dw, gw), (c, dc, gc), (b, db, gb)))
        self.weights[used] = w * scale[used]
        self.chain, self.bias = c, float(b)
        return self


def fit_chain(index: np.ndarray, starts: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of `labels` (0, 1 or NaN: unknown), in order.

    `folds` deals the rows into parts; the probability that a later model learns
    with comes from a model that has not seen the row's part.
    """
    models, chain = [], np.zeros((len(labels), 0))

    def rows(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(starts)
        return index[np.repeat(mask, sizes)], np.concatenate(([0], np.cumsum(sizes[mask])))

    for y in labels.T:
        known = ~np.isnan(y)
        own = Linear(chain.shape[1]).fit(*rows(known), chain[known], y[known])
        models.append(own)
        out = np.zeros(len(y))
        for fold in np.unique(folds):
            learn, rest = known & (folds != fold), folds == fold
            part = Linear(chain.shape[1]).fit(*rows(learn), chain[learn], y[learn])
            out[rest] = part.raw(*rows(rest), chain[rest])
        chain = np.column_stack([chain, CHAIN_WEIGHT * np.clip(out, -8, 8)])
    return models


def apply_chain(models: list[Linear], index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probabilities, a column per category."""
    n = len(starts) - 1
    chain, out = np.zeros((n, 0)), []
    for model in models:
        raw = model.raw(index, starts, chain)
        out.append(0.5 + 0.5 * np.tanh(0.5 * raw))
        chain = np.column_stack([chain, CHAIN_WEIGHT * np.clip(raw, -8, 8)])
    return np.column_stack(out) if out else np.zeros((n, 0))


def _joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    return np.concatenate([np.empty(0, np.int32), *rows]), starts


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> list[Linear]:
    """Fit the chain on at most `sample` labelled rows, the first by hashes of their ids.

    `labels` holds one row per id with a 0/1 column for each category, in the
    order of the chain; a null is unknown and not learned from. A category that
    has one value only gets a constant model.
    """
    prepare(docs.sparkSession)
    chosen = labels.select(F.col(id).alias("_id"), *(F.col(c).cast("double").alias(f"_y{k}") for k, c in enumerate(categories)))
    chosen = chosen.where("_id is not null").dropDuplicates(["_id"])
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    names = [f"_y{k}" for k in range(len(categories))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [buckets(value).tobytes() for (value,) in records(batch, text)]
            yield pa.RecordBatch.from_pydict(
                {"_id": batch.column("_id"), "_words": pa.array(rows, pa.binary())}
                | {name: batch.column(name) for name in names}
            )

    rows = docs.select(id, text).join(chosen, F.col(id) == F.col("_id")).dropDuplicates(["_id"])
    rows = rows.select(F.col("_id").cast("string"), text, *names)
    fields = ", ".join(f"{name} double" for name in names)
    found = rows.mapInArrow(run, f"_id string, _words binary, {fields}").toArrow().to_pandas()
    index, starts = _joined([np.frombuffer(w, np.int32) for w in found["_words"]])
    folds = np.array([zlib.crc32(i.encode()) // 5 % FOLDS for i in found["_id"]], np.int64)
    return fit_chain(index, starts, found[names].to_numpy(float), folds)


def score(
    docs: DataFrame, models: list[Linear], categories: Sequence[str], id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`id` and a probability `p_<category>` for each category, for every whole text.

    One row per input row. Null and empty texts have no words and get the models'
    base rates. Other columns are not read.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)  # of fixed size: BUCKETS weights a category
    kind = docs.schema[id].dataType.simpleString()
    names = [f"p_{c}" for c in categories]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, starts = _joined([buckets(value) for (value,) in records(batch, text)])
            found = apply_chain(shared.value, index, starts)
            yield pa.RecordBatch.from_pydict(
                {id: batch.column(id)} | {name: pa.array(found[:, k], pa.float64()) for k, name in enumerate(names)}
            )

    fields = ", ".join(f"`{name}` double" for name in names)
    return docs.select(id, text).mapInArrow(run, f"{id} {kind}, {fields}")
