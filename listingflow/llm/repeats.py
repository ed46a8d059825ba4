"""Maximal runs of repeated words, found with an enhanced suffix array.

A run of period q is a stretch whose words q apart are identical and that no
neighbouring word extends. Its last two periods are a square that cannot be shifted
to the right: the two suffixes q apart that begin it share exactly q words, so they
lie in one LCP interval of depth q and part there. For each interval only the
suffixes on its smaller side are walked, and each asks the inverse suffix array
whether the suffix q before or behind it lies on the other side. Such a square is
then rotated to the left as far as the words agree, which gives the whole run;
squares of one stretch are merged under their smallest period.

No tree is built. All steps are numpy operations over the words of many documents
at once; a suffix is ordered by its document first, so that none meets another's.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from listingflow.llm.common import prepare

# Words of whole documents that are worked on at once; a longer document goes alone.
# A word takes some 100 bytes, and 4 more for each doubling of the longest repeat.
WORDS_AT_ONCE = 1 << 17

SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two are equal.

    `codes` tells documents apart; `ends[i]` is the end of the document of word i.
    Entry k holds equal ranks exactly where the first 2**k words are equal. The last
    entry is the inverse suffix array.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    slot = np.arange(n)
    begins = np.ones(n, bool)
    begins[1:] = ranked[1:] != ranked[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, slot, 0))
    levels = [rank.astype(np.int32)]
    step = 1
    while True:
        shared = ~begins
        shared[:-1] |= ~begins[1:]
        slots = np.flatnonzero(shared)
        if not len(slots):
            return levels
        at = order[slots]
        then = at + step
        inside = then < ends[at]
        follow = np.where(inside, rank[np.where(inside, then, 0)], -1)
        key = rank[at] * (n + 1) + follow + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        begins[slots] = fresh
        levels.append(rank.astype(np.int32))
        step *= 2


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Number of words that the suffixes at `a` and at `b` (never equal) share."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < n
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        length += same << k
    return length


def reach(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Number of words before `i` that equal those before `j` (i < j), down to `begin`."""
    length = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = i - length - (1 << k)
        inside = x >= begin
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, j - length - (1 << k), 0)])
        length += same << k
    return length


def bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place `at` of `lcp`: the nearest place to its left that holds less, and
    the nearest to its right that holds less or as much (or the length of `lcp`).

    `lcp[0]` has to be less than all values asked for. Minima of stretches of 1, 2,
    4, ... places are made only as far as the longest stretch without a zero needs.
    """
    n = len(lcp)
    zeros = np.append(np.flatnonzero(lcp <= 0), n)
    longest = int(np.diff(zeros).max()) if len(zeros) > 1 else n
    least = [lcp]
    while (1 << len(least)) <= longest:
        half = 1 << (len(least) - 1)
        last = least[-1]
        wide = last.copy()
        wide[: n - half] = np.minimum(last[: n - half], last[half:])
        least.append(wide)
    value = lcp[at]
    left = at - 1  # everything between `left` and `at` is not less
    right = at + 1
    for k in range(len(least) - 1, -1, -1):
        span = 1 << k
        start = left - span + 1
        inside = start >= 0
        left = np.where(inside & (least[k][np.where(inside, start, 0)] >= value), left - span, left)
        inside = right + span <= n
        right = np.where(inside & (least[k][np.where(inside, right, 0)] > value), right + span, right)
    return left, right


def squares(levels: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that cannot be shifted to the right."""
    place = levels[-1].astype(np.int64)
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp[near] = common(levels, order[near - 1], order[near], n)
    left, right = bounds(lcp, near)
    # Each place splits its interval: suffixes [left, near) on one side, [near, right) on the other.
    smaller_left = near - left <= right - near
    begin = np.where(smaller_left, left, near)
    size = np.where(smaller_left, near - left, right - near)
    low, high = np.where(smaller_left, near, left), np.where(smaller_left, right, near)
    split = np.repeat(np.arange(len(near)), size)
    own = order[np.arange(len(split)) - np.repeat(np.cumsum(size) - size, size) + begin[split]]
    depth, low, high = lcp[near][split], low[split], high[split]
    starts, periods = [], []
    for other, first in ((own + depth, own), (own - depth, own - depth)):
        inside = (other >= 0) & (other < n)
        there = place[np.where(inside, other, 0)]
        hit = np.flatnonzero(inside & (there >= low) & (there < high))
        starts.append(first[hit])
        periods.append(depth[hit])
    return np.concatenate(starts), np.concatenate(periods)


def runs(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int, times: int) -> np.ndarray:
    """(start, end, period) of all runs of at least `least` words and `times` periods, in order.

    `begins[i]` and `ends[i]` bound the document of word i.
    """
    n = len(codes)
    if not n:
        return np.zeros((0, 3), np.int64)
    levels = suffix_ranks(codes, ends)
    start, period = squares(levels, n)
    fits = np.maximum(times * period, least) <= ends[start] - begins[start]
    start, period = start[fits], period[fits]
    rotated = reach(levels, start, start + period, begins[start])
    found = np.stack([start - rotated, start + 2 * period, period], axis=1)
    length = found[:, 1] - found[:, 0]
    found = found[length >= np.maximum(times * found[:, 2], least)]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)  # a stretch is named once, under its smallest period
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _worked(texts: list[list[bytes]], least: int, times: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """Per document: number of words, its runs, and the words that stay."""
    sizes = np.array([len(words) for words in texts], np.int64)
    offsets = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    # The same word of two documents has two codes, in the documents' order.
    codes = np.empty(total, np.int64)
    used = 0
    for words, at in zip(texts, offsets.tolist(), strict=True):
        known: dict[bytes, int] = {}
        codes[at : at + len(words)] = [known.setdefault(word, len(known)) for word in words]
        codes[at : at + len(words)] += used
        used += len(known)
    begins, ends = np.repeat(offsets, sizes), np.repeat(offsets + sizes, sizes)
    found = runs(codes, begins, ends, least, times)
    # What any run holds behind its first period goes.
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 1], -1)
    dropped = np.cumsum(depth) > 0
    cuts = np.searchsorted(found[:, 0], np.append(offsets, total))
    for k, words in enumerate(texts):
        own = found[cuts[k] : cuts[k + 1]]
        if not len(own):
            yield len(words), [], b" ".join(words)
            continue
        at = int(offsets[k])
        stays = np.flatnonzero(~dropped[at : at + len(words)]).tolist()
        listed = [{"start": s - at, "length": e - s, "period": p} for s, e, p in own.tolist()]
        yield len(words), listed, b" ".join([words[i] for i in stays])


def find_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """Runs of repeated words in every whole text, and the text without the repeats.

    Words are what stands between ASCII white space, exactly as written. Returns per
    input row `id`, `n_words`, `runs` (start in words, length, smallest period; by
    start, then period) of all runs of at least `least` words and `times` periods
    (2 or more), and `collapsed`: the words that no run holds behind its first period, joined
    by one space.

    A null, empty or blank text has no words, no runs and an empty `collapsed`. Each
    input row gives one row, repeated rows and null ids too; other columns are not
    read. The time grows with n log n of a document's words, whatever they are.
    """
    if times < 2:
        raise ValueError("a run has at least two periods")
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, list[dict], bytes]] = []
            waiting: list[list[bytes]] = []
            held = 0
            for value in batch.column(text).cast(pa.binary()).to_pylist():
                words = value.split() if value else []
                if waiting and held + len(words) > WORDS_AT_ONCE:
                    rows += _worked(waiting, least, times)
                    waiting, held = [], 0
                waiting.append(words)
                held += len(words)
            rows += _worked(waiting, least, times)
            count, found, kept = map(list, zip(*rows, strict=True)) if rows else ([], [], [])
            shape = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            yield pa.RecordBatch.from_pydict(
                {
                    id: batch.column(id),
                    "n_words": pa.array(count, pa.int64()),
                    "runs": pa.array(found, shape),
                    "collapsed": pa.array(kept, pa.binary()).cast(pa.string()),
                }
            )

    return docs.select(id, text).mapInArrow(run, f"{id} {kind}, {SCHEMA}")
