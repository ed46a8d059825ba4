"""Near-duplicate vectors by counting collisions on sorted projections.

A vector is projected on many random lines. On each line it collides with those
whose projections lie in a window around its own. Pairs with few collisions are
left alone; the others are compared exactly. So that windows stay short however
many vectors there are, each line is sorted by the signs of a few further
projections first: their number grows with the logarithm of the table, and the
number of lines is set such that a pair at the threshold reaches the count with a
stated probability.

A pair is dealt with on the first line it collides on, from all lines' projections
of its two vectors, which are recomputed there: no pairs are shuffled, and none is
counted twice.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import prepare, stored
from listingflow.llm.components import components

SEED = 20240117
# Vectors that one sign pattern should hold, and the most that one task takes at once.
CELL = 192
BLOCK = 2048
# Half a window, in standard deviations of the distance at the threshold.
WIDTH = 2.0
LEAST_COUNT = 2
PAIRS_AT_ONCE = 1 << 19


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(signs, lines) for `n` vectors: a pair at the threshold counts at least
    LEAST_COUNT collisions with probability `recall`."""
    signs = max(0, min(24, round(math.log2(max(n, 1) / CELL))))
    same_sign = 1 - math.acos(threshold) / math.pi
    hit = math.erf(WIDTH / math.sqrt(2)) * same_sign**signs
    lines = LEAST_COUNT
    while True:
        missed = sum(math.comb(lines, k) * hit**k * (1 - hit) ** (lines - k) for k in range(LEAST_COUNT))
        if 1 - missed >= recall:
            return signs, lines
        lines += 1


def directions(dim: int, signs: int, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """The random lines (dim x lines) and the sign planes (dim x lines * signs)."""
    draw = np.random.default_rng([SEED, dim])
    return draw.standard_normal((dim, lines)), draw.standard_normal((dim, lines * signs))


def project(vectors: np.ndarray, signs: int, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions on every line, and the sign pattern that leads each."""
    on, planes = directions(vectors.shape[1], signs, lines)
    sides = (vectors @ planes > 0).reshape(len(vectors), lines, signs)
    return vectors @ on, sides @ (1 << np.arange(signs, dtype=np.int64))


def _unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1; None if it is null, zero or not finite."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    largest = np.abs(vector).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    vector = vector / largest + 0.0
    return vector / np.sqrt((vector**2).sum())


def _cleaned(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, node, dim, unit): `node` is a digest of the vector, null if it links with nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v) for v in batch.column(vector).to_pylist()]
            data = [None if u is None else u.tobytes() for u in units]
            nodes = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_pydict(
                {
                    id: batch.column(id),
                    "node": pa.array(nodes, pa.binary()),
                    "dim": pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                    "unit": pa.array(data, pa.binary()),
                }
            )

    kind = vectors.schema[id].dataType.simpleString()
    return vectors.select(id, vector).mapInArrow(run, f"{id} {kind}, node binary, dim int, unit binary")


def _placed(nodes: DataFrame, signs: int, lines: int) -> DataFrame:
    """A row per node and line: where it is found there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            units = batch.column("unit").to_pylist()
            cells = np.empty((len(units), lines), np.int64)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                matrix = np.frombuffer(b"".join(units[k] for k in own)).reshape(len(own), dim)
                cells[own] = project(matrix, signs, lines)[1]
            row = np.repeat(np.arange(len(units)), lines)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node").take(pa.array(row)),
                    "dim": batch.column("dim").take(pa.array(row)),
                    "line": pa.array(np.tile(np.arange(lines, dtype=np.int32), len(units))),
                    "cell": pa.array(cells.ravel()),
                }
            )

    return nodes.select("node", "dim", "unit").mapInArrow(run, "node binary, dim int, line int, cell long")


class _Group:
    """The vectors of one cell, or of two blocks of a crowded one."""

    def __init__(self, line: int, cross: bool, rows: list[tuple]):
        self.line, self.cross = line, cross
        self.nodes = [r[0] for r in rows]
        self.copies = np.array([r[1] for r in rows], np.int64)
        self.block = np.array([r[2] for r in rows], np.int64)
        self.units = np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), -1)

    def links(self, signs: int, lines: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs at or above the threshold that collide here first."""
        at, cell = project(self.units, signs, lines)
        order = np.argsort(at[:, self.line], kind="stable")
        at, cell, units, block = at[order], cell[order], self.units[order], self.block[order]
        half = WIDTH * math.sqrt(2 * (1 - threshold))
        here = at[:, self.line]
        last = np.searchsorted(here, here + half, "right")
        count = last - np.arange(len(here)) - 1
        begin = 0
        while begin < len(here):
            end = begin + max(1, int(np.searchsorted(np.cumsum(count[begin:]), PAIRS_AT_ONCE)))
            own = count[begin:end]
            x = np.repeat(np.arange(begin, begin + len(own)), own)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(own) - own, own)
            begin = end
            if self.cross:
                apart = block[x] != block[y]
                x, y = x[apart], y[apart]
            # Not seen on a line before, and on enough lines after this one.
            for before in range(self.line):
                met = (cell[x, before] == cell[y, before]) & (np.abs(at[x, before] - at[y, before]) <= half)
                x, y = x[~met], y[~met]
            collisions = np.ones(len(x), np.int32)
            for after in range(self.line + 1, lines):
                collisions += (cell[x, after] == cell[y, after]) & (np.abs(at[x, after] - at[y, after]) <= half)
            x, y = x[collisions >= LEAST_COUNT], y[collisions >= LEAST_COUNT]
            cosine = np.einsum("ij,ij->i", units[x], units[y])
            near = cosine >= threshold
            yield order[x[near]], order[y[near]]

    def summary(self, signs: int, lines: int, threshold: float) -> list[tuple[bytes, int, bytes]]:
        """(node, vectors linked with it here, smallest node it is tied to here)."""
        linked = np.zeros(len(self.nodes), np.int64)
        parent = list(range(len(self.nodes)))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for x, y in self.links(signs, lines, threshold):
            np.add.at(linked, x, self.copies[y])
            np.add.at(linked, y, self.copies[x])
            for a, b in zip(x.tolist(), y.tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    low, high = (a, b) if self.nodes[a] < self.nodes[b] else (b, a)
                    parent[high] = low
        return [(self.nodes[k], int(linked[k]), self.nodes[root(k)]) for k in np.flatnonzero(linked)]


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id: str = "vec_id", vector: str = "embedding", recall: float = 0.999
) -> DataFrame:
    """Vectors with the number of others near them, and their connected groups.

    Two vectors are linked if their cosine in double precision is at least
    `threshold`; a pair just at it is found with probability `recall`, a nearer
    one with more. Returns per input row `id`, `n_links` (other rows linked
    directly), `component_id` (the smallest id reachable, its own included) and
    `kept` (`id = component_id`).

    Null, empty and zero vectors and those with null or infinite components link
    with nothing; vectors of different lengths do not link. Equal vectors are
    compared once and counted as often as they occur. Rows that repeat an id count
    as rows. Other columns are not read.
    """
    prepare(vectors.sparkSession)
    rows = stored(_cleaned(vectors, id, vector), "vectors")
    nodes = rows.where("node is not null").groupBy("node", "dim").agg(
        F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min(id).alias("least_id")
    )
    nodes = stored(nodes, "nodes")
    signs, lines = plan(nodes.count(), threshold, recall)
    places = stored(_placed(nodes, signs, lines), "places")
    sizes = places.groupBy("line", "dim", "cell").agg(F.count("*").alias("size"))
    # A crowded cell is dealt into blocks, and each two of them make a group.
    blocks = sizes.where("size > 1").select(
        "line", "dim", "cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    dealt = places.join(blocks, ["line", "dim", "cell"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "line"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "node", "line", "dim", "cell", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    key = ["line", "dim", "cell", "low", "high"]
    full = dealt.join(nodes.select("node", "unit", "copies"), "node")
    grouped = full.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[_Group]:
            now, members = None, []
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in (*key, "node", "copies", "block", "unit")), strict=True):
                    if row[:5] != now:
                        if len(members) > 1:
                            yield _Group(now[0], now[3] != now[4], members)
                        now, members = row[:5], []
                    members.append(row[5:])
            if len(members) > 1:
                yield _Group(now[0], now[3] != now[4], members)

        for group in groups():
            found = group.summary(signs, lines, threshold)
            if found:
                node, linked, tied = map(list, zip(*found, strict=True))
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(node, pa.binary()), "linked": pa.array(linked, pa.int64()), "tied": pa.array(tied, pa.binary())}
                )

    found = stored(grouped.mapInArrow(run, "node binary, linked long, tied binary"), "ties")
    label = stored(components(found.select("node", "tied")), "components")
    linked = found.groupBy(F.col("node").alias("n")).agg(F.sum("linked").alias("linked"))
    known = (
        nodes.join(linked, F.col("node") == F.col("n"), "left")
        .join(label.withColumnRenamed("node", "l"), F.col("node") == F.col("l"), "left")
        .select("node", "copies", "linked", "least_id", F.coalesce("component", "node").alias("component"))
    )
    least = known.groupBy(F.col("component").alias("c")).agg(F.min("least_id").alias("component_id"))
    known = known.join(least, F.col("component") == F.col("c")).select(
        F.col("node").alias("k"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    own = F.coalesce("component_id", id)
    return rows.join(known, F.col("node") == F.col("k"), "left").select(
        id,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col(id) == own, F.lit(False)).alias("kept"),
    )
