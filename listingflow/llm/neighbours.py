"""Nearest vectors by inner product: a neighbour graph by NN-descent, greedy search on it.

Equal vectors are one node. Nodes of one length and one octave of norm make a space;
there the largest inner product is the smallest angle once a component is added that
gives all nodes the same length. The graph holds the nearest nodes known of each
node. It begins with groups that lie on the same sides of random planes. Then nodes
that have a neighbour in common are introduced to each other, in rounds of joins,
until few lists change; pairs met before are not compared again.

A query goes through each space of its length. It begins at its own node and at a
few nodes of the space, keeps the best it has met, and asks the neighbours of those
it has not asked yet, until there is none. Graph and search compare 16-bit codes; the
best found are compared exactly.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.common import discard, prepare, stored

SEED = 20240229
# Neighbours of a node, groupings that the graph begins with, nodes of one such group.
DEGREE = 32
TREES = 8
LEAF = 256
# Nodes with one neighbour in common that are compared at once; more are dealt into
# blocks, anew in each round.
BLOCK = 512
# Rounds end when less than this share of the graph changed.
SETTLED = 0.02
ROUNDS = 12
# Best nodes that a search keeps, nodes of each space that it begins at, and how many
# of the best are compared exactly for each result asked for.
KEPT = 128
ENTRIES = 32
EXACT = 3
SEARCH_ROUNDS = 40


def _vector(values: list | None) -> np.ndarray | None:
    """The vector; None if it is null, zero or not finite."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64) + 0.0
    return vector if np.isfinite(vector).all() and vector.any() else None


def _octave(vector: np.ndarray) -> int:
    largest = np.abs(vector).max()
    return round(math.log2(largest) + math.log2(np.sqrt(((vector / largest) ** 2).sum())))


def encode(vector: np.ndarray, octave: int | None) -> bytes:
    """16-bit components, their scale, and the component that is added.

    `octave` is that of a node's space; without it the vector is a query, of length
    1 and with nothing added.
    """
    largest = np.abs(vector).max()
    own = vector / largest
    norm = np.sqrt((own**2).sum())
    size = 1.0 if octave is None else 2.0 ** (math.log2(largest) + math.log2(norm) - octave - 0.51)
    own *= size / norm
    scale = np.abs(own).max() / 32767
    added = 0.0 if octave is None else math.sqrt(max(0.0, 1 - size * size))
    return np.rint(own / scale).astype(np.int16).tobytes() + np.array([scale, added], np.float32).tobytes()


def decode(codes: list[bytes]) -> np.ndarray:
    """A row per code; inner products of rows are the likeness in a space."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    tail = np.ascontiguousarray(raw[:, -8:]).view(np.float32)
    return np.concatenate([np.ascontiguousarray(raw[:, :-8]).view(np.int16) * tail[:, :1], tail[:, 1:]], axis=1).astype(np.float32)


def whole(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables of sorted batches that hold all rows of their keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(key).to_numpy(zero_copy_only=False).astype(np.int64) for key in keys])
        if held and not np.array_equal(last, values[:, 0]):
            yield pa.Table.from_batches(held)
            held = []
        change = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0))
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, batch = [], batch.slice(cut)
        held.append(batch)
        last = values[:, -1]
    if held:
        yield pa.Table.from_batches(held)


def _parts(table: pa.Table, *keys: str) -> Iterator[tuple[int, int]]:
    """Bounds of the rows of each key."""
    values = np.stack([table.column(key).to_numpy().astype(np.int64) for key in keys])
    cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
    bounds = [0, *cuts.tolist(), table.num_rows]
    yield from zip(bounds, bounds[1:], strict=False)


def _best(ids: np.ndarray, likeness: np.ndarray, most: int) -> np.ndarray:
    """Places of the best of distinct `ids`, best first; of equal ones the smaller id."""
    order = np.lexsort((ids, -likeness))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:most]]


LISTS = "ids binary, likeness binary"


def _lists(ids: list[np.ndarray], likeness: list[np.ndarray]) -> dict[str, pa.Array]:
    return {
        "ids": pa.array([own.astype("<i8").tobytes() for own in ids], pa.binary()),
        "likeness": pa.array([own.astype("<f4").tobytes() for own in likeness], pa.binary()),
    }


def _nodes(vectors: DataFrame, id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): distinct vectors, and which rows have them.

    nodes: node, dim, octave, vector, code. members: node, `id`; rows that take no
    part are not among them.
    """
    kind = vectors.schema[id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_vector(v) for v in batch.column(vector).to_pylist()]
            good = [k for k, v in enumerate(own) if v is not None]
            data = [own[k].tobytes() for k in good]
            octaves = [_octave(own[k]) for k in good]
            yield pa.RecordBatch.from_pydict(
                {
                    id: batch.column(id).take(pa.array(good, pa.int64())),
                    "digest": pa.array([hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
                    "dim": pa.array([len(own[k]) for k in good], pa.int32()),
                    "octave": pa.array(octaves, pa.int32()),
                    "vector": pa.array(data, pa.binary()),
                    "code": pa.array([encode(own[k], o) for k, o in zip(good, octaves, strict=True)], pa.binary()),
                }
            )

    schema = f"{id} {kind}, digest binary, dim int, octave int, vector binary, code binary"
    rows = stored(vectors.where(F.col(id).isNotNull()).select(id, vector).mapInArrow(run, schema), "vectors")
    first = [F.first(c).alias(c) for c in ("octave", "vector", "code")]
    nodes = rows.groupBy("digest", "dim").agg(*first).withColumn("node", F.monotonically_increasing_id())
    nodes = stored(nodes, "nodes")
    members = rows.select(id, "digest").distinct().join(nodes.select("digest", "node"), "digest").select("node", id)
    return nodes.drop("digest"), stored(members, "members")


def _sides(code: list[bytes], dim: int, space: int, planes: int) -> np.ndarray:
    """For each node and tree, on which sides of the tree's planes it lies."""
    draw = np.random.default_rng([SEED, dim])
    normal = draw.standard_normal((dim, TREES * planes)).astype(np.float32)
    sides = (decode(code)[:, :dim] @ normal > 0).reshape(len(code), TREES, planes)
    return (sides @ (1 << np.arange(planes, dtype=np.int64))) + ((space * TREES + np.arange(TREES)) << 32)


def _introduced(table: pa.Table, keys: tuple[str, ...], fresh: bool) -> Iterator[pa.RecordBatch]:
    """What nodes of one group would take over from each other.

    With `fresh`, only pairs that have not been in a group before, and only what is
    better than the worst that a node has.
    """
    nodes = table.column("node").to_numpy()
    codes = table.column("code").to_pylist()
    worst = table.column("worst").to_numpy() if fresh else None
    new = table.column("fresh").to_numpy() if fresh else None
    found, ids, best = [], [], []
    for begin, end in _parts(table, *keys):
        for at in range(begin, end, 2 * BLOCK):
            own = slice(at, min(end, at + 2 * BLOCK))
            matrix = decode(codes[own])
            like = matrix @ matrix.T
            np.fill_diagonal(like, -np.inf)
            if fresh:
                like[~(new[own][:, None] | new[own][None])] = -np.inf
                like[like <= worst[own][:, None]] = -np.inf
            most = min(DEGREE, len(like) - 1)
            if most < 1:
                continue
            top = np.argpartition(-like, most - 1, axis=1)[:, :most]
            value = np.take_along_axis(like, top, 1)
            for k in np.flatnonzero((value > -np.inf).any(axis=1)).tolist():
                good = value[k] > -np.inf
                found.append(nodes[at + k])
                ids.append(nodes[own][top[k][good]])
                best.append(value[k][good])
    if found:
        yield pa.RecordBatch.from_pydict({"node": pa.array(found, pa.int64())} | _lists(ids, best))


GRAPH = f"node long, code binary, {LISTS}, fresh binary"


def _merged(offers: DataFrame, graph: DataFrame) -> DataFrame:
    """The graph with what is better among the offers; `fresh` marks what is new."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "node"):
            codes, ids, likeness = (table.column(c).to_pylist() for c in ("code", "ids", "likeness"))
            nodes = table.column("node").to_numpy()
            out: list[list] = [[], [], [], [], []]
            for begin, end in _parts(table, "node"):
                code = next(c for c in codes[begin:end] if c is not None)
                old = next((i for c, i in zip(codes[begin:end], ids[begin:end], strict=True) if c is not None), b"")
                own = np.frombuffer(b"".join(ids[begin:end]), "<i8")
                like = np.frombuffer(b"".join(likeness[begin:end]), "<f4")
                top = _best(own, like, DEGREE)
                fresh = ~np.isin(own[top], np.frombuffer(old, "<i8"))
                for column, value in zip(out, (nodes[begin], code, own[top], like[top], fresh), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_pydict(
                {"node": pa.array(out[0], pa.int64()), "code": pa.array(out[1], pa.binary())}
                | _lists(out[2], out[3])
                | {"fresh": pa.array([f.tobytes() for f in out[4]], pa.binary())}
            )

    none = F.lit(None).cast("binary").alias("code")
    rows = graph.select("node", "code", "ids", "likeness").unionByName(offers.select("node", none, "ids", "likeness"))
    return stored(rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, GRAPH), "graph")


def _begun(nodes: DataFrame, spaces: dict[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """The graph of the nearest within groups on the same sides of random planes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, dims, octaves = (batch.column(c).to_pylist() for c in ("code", "dim", "octave"))
            cells = np.zeros((len(codes), TREES), np.int64)
            for dim, octave in set(zip(dims, octaves, strict=True)):
                own = [k for k in range(len(codes)) if (dims[k], octaves[k]) == (dim, octave)]
                space, size = spaces[dim, octave]
                planes = max(0, min(30, round(math.log2(size / LEAF))))
                cells[own] = _sides([codes[k] for k in own], dim, space, planes)
            own = pa.array(np.repeat(np.arange(len(codes)), TREES))
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("node").take(own), "code": batch.column("code").take(own), "cell": pa.array(cells.ravel())}
            )

    placed = nodes.select("node", "code", "dim", "octave").mapInArrow(run, "node long, code binary, cell long")
    crowded = placed.groupBy(F.col("cell").alias("c")).agg(F.count("*").alias("size")).where(F.col("size") > 2 * BLOCK)
    crowded = stored(crowded, "crowded")
    dealt = placed.join(crowded, F.col("cell") == F.col("c"), "left").select(
        "node", "code", "cell", F.expr(f"coalesce(pmod(xxhash64(node, cell), int(ceil(size / {BLOCK}))), 0)").alias("block")
    )
    grouped = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block")

    def introduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "cell", "block"):
            yield from _introduced(table, ("cell", "block"), fresh=False)

    empty = F.lit(b"")
    graph = nodes.select("node", "code", empty.alias("ids"), empty.alias("likeness"))
    return _merged(grouped.mapInArrow(introduce, f"node long, {LISTS}"), graph)


def _round(graph: DataFrame, number: int) -> DataFrame:
    """The graph after nodes with a common neighbour have been introduced."""

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(i, "<i8") for i in batch.column("ids").to_pylist()]
            like = [np.frombuffer(v, "<f4") for v in batch.column("likeness").to_pylist()]
            own = pa.array(np.repeat(np.arange(len(ids)), [len(i) for i in ids]))
            # A node whose list is not full takes anything.
            worst = [v[-1] if len(v) == DEGREE else -np.inf for v in like]
            yield pa.RecordBatch.from_pydict(
                {
                    "pivot": pa.array(np.concatenate([np.zeros(0, np.int64), *ids])),
                    "node": batch.column("node").take(own),
                    "code": batch.column("code").take(own),
                    "worst": pa.array(worst, pa.float32()).take(own),
                    "fresh": pa.array(np.frombuffer(b"".join(batch.column("fresh").to_pylist()), bool)),
                }
            )

    told = graph.mapInArrow(tell, "pivot long, node long, code binary, worst float, fresh boolean")
    crowded = told.groupBy(F.col("pivot").alias("p")).agg(F.count("*").alias("size")).where(F.col("size") > 2 * BLOCK)
    crowded = stored(crowded, "crowded")
    dealt = told.join(crowded, F.col("pivot") == F.col("p"), "left").withColumn(
        "block", F.expr(f"coalesce(pmod(xxhash64(node, {number}), int(ceil(size / {BLOCK}))), 0)")
    )
    grouped = dealt.drop("p", "size").repartition("pivot", "block").sortWithinPartitions("pivot", "block")

    def introduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "pivot", "block"):
            yield from _introduced(table, ("pivot", "block"), fresh=True)

    return _merged(grouped.mapInArrow(introduce, f"node long, {LISTS}"), graph)


def neighbour_graph(nodes: DataFrame, spaces: dict[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """(node, code, ids, likeness, fresh): the nearest nodes found of every node."""
    graph = _begun(nodes, spaces)
    for number in range(ROUNDS):
        before, graph = graph, _round(graph, number)
        discard(before)
        fresh = F.length(F.replace(F.hex("fresh"), F.lit("00"), F.lit(""))) / 2
        changed, held = graph.agg(F.sum(fresh), F.sum(F.length("fresh"))).first()
        if not held or changed < SETTLED * held:
            break
    return graph


POOL = "query long, dim int, octave int, code binary, ids binary, likeness binary, asked binary"


def _search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, ids): the best nodes found for each query node, in every space of its length.

    The graph is written with the codes of its neighbours, in as many buckets as a
    shuffle has partitions, so that rounds move what is asked and not the graph.
    """
    spark = queries.sparkSession
    spread = Window.partitionBy("dim", "octave").orderBy(F.xxhash64("node"), "node")
    entries: dict[tuple[int, int], list] = {}
    # At most ENTRIES nodes for each space.
    for r in nodes.withColumn("n", F.row_number().over(spread)).where(F.col("n") <= ENTRIES).collect():
        entries.setdefault((r.dim, r.octave), []).append((r.node, bytes(r.code)))

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for node, dim, octave, data in zip(
                *(batch.column(c).to_pylist() for c in ("node", "dim", "octave", "vector")), strict=True
            ):
                code = encode(np.frombuffer(data), None)
                for space, own in entries.items():
                    if space[0] != dim:
                        continue
                    ids = np.array([n for n, _ in own], np.int64)
                    like = decode([c for _, c in own]) @ decode([code])[0]
                    if space[1] == octave:
                        ids, like = np.append(ids, node), np.append(like, np.float32(2))
                    top = _best(ids, like, KEPT)
                    asked = np.zeros(len(top), bool)
                    for column, value in zip(out, (node, dim, space[1], code, ids[top], like[top], asked.tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(
                {
                    "query": pa.array(out[0], pa.int64()), "dim": pa.array(out[1], pa.int32()),
                    "octave": pa.array(out[2], pa.int32()), "code": pa.array(out[3], pa.binary()),
                }
                | _lists(out[4], out[5])
                | {"asked": pa.array(out[6], pa.binary())}
            )

    pools = stored(queries.select("node", "dim", "octave", "vector").mapInArrow(begin, POOL), "pools")

    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(i, "<i8") for i in batch.column("ids").to_pylist()]
            own = pa.array(np.repeat(np.arange(len(ids)), [len(i) for i in ids]))
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("node").take(own), "other": pa.array(np.concatenate([np.zeros(0, np.int64), *ids]))}
            )

    pairs = graph.select("node", "ids").mapInArrow(links, "node long, other long")
    known = nodes.select(F.col("node").alias("other"), "code")
    beside = F.sort_array(F.collect_list(F.struct("other", "code")))  # at most DEGREE of them
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adjacent = pairs.join(known, "other").repartition(buckets, "node").groupBy("node").agg(beside.alias("beside"))
    name = f"neighbours_{uuid.uuid4().hex}"
    adjacent.write.bucketBy(buckets, "node").sortBy("node").saveAsTable(name)
    try:
        for _ in range(SEARCH_ROUNDS):
            asked = _asked(pools)
            if asked.isEmpty():
                break
            before, pools = pools, _answered(pools, asked, spark.table(name))
            discard(before)
    finally:
        spark.sql(f"drop table {name}")
    return pools


def _asked(pools: DataFrame) -> DataFrame:
    """What the searches ask next: the best they keep and have not asked yet."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(i, "<i8") for i in batch.column("ids").to_pylist()]
            likeness = [np.frombuffer(v, "<f4") for v in batch.column("likeness").to_pylist()]
            open_ = [~np.frombuffer(a, bool) for a in batch.column("asked").to_pylist()]
            own = pa.array(np.repeat(np.arange(len(ids)), [int(o.sum()) for o in open_]))
            worst = [v[-1] if len(v) == KEPT else -np.inf for v in likeness]
            found = [i[o] for i, o in zip(ids, open_, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"ask": pa.array(np.concatenate([np.zeros(0, np.int64), *found])), "worst": pa.array(worst, pa.float32()).take(own)}
                | {c: batch.column(c).take(own) for c in ("query", "octave", "code")}
            )

    return pools.mapInArrow(run, "ask long, worst float, query long, octave int, code binary")


def _answered(pools: DataFrame, asked: DataFrame, adjacent: DataFrame) -> DataFrame:
    """The searches after the neighbours of what they asked have been compared."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst = batch.column("worst").to_pylist()
            codes = batch.column("code").to_pylist()
            beside = batch.column("beside")
            cuts = beside.offsets.to_numpy()
            other = beside.values.field("other").to_numpy()
            matrix_of = beside.values.field("code")
            ids, like = [], []
            for k, code in enumerate(codes):
                matrix = decode(matrix_of[cuts[k] : cuts[k + 1]].to_pylist())
                value = matrix @ decode([code])[0]
                good = value > worst[k]
                ids.append(other[cuts[k] : cuts[k + 1]][good])
                like.append(value[good])
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("query", "octave")} | _lists(ids, like))

    answers = asked.join(adjacent, F.col("ask") == F.col("node")).select("query", "octave", "code", "worst", "beside")
    answers = answers.mapInArrow(compare, f"query long, octave int, {LISTS}").where(F.length("ids") > 0)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("dim", "int"), ("code", "binary"), ("asked", "binary"))]
    rows = pools.unionByName(answers.select("query", "octave", "ids", "likeness", *nothing))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "query", "octave"):
            code, ids, likeness, asked = (table.column(c).to_pylist() for c in ("code", "ids", "likeness", "asked"))
            heads, out = [], ([], [], [])
            for begin, end in _parts(table, "query", "octave"):
                head = next(k for k in range(begin, end) if code[k] is not None)
                own = np.frombuffer(b"".join(ids[begin:end]), "<i8")
                like = np.frombuffer(b"".join(likeness[begin:end]), "<f4")
                top = _best(own, like, KEPT)
                # All that was kept before has been asked by now.
                before = np.isin(own[top], np.frombuffer(ids[head], "<i8"))
                heads.append(head)
                for column, value in zip(out, (own[top], like[top], before.tobytes()), strict=True):
                    column.append(value)
            chosen = table.take(pa.array(heads, pa.int64())).combine_chunks()
            for batch in chosen.select(["query", "dim", "octave", "code"]).to_batches(max_chunksize=len(heads) or 1):
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("query", "dim", "octave", "code"), batch.columns, strict=True))
                    | _lists(out[0], out[1])
                    | {"asked": pa.array(out[2], pa.binary())}
                )

    grouped = rows.repartition("query", "octave").sortWithinPartitions("query", "octave")
    return stored(grouped.mapInArrow(run, POOL), "pools")


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The `k` vectors of largest inner product for each row that `queries` holds for.

    Returns `query_id`, `rank` (from 1), `vec_id`, `score` (the inner product in
    double precision), nearest first, ties to the smaller id. The search is
    approximate: a near row may be missed, no score is wrong.

    A row is not its own result, nor is another row of its id. Vectors that are null,
    empty or zero, or hold null or infinite components, and rows without an id take
    no part; vectors of different lengths do not meet. Equal vectors are one node of
    the graph and each of their rows a result of its own; a row repeated with id and
    vector is one row. An id with several vectors is searched for each. Other columns
    are not read. With too few candidates all of them are given.
    """
    spark = vectors.sparkSession
    prepare(spark)
    nodes, members = _nodes(vectors, id, vector)
    counts = nodes.groupBy("dim", "octave").count().collect()  # one row for each length and octave of norm
    spaces = {(r.dim, r.octave): (n, r["count"]) for n, r in enumerate(sorted(counts))}
    graph = neighbour_graph(nodes, spaces)
    asking = stored(members.where(queries).select(F.col(id).alias("query_id"), F.col("node").alias("of")), "queries")
    chosen = nodes.join(asking.select(F.col("of").alias("node")).distinct(), "node", "left_semi")
    pools = _search(chosen, graph, nodes)

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(i, "<i8")[: EXACT * k] for i in batch.column("ids").to_pylist()]
            own = pa.array(np.repeat(np.arange(len(ids)), [len(i) for i in ids]))
            yield pa.RecordBatch.from_pydict(
                {"query": batch.column("query").take(own), "found": pa.array(np.concatenate([np.zeros(0, np.int64), *ids]))}
            )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            value = [float(np.dot(np.frombuffer(x), np.frombuffer(y))) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"query": batch.column("query"), "found": batch.column("found"), "score": pa.array(value, pa.float64())}
            )

    pairs = pools.mapInArrow(best, "query long, found long")
    pairs = pairs.join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("left")), "query")
    pairs = pairs.join(nodes.select(F.col("node").alias("found"), F.col("vector").alias("right")), "found")
    scored = pairs.mapInArrow(score, "query long, found long, score double")
    # No result holds more than k + 1 rows of one node, its own among them.
    first = Window.partitionBy("node").orderBy(id)
    few = members.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    rows = scored.join(few.select(F.col("node").alias("found"), F.col(id).alias("vec_id")), "found")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    listed = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("listed"))
    # One row for each query node, so that the rows of a frequent vector can be split.
    own = asking.join(listed, F.col("of") == F.col("query")).withColumn(
        "own", F.expr(f"slice(filter(listed, x -> x.vec_id <> query_id), 1, {k})")
    )
    return own.select("query_id", F.posexplode("own").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
