"""Near-duplicate documents by min-max hashing of word shingles.

Each permutation of the shingles gives two values, the smallest and the largest
of its hashes: a pair agrees in either with the probability of its similarity, so
half as many hashes are computed for a signature. Values of a signature are banded;
documents that share a band are candidates, and every link is confirmed on the
full shingle sets.

Only connected groups are asked for, not all links. A bucket of many near copies
is therefore compared with its most central member first, then with members drawn
at random while that still joins groups. Members not known to belong together after
that are compared by an exact prefix join: of two sets similar enough, the rarest
shingles have one in common, at places that leave room for the rest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import hold_alone, prepare, records, stored, words
from listingflow.llm.components import components

SEED = 20240229
CACHE_WORDS = 400_000
# Shingles hashed at once: their values stay in the processor's cache.
BLOCK = 1 << 16
# Pivots are drawn again while more than this share of the pairs of a round link,
# so many times at most; what is left then goes through the prefix join.
WORTH = 0.05
PIVOT_ROUNDS = 4


class _Hashes(dict):
    """64-bit hashes of words, of the most recent ones at least."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _begin() -> None:
    hold_alone(_HASHES.clear)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of `size` words.

    A text of fewer words is one shingle; one without words has none.
    """
    own = words(text)
    if not own:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, own), np.uint64, len(own))
    width = min(size, len(own))
    out = np.full(len(own) - width + 1, width, np.uint64)
    for at in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[at : len(own) - width + 1 + at])
    return np.unique(out)


def band_shape(threshold: float, miss: float = 1e-4) -> tuple[int, int]:
    """(rows, bands): the widest bands that lose a pair at `threshold` with odds below `miss`."""
    shapes = ((rows, math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))) for rows in range(2, 12))
    return max(shape for shape in shapes if shape[0] * shape[1] <= 160)


def signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """For each non-empty set the least values under all permutations, then the greatest.

    Given that two sets agree in the one, they are less likely to agree in the other of
    the same permutation; so far apart, the two are never in one band, and the odds of
    a band are those of independent values.
    """
    draw = np.random.default_rng(SEED)
    factors = draw.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 1 << 63, permutations, np.uint64)
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    start = 0
    while start < len(sets):
        end, size = start + 1, len(sets[start])
        while end < len(sets) and size + len(sets[end]) <= BLOCK:
            size += len(sets[end])
            end += 1
        values = np.concatenate(sets[start:end])
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets[start : end - 1]], dtype=np.int64)))
        for k in range(permutations):
            permuted = values * factors[k] + shifts[k]
            permuted ^= permuted >> np.uint64(32)
            out[start:end, k] = np.minimum.reduceat(permuted, offsets)
            out[start:end, permutations + k] = np.maximum.reduceat(permuted, offsets)
        start = end
    return out


def _bands(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64)
    for row in range(rows):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, row : rows * bands : rows])
    return keys.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sign(docs: DataFrame, id: str, text: str, size: int, rows: int, bands: int) -> DataFrame:
    """(id, n_shingles, digest of the set, band keys) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            sets = [shingle_set(value, size) for (value,) in records(batch, text)]
            full = [s for s in sets if len(s)]
            keys = iter(_bands(signatures(full, -(-rows * bands // 2)), rows, bands) if full else [])
            yield pa.RecordBatch.from_pydict(
                {
                    id: batch.column(id),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([_digest(s) for s in sets], pa.binary()),
                    "bands": pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                }
            )

    kind = docs.schema[id].dataType.simpleString()
    schema = f"{id} {kind}, n_shingles long, digest binary, bands array<long>"
    return docs.select(id, text).mapInArrow(run, schema)


def _sets(docs: DataFrame, text: str, size: int) -> DataFrame:
    """(digest, shingles): the full sets of documents, each set once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            sets = [shingle_set(value, size) for (value,) in records(batch, text)]
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array([_digest(s) for s in sets], pa.binary()),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                }
            )

    return docs.select(text).mapInArrow(run, "digest binary, shingles array<long>")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is at least `percent` in a hundred."""
    a = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.where(100 * F.col("common") >= percent * union).select("a", "b")


def _could_link(n_a: Column, n_b: Column, percent: int) -> Column:
    """Sets too different in size cannot be similar enough."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def near_duplicates(
    docs: DataFrame, size: int, percent: int, id: str = "doc_id", text: str = "text", miss: float = 1e-4
) -> DataFrame:
    """Groups of documents that are near copies of each other, directly or by others.

    Two documents are linked if their sets of `size`-word shingles (words between
    ASCII white space, A-Z in lower case) have `100 * intersection >= percent *
    union`. Returns per input row: `id`, `n_shingles` (set size), `component_id`
    (the smallest id reachable by links, its own included) and `kept` (`id =
    component_id`). A pair at the threshold is overlooked with odds below `miss`;
    pairs of equal sets never are, and no link is taken without the full sets.

    Null, empty and blank texts have no shingles and link with nothing. A text of
    fewer than `size` words is one shingle. Rows that repeat an id each come out,
    with the component of their own text; rows without an id form groups too, but
    name none. Other columns are not read.
    """
    prepare(docs.sparkSession)
    docs = docs.select(id, text)
    rows, bands = band_shape(percent / 100, miss)
    signed = stored(_sign(docs, id, text, size, rows, bands), "signatures")
    # Equal sets are one node: their copies are counted, not compared.
    nodes = (
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(F.min(id).alias("first_id"), F.first("n_shingles").alias("n"))
    )
    first = nodes.select(F.col("digest").alias("d"), F.col("first_id").alias("i"), "n")
    keys = (
        signed.join(first, (F.col("digest") == F.col("d")) & F.col(id).eqNullSafe(F.col("i")))
        .select("digest", F.col("n").cast("int").alias("n"), F.posexplode("bands").alias("band", "key"))
        .select("digest", "n", F.xxhash64("band", "key").alias("bucket"))
        .distinct()
    )
    crowded = keys.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    keys = stored(keys.join(crowded, "bucket"), "buckets")
    wanted = stored(keys.groupBy("digest").agg(F.sum("members").alias("central")), "wanted")
    keys = keys.drop("members")
    wanted_ids = signed.select(id, "digest").join(wanted, "digest", "left_semi")
    wanted_ids = wanted_ids.groupBy("digest").agg(F.min(id).alias("i")).select("i").distinct()
    sets = _sets(docs.join(wanted_ids, F.col(id).eqNullSafe(F.col("i")), "left_semi"), text, size)
    sets = stored(sets.where("digest is not null").dropDuplicates(["digest"]), "sets")

    links, tested = None, None
    group = keys.join(wanted, "digest").withColumn("group", F.col("digest"))
    for turn in range(PIVOT_ROUNDS):
        first = -F.col("central") if turn == 0 else F.xxhash64("digest", F.lit(turn), "bucket")
        drawn = F.struct(first.alias("draw"), "digest", "n", "group")
        pivots = group.groupBy("bucket").agg(F.min(drawn).alias("p"))
        pairs = (
            group.join(pivots, "bucket")
            .where((F.col("group") != F.col("p.group")) & _could_link(F.col("n"), F.col("p.n"), percent))
            .select(F.least("digest", "p.digest").alias("a"), F.greatest("digest", "p.digest").alias("b"))
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(_links(pairs, sets, percent), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        group = _regroup(keys, links)
        if found.count() <= WORTH * pairs.count():
            break
    rest = _across(group, sets, percent).join(tested, ["a", "b"], "left_anti")
    links = links.unionByName(stored(_links(stored(rest, "pairs"), sets, percent), "links"))
    found = stored(components(links), "components")

    label = nodes.join(found, F.col("digest") == F.col("node"), "left").select(
        "digest", "first_id", F.coalesce("component", "digest").alias("component")
    )
    least = label.groupBy(F.col("component").alias("c")).agg(F.min("first_id").alias("component_id"))
    label = label.join(least, F.col("component") == F.col("c")).select(F.col("digest").alias("d"), "component_id")
    out = signed.select(id, "n_shingles", "digest").join(label, F.col("digest") == F.col("d"), "left")
    return out.select(
        id,
        "n_shingles",
        F.coalesce("component_id", id).alias("component_id"),
        F.coalesce(F.col(id) == F.coalesce("component_id", id), F.lit(False)).alias("kept"),
    )


def _regroup(keys: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several groups, with their own and the
    bucket's largest group."""
    found = components(links)
    group = keys.join(found, F.col("digest") == F.col("node"), "left").select(
        *keys.columns, F.coalesce("component", "digest").alias("group")
    )
    per_group = group.groupBy("bucket", "group").agg(F.count("*").alias("size"))
    mixed = per_group.groupBy("bucket").agg(F.count("*").alias("groups"), F.max(F.struct("size", "group")).alias("main"))
    mixed = mixed.where("groups > 1").select("bucket", F.col("main.group").alias("main"))
    return stored(group.join(mixed, "bucket"), "groups")


def _across(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs across groups that may be similar enough, by an exact prefix join.

    In an order of shingles by rarity, two sets of n and m with the needed overlap o
    share one among their first n - p + 1 and m - p' + 1, p and p' being the least
    overlap of any partner; behind their first common place i, j no more than
    min(n - i, m - j) can be common. One of a pair is never of its bucket's largest
    group, so those sets are looked up among the others.
    """
    members = group.groupBy("digest").agg(F.first("group").alias("group"), F.max(F.col("group") != F.col("main")).alias("few"))
    rows = members.join(sets, "digest").withColumn("n", F.size("shingles"))
    each = rows.select("digest", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("df"))
    ranked = each.join(common, "shingle").groupBy(F.col("digest").alias("d")).agg(
        F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("ranked")
    )
    # The rarest n - ceil(n * percent / 100) + 1 of a set.
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    first = rows.drop("shingles").join(ranked, F.col("digest") == F.col("d"))
    first = first.select("digest", "group", "few", "n", F.slice("ranked", F.lit(1), length).alias("ranked"))
    first = first.select("digest", "group", "few", "n", F.posexplode("ranked").alias("at", "r"))
    first = stored(first.select("digest", "group", "few", "n", "at", F.col("r.shingle").alias("shingle")), "prefixes")
    names = [c for c in first.columns if c != "shingle"]
    x = first.where("few").select("shingle", *(F.col(c).alias(f"{c}_x") for c in names))
    y = first.select("shingle", *(F.col(c).alias(f"{c}_y") for c in names))
    needed = percent * (F.col("n_x") + F.col("n_y"))
    room = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    pairs = x.join(y, "shingle").where((F.col("group_x") != F.col("group_y")) & ((100 + percent) * room >= needed))
    return pairs.select(
        F.least("digest_x", "digest_y").alias("a"), F.greatest("digest_x", "digest_y").alias("b")
    ).distinct()
