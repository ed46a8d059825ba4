"""Benchmark passages in documents, by fingerprints of item-sized windows.

A window is as many words of a document as an item has. Windows are laid where the
document holds a shingle of an item as the item does, which an exact join tells, and
at every word between two such places that lie no further apart than a passage can
grow by words put into it and still be similar enough. All other windows share too little with any
item. Their SimHash fingerprints are compared with those of the items by Hamming distance: fingerprints are cut into blocks, and two within
the radius differ by few bits in one block at least, so equal blocks after a few
flips find every pair within the radius. Candidates are confirmed by the exact
weighted similarity of their shingles. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.common import lower_ascii, stored

SHINGLE = 5
THRESHOLD = 0.8
# Fingerprints of 64 bits in blocks. At a similarity of 0.8 about 10 bits differ,
# give or take 3; the radius leaves out some 2 pairs in 10,000 there.
BITS, BLOCKS, RADIUS = 64, 8, 20
# Words of a document that windows are cut from at once.
SEGMENT = 2048
WHITE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    """Words between ASCII white space, A-Z in lower case."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WHITE), lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: Column, size: Column) -> Column:
    """Hashes of the runs of `size` words, by position; none if there are fewer words."""
    last = F.size(hashes) - size
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.xxhash64(F.slice(hashes, k + 1, size)))
    return F.when(last >= 0, runs).otherwise(F.expr("cast(array() as array<bigint>)"))


def _fingerprint(shingles: Column) -> Column:
    """SimHash: each bit is the majority among the shingles' hashes of it."""

    def bit(k: Column) -> Column:
        votes = F.aggregate(
            shingles, F.lit(0), lambda n, h: n + (F.call_function("shiftright", h, k).bitwiseAND(F.lit(1)) * 2 - 1).cast("int")
        )
        return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _blocks(print_: Column) -> Column:
    width = BITS // BLOCKS
    return F.array(
        *(F.shiftrightunsigned(print_, k * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int") for k in range(BLOCKS))
    )


def _flips() -> Column:
    """All masks of as many bits as a block may differ by: some block of two
    fingerprints within the radius has no more than its share of the radius."""
    width, most = BITS // BLOCKS, RADIUS // BLOCKS
    return F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: F.bit_count(m) <= most)


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, n_words, size, shingles): items with words; `size` is the shingles' width.

    The item id may be null, and may have several texts.
    """
    hashes = _hashes(_words(F.col(text)))
    found = benchmark.select(F.col(item).alias("item"), hashes.alias("hashes")).where(F.size("hashes") > 0)
    found = found.withColumn("size", F.least(F.size("hashes"), F.lit(SHINGLE)))
    return found.select("item", F.size("hashes").alias("n_words"), "size", _shingles(F.col("hashes"), F.col("size")).alias("shingles"))


def _located(docs: DataFrame, id: str, text: str, sizes: list[int]) -> DataFrame:
    """(id, n, size, at, shingle): every shingle of every document."""
    rows = docs.select(F.col(id).alias("id"), _hashes(_words(F.col(text))).alias("hashes"))
    out = None
    for size in sizes:
        own = rows.select("id", F.size("hashes").alias("n"), _shingles(F.col("hashes"), F.lit(size)).alias("s"))
        # Not `posexplode`: Spark would test the array for rows before it is made, and
        # make it again for each of its elements in doing so.
        own = own.select("id", "n", F.lit(size).alias("size"), F.posexplode_outer("s").alias("at", "shingle"))
        own = own.where("shingle is not null")
        out = own if out is None else out.unionByName(own)
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """The pairs of a document and an item it holds: `id`, `item`, `start`, `similarity`.

    `similarity` is the greatest over the document's windows: the sum of the smaller
    over that of the larger weights of 5-word shingles, where a shingle weighs its
    number times the log of the number of items over those that have it; `start` is
    the first word of that window. Pairs below `threshold` do not come out. An item
    of fewer than five words is one shingle.

    Null and empty texts, on either side, match nothing. Repeated rows and rows that
    share an id give their pairs once. Items that share an id and differ in their
    texts are searched each on its own, and the best counts; all items without an id
    come out under the null. Documents without an id are not looked at, as a pair
    could not name them. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("id is not null")
    # Each text of an item has a key of its own until the very end.
    items = _items(benchmark, item, item_text).distinct()
    items = stored(items.withColumn("key", F.monotonically_increasing_id()), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most five
    n_items = items.count()
    empty = "id {}, item {}, start int, similarity double".format(
        docs.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    )
    if not sizes:
        return _named(spark.createDataFrame([], empty), id, item)
    places = items.select("key", "n_words", "size", F.posexplode("shingles").alias("place", "shingle"))
    weight = F.log(1 + F.lit(n_items) / F.col("df"))
    weights = stored(
        places.groupBy("size", "shingle").agg(F.count_distinct("key").alias("df")).select("size", "shingle", weight.alias("w")), "weights"
    )
    heaviest = F.log(F.lit(1.0 + n_items))

    # Windows: where a shingle of an item stands in a document, in its place.
    met = _located(docs, "id", "text", sizes).join(weights.select("size", "shingle"), ["size", "shingle"], "left_semi")
    met = stored(met.distinct(), "anchors")
    starts = met.join(places, ["size", "shingle"]).select(
        "id", "n", "size", "n_words", "key", F.greatest(F.col("at") - F.col("place"), F.lit(0)).alias("start")
    )
    # Words put into a passage, or left out, move the places behind them: the best window may
    # begin anywhere between the places before and behind.
    along = Window.partitionBy("id", "n", "key").orderBy("start")
    gap = F.col("start") - F.lag("start").over(along)
    most = F.floor(F.col("n_words") * (1 / threshold - 1)).cast("int") + F.col("size")
    windows = starts.distinct().withColumn("back", F.when(gap <= most, gap - 1).otherwise(0))
    windows = windows.select("id", "n", "size", "n_words", F.explode(F.expr("sequence(start - coalesce(back, 0), start)")).alias("start"))
    windows = windows.distinct().withColumn("segment", F.floor(F.col("start") / SEGMENT).cast("int"))
    listed = windows.groupBy("id", "n", "segment").agg(
        F.collect_set(F.struct("size", "n_words", "start")).alias("windows"), F.max("n_words").alias("longest")
    )
    again = docs.select(F.col("id").alias("i"), _hashes(_words(F.col("text"))).alias("hashes"))
    cut = again.join(listed, (F.col("i") == F.col("id")) & (F.size("hashes") == F.col("n")))
    # A window is cut before it is a row of its own, so no row but its own copies the text.
    cut = cut.select("id", "windows", "segment", F.expr(f"slice(hashes, segment * {SEGMENT} + 1, {SEGMENT} + longest)").alias("part"))
    own = f"transform(windows, w -> struct(w.*, slice(part, w.start - segment * {SEGMENT} + 1, w.n_words) as hashes))"
    own = own.replace("w.*", "w.size as size, w.n_words as n_words, w.start as start")
    cut = cut.select("id", F.explode(F.expr(own)).alias("w")).select("id", "w.*")
    shingles = _shingles(F.col("hashes"), F.col("size"))
    cut = cut.select("id", "size", "n_words", "start", shingles.alias("shingles")).distinct()
    window = F.xxhash64("id", "size", "n_words", "start", "shingles").alias("window")
    cut = stored(cut.select(window, "*", _fingerprint(F.col("shingles")).alias("print")), "windows")

    # Equal blocks, after flips on the items' side, find all pairs within the radius.
    ours = items.withColumn("item_print", _fingerprint(F.col("shingles")))
    ours = ours.select("key", "n_words", "item_print", F.posexplode_outer(_blocks(F.col("item_print"))).alias("block", "part"))
    ours = ours.withColumn("flip", F.explode_outer(_flips())).withColumn("part", F.col("part").bitwiseXOR(F.col("flip")))
    theirs = cut.select("window", "n_words", "print", F.posexplode_outer(_blocks(F.col("print"))).alias("block", "part"))
    # Spark cannot see how many rows the flips make, and would take them for few.
    near = theirs.join(ours.drop("flip").hint("merge"), ["n_words", "block", "part"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    near = near.select("window", "key").distinct()

    # The exact similarity, by shingle.
    held = cut.select("window", "size", F.explode("shingles").alias("shingle")).groupBy("window", "size", "shingle").agg(F.count("*").alias("c"))
    held = stored(held.join(weights, ["size", "shingle"], "left").withColumn("w", F.coalesce("w", heaviest)), "held")
    total = held.groupBy("window").agg(F.sum(F.col("c") * F.col("w")).alias("of_window"))
    own = places.groupBy("key", "size", "shingle").agg(F.count("*").alias("n")).join(weights, ["size", "shingle"])
    item_total = own.groupBy("key").agg(F.sum(F.col("n") * F.col("w")).alias("of_item"))
    common = (
        near.join(held.select("window", "shingle", "c", "size"), "window")
        .join(own, ["key", "size", "shingle"])
        .groupBy("window", "key")
        .agg(F.sum(F.least("c", "n") * F.col("w")).alias("common"))
    )
    similarity = F.col("common") / (F.col("of_window") + F.col("of_item") - F.col("common"))
    scored = common.join(total, "window").join(item_total, "key").withColumn("similarity", similarity)
    scored = scored.where(F.col("similarity") >= threshold)
    found = scored.join(cut.select("window", "id", "start"), "window").join(items.select("key", "item"), "key")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("best")
    out = found.groupBy("id", "item").agg(best)
    return _named(out.select("id", "item", (-F.col("best.s")).alias("start"), "best.similarity"), id, item)


def _named(found: DataFrame, id: str, item: str) -> DataFrame:
    return found.select(F.col("id").alias(id), F.col("item").alias(item), "start", "similarity")
