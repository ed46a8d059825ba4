"""Stop rules, limits and page budgets of a walk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.operators.positions import PIECE, _renamed, _same, sum_before
from listingflow.session import cut_lineage

# Empty pages in a row that end a walk, and the listings per page
# the page budget reckons with.
LISTING_WALK_EMPTIES = 2
GENERIC_WALK_EMPTIES = 5
BUDGET_PAGE_SIZE = 20


def _piece_summary(entries: Column, k: int) -> Column:
    """Fold the sorted (page, blank, error) rows of a piece of a walk.

    Keeps what the neighbouring pieces need: the pages of the leading run of
    blanks (at most k of them matter), the length of the trailing run, and the
    page the piece stops at by itself.
    """
    zero = F.struct(
        F.lit(0).alias("run"),
        F.lit(True).alias("only_blank"),
        F.expr("cast(array() as array<bigint>)").alias("lead"),
        F.lit(None).cast("bigint").alias("stop"),
    )

    def step(state: Column, entry: Column) -> Column:
        run = F.when(entry["blank"], state["run"] + 1).otherwise(0)
        leading = state["only_blank"] & entry["blank"]
        stops = entry["error"] | (run >= k)
        return F.struct(
            run.alias("run"),
            leading.alias("only_blank"),
            F.when(
                leading & (F.size(state["lead"]) < k),
                F.concat(state["lead"], F.array(entry["page"])),
            )
            .otherwise(state["lead"])
            .alias("lead"),
            F.coalesce(state["stop"], F.when(stops, entry["page"])).alias("stop"),
        )

    return F.aggregate(entries, zero, step)


def walk_stops(
    pages: DataFrame,
    walk: list[str],
    k: int,
    page: str = "page",
    empty: str = "empty",
    error: str | None = None,
) -> DataFrame:
    """(walk, stop): the page each walk stops at; walks that never stop have none.

    A walk stops at the k-th empty page in a row, or at once at a page marked
    `error`, if such a column is named. A walk may be of any length: runs are
    found inside pieces of bounded length (copies of a page count once), and
    carried over piece borders by a window over one row per piece.
    """
    failed = F.coalesce(F.col(error), F.lit(False)) if error else F.lit(False)
    entry = F.struct(
        F.col(page).cast("bigint").alias("page"),
        F.coalesce(F.col(empty), F.lit(False)).alias("blank"),
        failed.alias("error"),
    )
    pieces = (
        pages.groupBy(*walk, F.floor(F.col(page) / PIECE).alias("_piece"))
        .agg(F.array_sort(F.collect_set(entry)).alias("_entries"))
        .select(*walk, "_piece", _piece_summary(F.col("_entries"), k).alias("_s"))
    )
    # A run reaches back over at most k-1 earlier pieces, for each holds a page.
    reach = max(k - 1, 1)
    recent = Window.partitionBy(*walk).orderBy("_piece").rowsBetween(-reach, -1)
    carried = F.aggregate(
        F.collect_list(F.struct("_s.run", "_s.only_blank")).over(recent),
        F.lit(0),
        lambda run, s: F.when(s["only_blank"], run + s["run"]).otherwise(s["run"]),
    )
    # With `c` blanks carried in, the run is full at the (k-c)-th leading blank.
    early = F.when(
        F.col("_carried") > 0,
        F.get(F.col("_s.lead"), F.greatest(F.lit(k) - F.col("_carried"), F.lit(1)) - 1),
    )
    return (
        pieces.withColumn("_carried", carried)
        .withColumn("stop", F.least(early, F.col("_s.stop")))
        .groupBy(*walk)
        .agg(F.min("stop").alias("stop"))
        .where("stop is not null")
    )


def truncate_after_empty(
    pages: DataFrame,
    walk: list[str],
    k: int,
    page: str = "page",
    empty: str = "empty",
    error: str | None = None,
) -> DataFrame:
    """The pages a walk gets results from: those with any, before its stop."""
    stops = walk_stops(pages, walk, k, page, empty, error)
    stops = stops.select(*_renamed(walk, "_w"), F.col("stop").alias("_stop"))
    filled = pages.where(~F.coalesce(F.col(empty), F.lit(False)))
    return (
        filled.join(stops, _same(walk, "_w"), "left")
        .where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
        .select(*pages.columns)
    )


def limit_rows(
    df: DataFrame, n: int | None, order: list[str], by: list[str] | None = None
) -> DataFrame:
    """The first `n` saved rows in order of arrival, in all or per group.

    The key of the n-th row is looked for among narrow keys only, the same way for
    any `n`: keys are dealt into ranges, the ranges are counted, the n-th row falls
    into one of them, and only that one is numbered. All rows up to that key stay. Whole rows
    are neither shuffled by order nor stored, and no task holds `n` rows.

    Rows equal in `order` are told apart by a hash of all their columns, so that the
    result is the same at every run.
    """
    if not n:
        return df
    keys = by or []
    marked = df.withColumn("_key", F.struct(*order, F.xxhash64(*df.columns).alias("_hash")))
    narrow = marked.select(*keys, "_key")
    split = cut_lineage(
        narrow.repartitionByRange(*keys, "_key").withColumn("_piece", F.spark_partition_id())
    )
    piece = [*keys, "_piece"]
    earlier = (
        Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    crossed = (
        split.groupBy(*piece)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n))
        .select(*_renamed(piece, "_c"), "_before")
    )
    in_piece = Window.partitionBy(*piece).orderBy("_key")
    numbered = split.join(crossed, _same(piece, "_c")).withColumns(
        {"_row": F.col("_before") + F.row_number().over(in_piece), "_first": F.col("_before") + F.rank().over(in_piece)}
    )
    # Of rows that equal the n-th one in all, so many stay.
    ends = numbered.where(F.col("_row") == n).select(
        *_renamed(keys, "_e"), F.col("_key").alias("_end"), (n + 1 - F.col("_first")).alias("_left")
    )
    if by:
        kept = marked.join(ends, _same(keys, "_e"), "left")
    else:
        end = ends.first()  # one row
        if end is None:
            return df
        kinds = marked.schema["_key"].dataType
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(end["_end"], kinds.fields, strict=True)]
        kept = marked.withColumns({"_end": F.struct(*values), "_left": F.lit(end["_left"])})
    below = kept.where(F.col("_end").isNull() | (F.col("_key") < F.col("_end")))
    equal = kept.where(F.col("_key") == F.col("_end"))
    copies = F.row_number().over(Window.partitionBy(*keys).orderBy("_key"))
    equal = equal.withColumn("_copy", copies).where(F.col("_copy") <= F.col("_left"))
    return below.select(*df.columns).unionByName(equal.select(*df.columns))


def limit_groups(
    saved: DataFrame, n: int | None, by: str = "uf", at: str = "city_idx", value: str = "saved"
) -> DataFrame:
    """Whole cities, until those before have reached `n`; the crossing one stays."""
    if not n:
        return saved
    return sum_before(saved, [by], at, value, "_before").where(F.col("_before") < n).drop("_before")


def last_page(total: Column, start: Column, limit: Column | None = None) -> Column:
    """Last page a walk may fetch: all, or as many as `limit` listings need."""
    if limit is None:
        return total
    budget = start + F.floor(limit / BUDGET_PAGE_SIZE) + 1
    return F.when(limit > 0, F.least(total, budget)).otherwise(total)
