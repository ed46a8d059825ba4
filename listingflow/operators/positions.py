"""Positions and running totals in groups of any size.

A window over one group is one task. Where a group may hold a large share of all
rows, the work is done in two steps instead: inside bounded pieces of a group,
then over one summary row per piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import cut_lineage

# Positions per piece; a group of a billion rows has 250,000 pieces.
PIECE = 4096


def _same(names: list[str], prefix: str) -> list[Column]:
    return [F.col(name).eqNullSafe(F.col(prefix + name)) for name in names]


def _renamed(names: list[str], prefix: str) -> list[Column]:
    return [F.col(name).alias(prefix + name) for name in names]


def with_position(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str = "pos",
    start: int = 0,
    partitions: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Number the rows of each group in order, from `start`.

    With `weight`, a row stands for that many equal ones and gets the position of
    the first of them.

    Rows are range-partitioned by key and order, so that a large group covers
    many partitions; each is numbered by itself and moved up by the count of the
    group's rows in the partitions before. The split is written to the shared
    folder, because both steps must see the same one.
    """
    by = [*keys, *order]
    split = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    split = cut_lineage(split.withColumn("_piece", F.spark_partition_id()))
    piece = [*keys, "_piece"]
    earlier = (
        Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = F.col(weight) if weight else F.lit(1)
    offsets = (
        split.groupBy(*piece)
        .agg(F.sum(rows).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*_renamed(piece, "_o"), "_before")
    )
    in_piece = Window.partitionBy(*piece).orderBy(*order)
    if weight:
        lower = in_piece.rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(weight).over(lower), F.lit(0))
    else:
        inside = F.row_number().over(in_piece) - 1
    return (
        split.withColumn("_inside", inside)
        .join(offsets, _same(piece, "_o"))
        .withColumn(name, (F.col("_before") + F.col("_inside") + start).cast("bigint"))
        .select(*df.columns, name)
    )


def sum_before(
    df: DataFrame, keys: list[str], at: str, value: str, name: str = "before"
) -> DataFrame:
    """Per row, the sum of `value` over the group's rows at lower `at`.

    `at` is a whole number that is unique in its group.
    """
    pieces = df.withColumn("_piece", F.floor(F.col(at) / PIECE))
    piece = [*keys, "_piece"]
    lower = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(*lower)
    inside = Window.partitionBy(*piece).orderBy(at).rowsBetween(*lower)
    totals = (
        pieces.groupBy(*piece)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .select(*_renamed(piece, "_t"), "_before")
    )
    return (
        pieces.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, _same(piece, "_t"))
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .select(*df.columns, name)
    )
