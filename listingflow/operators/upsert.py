"""Keeping the last written version of each listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.dims import LISTING_TYPES, STATE_WALK

REQUIRED = ["url", "portal"]


def write_order() -> list[Column]:
    """Total order of writes of a run over the columns of a page context.

    A run finishes one state before the next, and city numbers start anew in each.
    The pass without a neighbourhood comes after all others of its city, and
    new developments come after used property.
    """
    kinds = F.array(*(F.lit(kind) for kind in LISTING_TYPES))
    return [
        F.col("run"),
        F.array_position(F.array(*(F.lit(uf) for uf in STATE_WALK)), F.col("uf")),
        F.col("uf"),
        F.col("city_idx"),
        F.coalesce(F.col("neighbourhood"), F.lit("")) == "",
        F.col("neighbourhood_pos"),
        F.array_position(kinds, F.col("listing_type")),
        F.col("page"),
        F.col("pos"),
    ]


def savable(df: DataFrame, required: list[str] = REQUIRED) -> Column:
    """True for rows the table accepts; rows without a key or portal are refused."""
    present = F.lit(True)
    for name in required:
        if name in df.columns:
            present = present & F.col(name).isNotNull()
    return present


def latest(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in `order`.

    Spark ranks within each task before the shuffle (WindowGroupLimit), so only
    one row per key and task is moved, however often one key occurs.
    """
    keys = [key] if isinstance(key, str) else key
    newest_first = Window.partitionBy(*keys).orderBy(F.struct(*order).desc())
    return (
        df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")
    )


def upsert_latest(
    existing: DataFrame | None,
    incoming: DataFrame,
    order: list[Column],
    key: str = "url",
    required: list[str] = REQUIRED,
    preserve: list[str] | None = None,
) -> DataFrame:
    """`existing` with the last incoming version of each key put in its place.

    A new version replaces the whole row: columns it does not have become NULL,
    except those in `preserve`, which keep their old value unless the new row
    sets one. `existing` holds each key once, as every result of this function
    does. It is neither sorted nor ranked again, and is not even shuffled while
    the incoming keys are small enough for Spark to broadcast.
    """
    fresh = latest(incoming.where(savable(incoming, required)), key, order)
    if existing is None:
        return fresh
    untouched = existing.join(fresh.select(key), key, "left_anti")
    columns = existing.columns + [n for n in fresh.columns if n not in existing.columns]
    if preserve:
        before = existing.select(key, *(F.col(n).alias(f"_old_{n}") for n in preserve))
        fresh = fresh.join(before, key, "left")
        kept = {
            n: F.coalesce(n, f"_old_{n}") if n in fresh.columns else F.col(f"_old_{n}")
            for n in preserve
        }
        fresh = fresh.withColumns(kept).drop(*before.columns[1:])
    return untouched.unionByName(fresh, allowMissingColumns=True).select(*columns)
