"""Resume state: which city or page a run has got to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, SparkSession
from pyspark.sql import functions as F

from listingflow.dims import CITY_STRIDE, states

# Progress of a state not begun, and of one that is complete.
FIRST_PAGE = 1
COMPLETE = -1


def get_progress(wanted: DataFrame, progress: DataFrame) -> DataFrame:
    """Add `last_page` to the wanted states (column `uf`), 1 where none is stored."""
    stored = progress.select(F.col("estado").alias("_estado"), "last_page")
    return (
        wanted.join(stored, F.col("uf") == F.col("_estado"), "left")
        .withColumn("last_page", F.coalesce("last_page", F.lit(FIRST_PAGE)).cast("bigint"))
        .drop("_estado")
    )


def save_progress(progress: DataFrame, updates: DataFrame, now: str) -> DataFrame:
    """`progress` with one new row per updated state (columns estado, last_page).

    Several updates of a state arrive in the order of `seq`, if there is one.
    """
    seq = F.col("seq") if "seq" in updates.columns else F.lit(0)
    newest = (
        updates.groupBy("estado")
        .agg(F.max(F.struct(seq.alias("seq"), "last_page")).alias("_new"))
        .select(
            "estado",
            F.col("_new.last_page").cast("bigint").alias("last_page"),
            F.lit(now).alias("updated_at"),
        )
    )
    return progress.join(newest, "estado", "left_anti").unionByName(newest)


def packed(city_idx: Column) -> Column:
    """Stored progress after a city is done: where the next one starts."""
    return ((city_idx + 1) * CITY_STRIDE + 1).cast("bigint")


def start_city(last_page: Column) -> Column:
    """City index stored progress points to. The page part is not used."""
    at = F.floor((last_page - 1) / CITY_STRIDE)
    return F.when(last_page > 1, at).otherwise(0).cast("int")


def next_progress(done: DataFrame, n_cities: DataFrame, limit: int | None = None) -> DataFrame:
    """(estado, last_page) from the finished cities (uf, city_idx, saved).

    Cities may be done in any order. A state is complete when all its cities are
    done, unless the run ended at its limit; else the next run starts at the first
    city that is not done.
    """
    cities = done.groupBy("uf", "city_idx").agg(F.sum("saved").alias("saved"))
    place = F.row_number().over(Window.partitionBy("uf").orderBy("city_idx")) - 1
    reached = (
        cities.withColumn("_place", place)
        .groupBy("uf")
        .agg(
            F.min(F.when(F.col("city_idx") != F.col("_place"), F.col("_place"))).alias("_gap"),
            F.count("*").alias("_done"),
            F.sum("saved").alias("_saved"),
        )
        .withColumn("_next", F.coalesce("_gap", "_done"))
    )
    at_limit = F.col("_saved") >= limit if limit else F.lit(False)
    complete = F.col("_next") >= F.col("n_cities")
    return reached.join(n_cities.select("uf", "n_cities"), "uf").select(
        F.col("uf").alias("estado"),
        F.when(~at_limit & complete, COMPLETE)
        .otherwise(packed(F.col("_next") - 1))
        .cast("bigint")
        .alias("last_page"),
    )


def save_cities(ranges: DataFrame, done: DataFrame, now: str) -> DataFrame:
    """`ranges` (see `schema.CITY_PROGRESS`) with the finished cities (uf, city_idx) in them.

    Cities may be done in any order, more than once and in runs for one city; ranges
    that touch or overlap become one. `updated_at` is `now` where a range has grown.
    Cities without a number in their state leave no progress.
    """
    fresh = done.where("city_idx is not null").select("uf", "city_idx").distinct()
    fresh = fresh.select(
        F.col("uf").alias("estado"), F.col("city_idx").cast("int").alias("first_city"),
        F.col("city_idx").cast("int").alias("last_city"), F.lit(None).cast("string").alias("updated_at"),
    )
    by_first = Window.partitionBy("estado").orderBy("first_city", "last_city")
    reach = F.max("last_city").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first_city") <= reach + 1, 0).otherwise(1)
    islands = (
        ranges.select(*fresh.columns)
        .unionByName(fresh)
        .withColumn("_begins", begins)
        .withColumn("_island", F.sum("_begins").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
    )
    merged = islands.groupBy("estado", "_island").agg(
        F.min("first_city").alias("first_city"),
        F.max("last_city").alias("last_city"),
        F.max("updated_at").alias("_old"),
        F.max(F.when(F.col("updated_at").isNotNull(), F.col("last_city") - F.col("first_city"))).alias("_most"),
    )
    grown = F.col("_most").isNull() | (F.col("_most") < F.col("last_city") - F.col("first_city"))
    updated = F.when(grown, F.lit(now)).otherwise(F.col("_old")).alias("updated_at")
    return merged.select("estado", "first_city", "last_city", updated)


def state_progress(ranges: DataFrame, n_cities: DataFrame) -> DataFrame:
    """(estado, last_page) that the ranges come to, for the states of `n_cities` (uf, n_cities).

    Complete if all cities are done; else where the first one that is not starts.
    """
    first = ranges.where("first_city = 0").select(F.col("estado").alias("_estado"), F.col("last_city").alias("_last"))
    at = F.coalesce(F.col("_last"), F.lit(-1))
    return n_cities.join(first, F.col("uf") == F.col("_estado"), "left").select(
        F.col("uf").alias("estado"),
        F.when(at + 1 >= F.col("n_cities"), COMPLETE).otherwise(packed(at)).cast("bigint").alias("last_page"),
    )


def generic_progress(
    pages: DataFrame, walk: list[str], max_pages: Column, start: int = FIRST_PAGE, empty: str = "empty"
) -> DataFrame:
    """(walk, last_page) of a page walk: one past the last page with listings.

    Empty pages at the end do not count, so they alone never complete a walk.
    `pages` are those up to the walk's stop.
    """
    rows = pages.withColumn("_max", max_pages)
    after = F.max(F.when(~F.col(empty), F.col("page") + 1))
    last = F.coalesce(after, F.lit(start))
    return rows.groupBy(*walk).agg(
        F.when(last > F.max("_max"), COMPLETE).otherwise(last).cast("bigint").alias("last_page")
    )


def reset_progress(spark: SparkSession, now: str) -> DataFrame:
    """All states back to the first page."""
    return states(spark).select(
        F.col("uf").alias("estado"),
        F.lit(FIRST_PAGE).cast("bigint").alias("last_page"),
        F.lit(now).alias("updated_at"),
    )
