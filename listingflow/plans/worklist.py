"""Work lists: which pages and look-ups a run has to cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.dims import DISCOVERY_TERMS, LISTING_TYPES, MAX_PAGES, PAGE_SIZE, states
from listingflow.operators.progress import COMPLETE, get_progress, start_city


def select_states(spark: SparkSession, uf: str | None = None, all_states: bool = False) -> DataFrame:
    """The states a run is for: all, one by its code in any case, or none."""
    table = states(spark)
    if all_states:
        return table
    return table.where(F.col("uf") == (uf.upper() if uf else ""))


def resume(worklist: DataFrame, progress: DataFrame) -> DataFrame:
    """Work of the states not complete, from the city their progress points to."""
    rows = get_progress(worklist, progress)
    return rows.where(
        (F.col("last_page") != COMPLETE) & (F.col("city_idx") >= start_city(F.col("last_page")))
    ).drop("last_page")


def resume_cities(worklist: DataFrame, ranges: DataFrame) -> DataFrame:
    """Work of the cities that are in no range of finished ones (`schema.CITY_PROGRESS`).

    Each finished city is left out, also behind the first one that is not; cities without
    a number are always work.
    """
    done = ranges.select(F.col("estado").alias("_estado"), "first_city", "last_city")
    inside = F.col("city_idx").between(F.col("first_city"), F.col("last_city"))
    return worklist.join(done, (F.col("uf") == F.col("_estado")) & inside, "left_anti")


def select_city(cities: DataFrame, uf: str, city: str) -> DataFrame:
    """(uf, city, city_idx) of a run for one city, its name in any case.

    It keeps its number in the state, so its progress counts for it alone. A city that
    is not listed is work all the same, under the name given and without a number.
    """
    uf = uf.upper()
    listed = cities.where((F.col("uf") == uf) & (F.lower("city") == city.lower())).select("uf", "city", "city_idx")
    asked = states(cities.sparkSession).where(F.col("uf") == uf).select(
        "uf", F.lit(city).alias("city"), F.lit(None).cast("int").alias("city_idx")
    )
    return listed.unionByName(asked.join(listed.select("uf").distinct(), "uf", "left_anti"))


def expand_worklist(cities: DataFrame, neighbourhoods: DataFrame) -> DataFrame:
    """City x (its neighbourhoods in order, then the pass without one) x type.

    `neighbourhood_pos` is NULL for the pass without a neighbourhood.
    """
    named = neighbourhoods.join(cities, ["uf", "city"]).select(
        "uf", "city", "city_idx", "neighbourhood", "neighbourhood_pos"
    )
    fallback = cities.select(
        "uf", "city", "city_idx", F.lit("").alias("neighbourhood"), F.lit(None).cast("int").alias("neighbourhood_pos")
    )
    kinds = F.array(*(F.lit(kind) for kind in LISTING_TYPES))
    return named.unionByName(fallback).withColumn("listing_type", F.explode(kinds))


def expand_pages(worklist: DataFrame, pages: Column | int = MAX_PAGES) -> DataFrame:
    """One row per page with the offset of its first listing: all pages asked for."""
    last = F.lit(pages) if isinstance(pages, int) else pages
    numbers = F.when(last >= 1, F.sequence(F.lit(1), last.cast("int")))
    return worklist.withColumn("page", F.explode(numbers)).withColumn(
        "offset", (F.col("page") - 1) * PAGE_SIZE
    )


def expand_terms(cities: DataFrame) -> DataFrame:
    """One neighbourhood look-up per city and search term."""
    terms = F.array(*(F.lit(term) for term in DISCOVERY_TERMS))
    return cities.withColumn("term", F.explode(terms)).withColumn(
        "query", F.concat_ws(" ", "term", "city")
    )
