"""Municipalities and neighbourhoods: discovery, matching, reuse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.dims import states
from listingflow.operators.positions import with_position


def match_city(locations: DataFrame, city: str = "city") -> DataFrame:
    """Locations with a name that lie in the city that was asked for."""
    named = F.coalesce(F.col("neighbourhood") != "", F.lit(False))
    return locations.where(named & (F.lower("n_city") == F.lower(F.col(city))))


def distinct_neighbourhoods(matched: DataFrame) -> DataFrame:
    """(uf, city, neighbourhood, neighbourhood_pos), sorted by code point."""
    found = matched.select("uf", "city", "neighbourhood").distinct()
    placed = with_position(found, ["uf", "city"], ["neighbourhood"], "neighbourhood_pos")
    return placed.withColumn("neighbourhood_pos", F.col("neighbourhood_pos").cast("int"))


def city_index(municipalities: DataFrame) -> DataFrame:
    """(uf, city, city_idx), sorted by code point; the list keeps repeated names.

    A name is one row with a count while positions are found, so one that is
    repeated very often does not fill a partition.
    """
    names = municipalities.groupBy("uf", "city").agg(F.count("*").alias("n"))
    placed = with_position(names, ["uf"], ["city"], "city_idx", weight="n")
    copies = placed.select("uf", "city", "city_idx", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    return copies.select("uf", "city", (F.col("city_idx") + F.col("i") - 1).cast("int").alias("city_idx"))


def city_counts(municipalities: DataFrame) -> DataFrame:
    """Cities per state (`level` 0) and in all (`level` 1)."""
    per_state = municipalities.groupBy("uf").agg(F.count("*").alias("n_cities"))
    return per_state.rollup("uf").agg(
        F.sum("n_cities").alias("n_cities"),
        F.count("*").alias("n_states"),
        F.grouping_id().alias("level"),
    )


def pending(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in `done`.

    `done` lists every key that was looked up, also those that gave nothing. A
    key that is in it very often is brought down to one row per task first.
    """
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def with_state_name(df: DataFrame, uf: str = "uf") -> DataFrame:
    """Add `state_name`; an unknown code is its own name."""
    names = states(df.sparkSession).select(F.col("uf").alias("_uf"), "name")
    return (
        df.join(F.broadcast(names), F.upper(F.col(uf)) == F.col("_uf"), "left")
        .withColumn("state_name", F.coalesce("name", uf))
        .drop("_uf", "name")
    )


def with_capital_fallback(wanted: DataFrame, cities: DataFrame) -> DataFrame:
    """(uf, city, city_idx) of the wanted states; a state without any gets its capital.

    A state that is neither listed nor known yields nothing.
    """
    listed = cities.join(wanted.select("uf").distinct(), "uf", "left_semi")
    bare = wanted.select("uf").distinct().join(cities.select("uf").distinct(), "uf", "left_anti")
    capitals = states(wanted.sparkSession).select(F.col("uf").alias("_uf"), "capital")
    filled = bare.join(F.broadcast(capitals), F.upper("uf") == F.col("_uf")).select(
        "uf", F.col("capital").alias("city"), F.lit(0).alias("city_idx")
    )
    return listed.select("uf", "city", "city_idx").unionByName(filled)
