"""Counts and totals over listings and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.operators.upsert import REQUIRED, savable
from listingflow.sources.tables import only_portal


def count_listings(df: DataFrame, portal: str | None = None) -> DataFrame:
    return only_portal(df, portal).agg(F.count("*").alias("n"))


def saved_totals(writes: DataFrame, state: str = "uf", city: str = "city") -> DataFrame:
    """Writes per city, per state and in all. A row written twice counts twice.

    Cities are counted first, with partial sums in each task; the totals above
    are rolled up from that small result, not from the writes again.
    """
    per_city = writes.groupBy(state, city).agg(F.count("*").alias("saved"))
    return (
        per_city.rollup(state, city)
        .agg(F.sum("saved").alias("saved"), F.grouping_id().alias("level"))
    )


def outcome_totals(
    rows: DataFrame, run: str = "run", state: str = "uf", city: str = "city", outcome: str = "outcome"
) -> DataFrame:
    """What became of the pages of a run: per city, per state, per run and in all.

    `rows` are those of `plans.collect.page_outcomes` that count. `saved` are good items
    that the table accepts, `refused` the others, `failed_pages` pages that could not be
    read, `empty_pages` those without listings; `errors` are refused items and failed
    pages. `level` is 0 for a city, 1 for a state, 3 for a run, 7 for all, so that a NULL in a
    place's name is not taken for a total.

    Outcomes are counted by city first, with partial sums in each task, and rolled up once.
    """
    kind = F.col(outcome)
    page = F.coalesce(kind.startswith("page:"), F.lit(False))
    empty = F.coalesce(kind == "page:empty", F.lit(False))
    good = kind.isNull() & savable(rows)
    per_city = rows.groupBy(run, state, city).agg(
        F.count_if(good).alias("saved"),
        F.count_if(~good & ~page).alias("refused"),
        F.count_if(page & ~empty).alias("failed_pages"),
        F.count_if(empty).alias("empty_pages"),
    )
    sums = [F.sum(name).alias(name) for name in per_city.columns[3:]]
    totals = per_city.rollup(run, state, city).agg(*sums, F.grouping_id().alias("level"))
    return totals.withColumn("errors", F.col("refused") + F.col("failed_pages"))


def batch_metrics(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Rows offered, rows the table accepts, and the rest."""
    ok = savable(df, required)
    return df.agg(
        F.count("*").alias("offered"),
        F.count_if(ok).alias("saved"),
        F.count_if(~ok).alias("refused"),
    )


def listings_per_state(listings: DataFrame) -> DataFrame:
    """Current listings per state, those with a price, and their mean price.

    Prices are added up as decimals, so the result does not depend on the order
    in which partial sums meet. A price that is infinite or of more than 22 whole
    digits is left out of the mean and of `n_priced`.
    """
    price = F.col("preco").try_cast("decimal(28,6)")
    return listings.groupBy("estado").agg(
        F.count("*").alias("n_listings"),
        F.count(price).alias("n_priced"),
        F.try_divide(F.sum(price).cast("double"), F.count(price)).alias("mean_price"),
    )
