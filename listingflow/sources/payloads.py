"""Landed API payloads: listing pages, locations and municipality lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions.variants import held, truthy

LISTINGS_PATH = "$.search.result.listings"

# A page in a list, with a mark behind it (see `_marked`).
MARKED_PAGE = "array<struct<search: struct<result: struct<listings: array<string>>>, end: string>>"
LOCATIONS = (
    "struct<neighborhood: struct<result: struct<locations: array<struct<"
    "address: struct<neighborhood: string, city: string>>>>>>"
)
MUNICIPALITIES = "array<struct<nome: string>>"

# What one fetched page of a walk is known by.
PAGE_CONTEXT = (
    "run bigint, uf string, city string, city_idx int, neighbourhood string, "
    "neighbourhood_pos int, listing_type string, page int, status int, payload string"
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages landed as Parquet or as one JSON object per line."""
    if path.rstrip("/").endswith((".json", ".jsonl")):
        return spark.read.schema(PAGE_CONTEXT).json(path)
    return spark.read.schema(PAGE_CONTEXT).parquet(path)


def _marked(payload: Column) -> Column:
    """The payload in a JSON list, with a digest of it as a second element.

    A parser stops at the end of the first value. If the second of two elements is
    the digest, which no payload holds of itself, the payload was one JSON value.
    """
    return F.concat(F.lit("["), payload, F.lit(',{"end":"'), F.md5(payload), F.lit('"}]'))


def _is_whole(marked: Column, payload: Column) -> Column:
    """Whether a marked payload, parsed as VARIANT, was one JSON value."""
    at_end = F.try_variant_get(marked, "$[1].end", "string") == F.md5(payload)
    only = F.try_variant_get(marked, "$[2]", "variant").isNull()
    return F.coalesce(at_end & only, F.lit(False))


def read_pages(df: DataFrame, payload: str = "payload", status: str | None = "status") -> DataFrame:
    """The pages with their `items` (JSON texts), `state` and `reason`, from one reading.

    `state` is `items`, `empty`, or `error` for a page that cannot be looked into; then
    `reason` tells why: `status` (400 or more, if such a column is named), `missing` (no
    payload), `not JSON` (no JSON text, one cut off, or one with something behind it), or
    `shape`: a level that is there but is no object, or a list of items that is none. A
    level that is missing makes an empty page.

    Pages without items are few, so only they are parsed exactly.
    """
    text = F.col(payload)
    first, last = F.get("_read", F.lit(0)), F.get("_read", F.lit(1))
    listings = first["search"]["result"]["listings"]
    plain = (F.size("_read") == 2) & (last["end"] == F.md5(text)) & (F.size(listings) > 0)
    marked = F.try_parse_json(_marked(text))
    broken = F.lit(False)
    for path in ("$[0]", "$[0].search", "$[0].search.result"):
        level = F.try_variant_get(marked, path, "variant")
        broken = broken | (level.isNotNull() & ~F.schema_of_variant(level).startswith("OBJECT"))
    other = F.try_variant_get(marked, LISTINGS_PATH.replace("$", "$[0]"), "variant")
    plain = F.coalesce(plain, F.lit(False))
    failed = F.col(status) >= 400 if status else F.lit(False)
    reason = (
        F.when(failed, "status")
        .when(text.isNull(), "missing")
        .when(plain, None)
        .when(~_is_whole(marked, text), "not JSON")
        .when(broken | truthy(other), "shape")
    )
    state = F.when(F.col("reason").isNotNull(), "error").otherwise(
        F.when(F.size("items") > 0, "items").otherwise("empty")
    )
    return (
        df.withColumn("_read", held(F.from_json(_marked(text), MARKED_PAGE)))
        .select(*df.columns, listings.alias("items"), held(reason).alias("reason"))
        .withColumn("state", state)
    )


def unreadable(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The rows whose payload is not one JSON text as a whole, with the `reason`.

    Works for pages, locations and municipalities alike; `reason` is "missing" for
    a null, else "not JSON": empty, cut off, or with something behind the JSON.
    """
    text = F.col(payload)
    whole = _is_whole(F.try_parse_json(_marked(text)), text)
    reason = F.when(text.isNull(), "missing").when(~whole, "not JSON")
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def explode_listings(df: DataFrame, payload: str = "payload", parallelism: int | None = None) -> DataFrame:
    """One row per listing item: the other columns, `pos` in the page and `item` (JSON text).

    Pages that cannot be read as a whole have no items (see `read_pages`). Few large
    payload files make few tasks; `parallelism` spreads the pages before they are parsed.
    """
    others = [name for name in df.columns if name != payload]
    pages = df.repartition(parallelism) if parallelism else df
    read = read_pages(pages, payload, status=None).where(F.col("state") == "items")
    return read.select(*others, F.posexplode("items").alias("pos", "item"))


def explode_locations(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Neighbourhood and city of every location in the good responses."""
    others = [name for name in df.columns if name not in (payload, "status")]
    body = F.from_json(F.col(payload), LOCATIONS)
    found = df.where(F.col("status") == 200).select(
        *others, F.explode(body["neighborhood"]["result"]["locations"]).alias("_place")
    )
    return found.select(
        *others,
        F.col("_place.address.neighborhood").alias("neighbourhood"),
        F.coalesce(F.col("_place.address.city"), F.lit("")).alias("n_city"),
    )


def explode_municipalities(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(uf, city) of every named municipality in the good responses."""
    return (
        df.where(F.col("status") == 200)
        .select("uf", F.explode(F.from_json(F.col(payload), MUNICIPALITIES)).alias("_m"))
        .select("uf", F.col("_m.nome").alias("city"))
        .where(F.col("city") != "")
    )
