"""Encoding of the test tables into the engine's input formats.

Every row of a table becomes payload text of some shape; which shape follows
from its key, so that SQL over the same table can tell what must come out.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.dims import PAGE_SIZE, STATES
from listingflow.session import spread
from workload.registry import table

BASE_URL = "https://portal.example"
PORTAL = "portal"
NOW = "2024-06-01T12:00:00"
UFS = [row[0] for row in STATES]

# The same list for DuckDB; both sides count from 0 with the remainder of a key.
UF_SQL = "[" + ", ".join(f"'{uf}'" for uf in UFS) + "]"


def uf_of(key: Column) -> Column:
    return F.get(F.array(*(F.lit(uf) for uf in UFS)), (key % len(UFS)).cast("int"))


def uf_sql(key: str) -> str:
    return f"({UF_SQL})[({key}) % {len(UFS)} + 1]"


# --- JSON text out of columns ------------------------------------------------


def js(value: Column | str) -> Column:
    """A text as JSON text, quoted and escaped."""
    if isinstance(value, str):
        return F.lit(json.dumps(value, ensure_ascii=False))
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), value, F.lit('"'))


def num(value: Column) -> Column:
    return value.cast("string")


def arr(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def obj(**members: Column) -> Column:
    """A JSON object; members that are NULL are left out."""
    pairs = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def pick(key: Column, n: int, *cases: Column | None) -> Column:
    """Case number `key % n`; NULL (a left-out member) where there is none."""
    chosen = F.lit(None).cast("string")
    for i, case in enumerate(cases):
        if case is not None:
            chosen = F.when(key % n == i, case).otherwise(chosen)
    return chosen


# --- listing items out of `part` ---------------------------------------------


def part_item(bad: bool = False) -> Column:
    """JSON text of one listing per part, in shapes that vary with its key.

    With `bad`, some items break the payload rules: a price that is no number,
    no address, a room count that is null, a media list that is null.
    """
    k, price, size = F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size")
    null = F.lit("null")
    asked = pick(
        k, 6, js(num(price)), num(price), F.lit("0"), js("0"), null, js(F.concat(F.lit(" "), num(price), F.lit(" "))),
    )
    address = obj(
        street=js(F.concat(F.lit("Rua "), F.col("p_name"))),
        neighborhood=js(F.concat(F.lit("Bairro "), num(k % 40))),
        city=js(F.concat(F.lit("Cidade "), num(k % 200))),
        stateAcronym=js(uf_of(k)),
        zipCode=js(F.lpad(num(k % 100000), 8, "0")),
        zone=pick(k, 3, js("Zona Sul"), null, None),
        point=pick(
            k, 4,
            obj(lat=num(-(k % 30)), lon=num((k % 60) * -0.5)),
            obj(lat=F.lit("0"), lon=js(num((k % 60) * -0.5))),
            F.lit("{}"),
            None,
        ),
    )
    rooms = arr(num(k % 5))
    medias = pick(
        k, 4,
        F.lit("[]"),
        arr(obj(url=js(F.concat(F.lit("https://img.example/a"), num(k))))),
        arr(obj(url=js(F.concat(F.lit("https://img.example/a"), num(k)))), obj(url=js("")), F.lit("{}")),
        arr(*(obj(url=js(F.concat(F.lit(f"https://img.example/{c}"), num(k)))) for c in "bab")),
    )
    if bad:
        asked = F.when(k % 7 == 0, js("abc")).otherwise(asked)
        address = F.when(k % 11 == 0, null).otherwise(address)
        rooms = F.when(k % 13 == 0, F.lit("[null]")).otherwise(rooms)
        medias = F.when(k % 17 == 0, null).otherwise(medias)
    listing = obj(
        id=pick(k % 11, 11, *([js(F.concat(F.lit("P"), num(k)))] * 3), None, js(F.concat(F.lit("P"), num(k))), null,
                *([js(F.concat(F.lit("P"), num(k)))] * 5)),
        title=js(F.col("p_name")),
        description=js(F.concat(F.col("p_type"), F.lit(' "'), F.col("p_brand"), F.lit('"\n'))),
        status=pick(k, 3, js("ACTIVE"), null, None),
        createdAt=js(F.concat(F.lit("2024-01-"), F.lpad(num(k % 28 + 1), 2, "0"), F.lit("T10:00:00Z"))),
        updatedAt=pick(k, 2, js("2024-02-01T00:00:00Z"), null),
        link=pick(k, 3, obj(href=js(F.concat(F.lit("/imovel/p-"), num(k), F.lit("/")))), None, obj(href=js(""))),
        address=address,
        pricingInfos=arr(obj(
            businessType=pick(k, 5, None, js("SALE"), js("RENTAL"), js("SALE_RENTAL"), js("OTHER")),
            price=asked,
            rentalTotalPrice=pick(k, 6, None, js(num(size)), num(size * 10), js(num(size)), None, None),
            monthlyCondoFee=pick(k, 4, num(size), js(num(size)), js(""), None),
            yearlyIptu=pick(k, 4, None, F.lit("0"), js("0"), num(size * 1.5)),
            iptuPeriod=pick(k, 3, js("MONTHLY"), js("YEARLY"), None),
            rentalInfo=pick(
                k, 3,
                obj(warranties=arr(js("GUARANTOR"), js(F.col("p_brand"))), monthlyRentalTotalPrice=js(num(size))),
                obj(warranties=F.lit("[]")),
                None,
            ),
        )),
        usableAreas=pick(k, 7, F.lit("[]"), F.lit('["0"]'), F.lit("[0]"), None, *([arr(js(num(size)))] * 2), arr(num(size))),
        totalAreas=pick(k, 3, arr(num(size * 2.5)), null, arr(null)),
        bedrooms=rooms,
        suites=arr(js(num(k % 4))),
        bathrooms=arr(num(k % 3 + 0.7)),
        parkingSpaces=pick(k, 3, F.lit("[]"), null, arr(num(k % 9))),
        floors=pick(k, 2, arr(num(k % 30)), None),
        unitFloor=pick(k, 2, None, arr(js(num(k % 20)))),
        unitTypes=pick(
            k, 10,
            *(arr(js(t)) for t in ("APARTMENT", "HOME", "CONDOMINIUM", "LAND", "Penthouse", "FLAT", "COMMERCIAL", "FARM")),
            arr(js("Loft")), F.lit("[]"),
        ),
        usageTypes=arr(js("RESIDENTIAL")),
        amenities=pick(k, 4, arr(js("POOL"), js(F.col("p_brand"))), F.lit("[]"), null, None),
        complexAmenities=pick(k, 3, arr(js("GYM")), F.lit("[]"), None),
        condominiumAmenities=pick(k, 2, arr(js("GATE"), js("PARK")), None),
        stamps=pick(k, 2, arr(js("A"), js("B"), js("C")), F.lit("[]")),
        acceptExchange=pick(k, 4, F.lit("true"), F.lit("false"), null, None),
        advertiserContact=obj(
            name=js(F.concat(F.lit("Contact "), num(k % 9))),
            phones=pick(k, 2, arr(js("000-1"), js(F.concat(F.lit("000-"), num(k % 10)))), F.lit("[]")),
        ),
    )
    return obj(
        listing=listing,
        medias=medias,
        account=pick(k, 3, obj(name=js(F.concat(F.lit("Account "), num(k % 5)))), F.lit("{}"), None),
        advertiser=pick(k, 2, obj(name=js(F.concat(F.lit("Advertiser "), num(k % 5)))), None),
    )


def part_items(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    """(k, item): one listing item per part."""
    return spread(table(spark, sf_dir, "part")).select(
        F.col("p_partkey").alias("k"), part_item(bad).alias("item")
    )


def part_pages(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    """Landed listing pages: 24 parts each, with the context of their walk."""
    number = F.floor(F.col("p_partkey") / PAGE_SIZE)
    parts = spread(table(spark, sf_dir, "part").withColumn("n", number), "n")
    items = parts.select("n", "p_partkey", part_item(bad).alias("item"))
    one_page = F.array_sort(F.collect_list(F.struct("p_partkey", "item")))
    listings = F.concat(F.lit("["), F.array_join(one_page["item"], ","), F.lit("]"))
    pages = items.groupBy("n").agg(listings.alias("listings"))
    return pages.select(*page_context(F.col("n")), as_payload(F.col("listings")).alias("payload"))


def page_context(number: Column, pages_per_walk: int = 4) -> list[Column]:
    """Context columns of page `number`: walks of a few pages each."""
    walk = F.floor(number / pages_per_walk)
    return [
        F.lit(0).cast("bigint").alias("run"),
        uf_of(walk).alias("uf"),
        F.concat(F.lit("Cidade "), num(walk)).alias("city"),
        walk.cast("int").alias("city_idx"),
        F.lit("").alias("neighbourhood"),
        F.lit(None).cast("int").alias("neighbourhood_pos"),
        F.lit("USED").alias("listing_type"),
        (number % pages_per_walk + 1).cast("int").alias("page"),
        F.lit(200).alias("status"),
    ]


def as_payload(listings: Column) -> Column:
    return F.concat(F.lit('{"search":{"result":{"listings":'), listings, F.lit("}}}"))


# --- what must come out of an item, as SQL over `part` ------------------------

K = "p_partkey"
ID_SQL = f"CASE {K} % 11 WHEN 3 THEN NULL WHEN 5 THEN NULL ELSE 'P' || {K} END"
URL_SQL = f"""'{BASE_URL}' || CASE WHEN {K} % 3 = 0 THEN '/imovel/p-' || {K} || '/'
    ELSE '/imovel/' || CASE {K} % 11 WHEN 3 THEN '' WHEN 5 THEN 'None' ELSE 'P' || {K} END END"""
PRICE_SQL = f"""CAST(CASE {K} % 6 WHEN 2 THEN p_size * 10 WHEN 3 THEN 0 WHEN 4 THEN NULL
    ELSE p_retailprice END AS DOUBLE)"""
AREA_SQL = f"""CAST(CASE {K} % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN NULL WHEN 3 THEN NULL
    ELSE p_size END AS DOUBLE)"""
# The order in which items were written: their number in the walk, then on the page.
STATE_SQL = uf_sql(K)
