"""Listing items (JSON text) to rows of the listings table.

Each item is read once with a schema of texts and once as VARIANT. Most decisions can
be made on the texts; the few that need the JSON type of a value (was a `0` a number or
a text, was a field null or missing?) look into the VARIANT, in branches that ordinary
items do not enter (see `Leaf`).

An item the payload rules refuse gets an `outcome`: `reject:<field>` is one bad
item, `fatal:<field>` is a broken shape that ends the walk it came from (see
`stop_at_fatal`). Checks are listed in the order in which fields are read; the
first one that fails names the outcome.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.dims import UNIT_TYPES
from listingflow.functions.text import round2
from listingflow.functions.variants import (
    Leaf, get, given, given_double, held, held_if_read, is_text, joined, kind, maybe_typed, struct, texts,
    to_double, to_int, to_text, truthy,
)

# Schema of an item. Spark fills CORRUPT if any value has another shape.
CORRUPT = "_corrupt"
READ_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT}
LISTS = [
    "usableAreas", "totalAreas", "bedrooms", "suites", "bathrooms", "parkingSpaces", "floors",
    "unitFloor", "unitTypes", "usageTypes", "amenities", "complexAmenities",
    "condominiumAmenities", "stamps", "pricingInfos",
]
ADDRESS = struct(
    **texts("street", "neighborhood", "city", "stateAcronym", "zipCode", "zone"),
    point=struct(**texts("lat", "lon")),
)
LISTING = struct(
    **texts("id", "title", "description", "createdAt", "updatedAt", "status"),
    acceptExchange="boolean",
    **dict.fromkeys(LISTS, "array<string>"),
    link=struct(**texts("href")),
    address=ADDRESS,
    advertiserContact=struct(**texts("name", "phones")),
)
ITEM = struct(
    listing=LISTING,
    medias="array<struct<url: string>>",
    account=struct(**texts("name")),
    advertiser=struct(**texts("name")),
    **texts(CORRUPT),
)
PRICING = struct(
    **texts("iptuPeriod", "businessType", "price", "rentalTotalPrice", "monthlyCondoFee", "yearlyIptu"),
    rentalInfo=struct(warranties="array<string>", **texts("monthlyRentalTotalPrice")),
    **texts(CORRUPT),
)

# Columns that come from element 0 of a payload list.
ROOMS = {"quartos": "bedrooms", "suites": "suites", "banheiros": "bathrooms", "vagas": "parkingSpaces"}
FLOORS = {"andar": "floors", "total_andares": "unitFloor"}

OUTCOME = "outcome"


def _unless(settled: Column, otherwise: Column) -> Column:
    """False where `settled`; the costly look at a value is left to the rest."""
    return F.when(settled, False).otherwise(F.coalesce(otherwise, F.lit(False)))


class _Reader:
    """Columns and checks over one opened item (`_item`) and its first price (`_price`),
    both also as VARIANT (`_exact`, `_exact_price`)."""

    def __init__(self, item: str, base_url: str) -> None:
        self.item = F.col(item)
        self.base_url = base_url
        self.exact = F.col("_exact")
        self.clean = F.col(f"_item.{CORRUPT}").isNull()
        self.price_text = F.get(F.col("_item.listing.pricingInfos"), F.lit(0))
        self.exact_price = F.col("_exact_price")
        self.clean_price = F.col(f"_price.{CORRUPT}").isNull()

    # --- access ---

    def leaf(self, path: str) -> Leaf:
        return Leaf(F.col(f"_item.{path}"), get(self.exact, f"$.{path}"))

    def head(self, name: str) -> Leaf:
        items = F.col(f"_item.listing.{name}")
        return Leaf(F.get(items, F.lit(0)), get(self.exact, f"$.listing.{name}[0]"))

    def price(self, path: str) -> Leaf:
        return Leaf(F.col(f"_price.{path}"), get(self.exact_price, f"$.{path}"))

    def list(self, name: str) -> tuple[Column, Column]:
        return F.col(f"_item.listing.{name}"), get(self.exact, f"$.listing.{name}")

    # --- what several columns or checks look at ---

    def choices(self) -> dict[str, Column]:
        """Where one field stands in for another: which one is used, and its text."""
        chosen, value = self.list("complexAmenities")
        return {
            "_use_price": given(self.price("price")),
            "_use_rent": given(self.price("rentalTotalPrice")),
            # A value that is no list still wins over the other field, and is refused.
            "_use_complex": F.when(chosen.isNotNull(), F.size(chosen) > 0).otherwise(
                F.when(self.clean, False).otherwise(truthy(value))
            ),
            "_use_account": F.when(F.col("_item.account.name").isNotNull(), True).otherwise(
                F.when(self.item.contains('"account"'), truthy(get(self.exact, "$.account")))
                .otherwise(False)
            ),
        }

    def either(self, use: str, first_choice: Leaf, second: Leaf) -> Leaf:
        return Leaf(
            F.when(F.col(use), first_choice.text).otherwise(second.text),
            F.when(F.col(use), first_choice.value).otherwise(second.value),
        )

    def numbers(self) -> dict[str, Leaf]:
        rent = self.price("rentalTotalPrice")
        monthly = self.price("rentalInfo.monthlyRentalTotalPrice")
        return {
            "preco": self.either("_use_price", self.price("price"), rent),
            "preco_condominio": self.price("monthlyCondoFee"),
            "iptu": self.price("yearlyIptu"),
            "area_construida": self.head("usableAreas"),
            "area_terreno": self.head("totalAreas"),
            "aluguel_total": self.either("_use_rent", rent, monthly),
        }

    def lists(self) -> dict[str, tuple[Column, Column]]:
        """List columns as (items, value)."""
        chosen, value = self.list("complexAmenities")
        other, other_value = self.list("condominiumAmenities")
        warranties = "rentalInfo.warranties"
        return {
            "amenities": self.list("amenities"),
            "complex_amenities": (
                F.when(F.col("_use_complex"), chosen).otherwise(other),
                F.when(F.col("_use_complex"), value).otherwise(other_value),
            ),
            "usage_types": self.list("usageTypes"),
            "stamps": self.list("stamps"),
            "garantias_aluguel": (
                F.col(f"_price.{warranties}"), get(self.exact_price, f"$.{warranties}"),
            ),
        }

    def media_urls(self) -> Column:
        """Photo addresses with their JSON types, for the rare list that needs them."""
        return get(self.exact, "$.medias", "array<struct<url: variant>>")["url"]

    # --- columns ---

    def checked_columns(self) -> dict[str, Column]:
        """Columns that a check looks at too; they are read once, before both."""
        whole = {c: to_int(self.head(name)) for c, name in {**ROOMS, **FLOORS}.items()}
        numbers = {c: given_double(scalar) for c, scalar in self.numbers().items()}
        return {**numbers, **whole, **{c: joined(*pair) for c, pair in self.lists().items()}}

    def columns(self) -> dict[str, Column]:
        """The other parsed columns."""
        c = F.col
        listing_id = self.leaf("listing.id")
        null_id = F.when(listing_id.text.isNull(), F.when(F.is_variant_null(listing_id.value), "None"))
        id_in_url = F.coalesce(to_text(listing_id), null_id, F.lit(""))
        href = self.leaf("listing.link.href")
        unit_type = self.head("unitTypes")
        unit_name = F.when(given(unit_type), unit_type.text)
        known_types = F.create_map(*(F.lit(x) for pair in UNIT_TYPES.items() for x in pair))
        business = F.coalesce(c("_price.businessType"), F.lit("SALE"))
        sold = F.replace(business, F.lit("SALE"), F.lit("venda"))
        photos = F.array_join(F.array_remove("_item.medias.url", ""), "|")
        odd_photos = F.transform(
            F.filter(self.media_urls(), truthy), lambda url: get(url, "$", "string")
        )
        person = self.either("_use_account", self.leaf("account.name"), self.leaf("advertiser.name"))
        contact = self.leaf("listing.advertiserContact.name")
        phones = self.leaf("listing.advertiserContact.phones")
        exchange = c("_item.listing.acceptExchange")
        return {
            "url": F.when(given(href), F.concat(F.lit(self.base_url), to_text(href))).otherwise(
                F.concat(F.lit(f"{self.base_url}/imovel/"), id_in_url)
            ),
            "titulo": c("_item.listing.title"),
            "descricao": c("_item.listing.description"),
            "tipo": F.coalesce(
                F.try_element_at(known_types, F.upper(unit_name)), F.lower(unit_name)
            ),
            "property_sub_type": to_text(unit_type),
            "finalidade": F.replace(sold, F.lit("RENTAL"), F.lit("aluguel")),
            "contract_type": c("_price.businessType"),
            "rua": c("_item.listing.address.street"),
            "bairro": c("_item.listing.address.neighborhood"),
            "cidade": c("_item.listing.address.city"),
            "estado": c("_item.listing.address.stateAcronym"),
            "cep": c("_item.listing.address.zipCode"),
            "zona": c("_item.listing.address.zone"),
            "latitude": to_double(self.leaf("listing.address.point.lat")),
            "longitude": to_double(self.leaf("listing.address.point.lon")),
            "fotos_urls": F.nullif(
                F.when(maybe_typed(photos), F.array_join(odd_photos, "|")).otherwise(photos),
                F.lit(""),
            ),
            "image_count": F.when(c("_item.medias").isNotNull(), F.size("_item.medias"))
            .otherwise(0)
            .cast("bigint"),
            "data_publicacao": c("_item.listing.createdAt"),
            "data_ultima_atualizacao": c("_item.listing.updatedAt"),
            "aceita_permuta": F.when(exchange.isNotNull(), F.initcap(exchange.cast("string"))).when(
                ~self.clean, get(self.exact, "$.listing.acceptExchange", "string")
            ),
            "status_anuncio": to_text(self.leaf("listing.status")),
            "listing_id": to_text(listing_id),
            "anunciante_nome": F.when(given(person), to_text(person)).otherwise(to_text(contact)),
            "anunciante_telefone": F.when(given(phones), phones.text),
            "periodo_iptu": c("_price.iptuPeriod"),
            "raw_json": self.item,
        }

    # --- checks ---

    def _broken(self, path: str) -> Column:
        """Present but not an object: the field cannot be looked into."""
        name = path.rsplit(".", 1)[-1]
        settled = F.col(f"_item.{path}").isNotNull() | ~self.item.contains(f'"{name}"')
        return _unless(settled, get(self.exact, f"$.{path}").isNotNull())

    def _no_list(self, name: str) -> Column:
        """Counts as given, yet is no list. Texts are refused too, not indexed."""
        items, value = self.list(name)
        return _unless(items.isNotNull() | self.clean, truthy(value))

    def checks(self) -> list[tuple[str, Column]]:
        c = F.col
        numbers, lists = self.numbers(), self.lists()
        medias = get(self.exact, "$.medias")
        holds_names = F.coalesce(
            (kind(medias) == "STRING") | kind(medias).startswith("OBJECT"), F.lit(False)
        )
        photos = F.array_join(F.array_remove("_item.medias.url", ""), "|")
        unit_type, business = self.head("unitTypes"), self.price("businessType")
        no_business = F.when(
            business.text.isNull(),
            self.price_text.contains('"businessType"') & business.value.isNotNull(),
        ).otherwise(~is_text(business))
        rental = get(self.exact_price, "$.rentalInfo")
        advertiser = F.when(c("_use_account"), self._broken("account")).otherwise(
            self._broken("advertiser")
        )

        def no_number(column: str, field: str) -> tuple[str, Column]:
            scalar = numbers[column]
            settled = scalar.text.isNull() | c(column).isNotNull()
            return f"reject:{field}", _unless(settled, given(scalar))

        def no_line(column: str, field: str) -> tuple[str, Column]:
            items, value = lists[column]
            settled = c(column).isNotNull() | (F.size(items) == 0)
            settled = settled | (items.isNull() & self.clean & self.clean_price)
            return f"reject:{field}", _unless(F.coalesce(settled, F.lit(False)), truthy(value))

        def no_whole(column: str, field: str) -> tuple[str, Column]:
            items, value = self.list(field)
            settled = c(column).isNotNull() | (F.size(items) == 0) | (items.isNull() & self.clean)
            return f"reject:{field}", _unless(F.coalesce(settled, F.lit(False)), truthy(value))

        return [
            ("reject:json", _unless(self.clean, self.exact.isNull())),
            ("fatal:item", ~F.coalesce(F.ltrim(self.item).startswith("{"), F.lit(False))),
            ("fatal:listing", self._broken("listing")),
            ("reject:pricingInfos", self._no_list("pricingInfos")),
            (
                "fatal:medias",
                F.when(
                    c("_item.medias").isNotNull(), F.exists("_item.medias", lambda m: m.isNull())
                ).otherwise(
                    _unless(
                        self.clean,
                        (holds_names & truthy(medias)) | (kind(medias).startswith("ARRAY")),
                    )
                ),
            ),
            (
                "reject:medias",
                F.when(
                    c("_item.medias").isNotNull(),
                    maybe_typed(photos)
                    & F.exists(
                        self.media_urls(), lambda url: (kind(url) != "STRING") & truthy(url)
                    ),
                ).otherwise(
                    _unless(
                        ~self.item.contains('"medias"'), medias.isNotNull() & ~holds_names
                    )
                ),
            ),
            (
                "fatal:pricingInfos",
                (F.size("_item.listing.pricingInfos") > 0)
                & ~F.coalesce(self.price_text.startswith("{"), F.lit(False)),
            ),
            ("fatal:link", self._broken("listing.link")),
            ("fatal:address", self._broken("listing.address")),
            no_line("amenities", "amenities"),
            no_line("complex_amenities", "complexAmenities"),
            ("reject:usableAreas", self._no_list("usableAreas")),
            no_number("area_construida", "usableAreas"),
            no_number("preco", "price"),
            (
                "fatal:rentalInfo",
                _unless(
                    c("_price.rentalInfo").isNotNull() | ~self.price_text.contains('"rentalInfo"'),
                    rental.isNotNull(),
                ),
            ),
            no_line("stamps", "stamps"),
            ("reject:unitTypes", self._no_list("unitTypes")),
            ("fatal:unitTypes", given(unit_type) & ~is_text(unit_type)),
            ("fatal:businessType", no_business),
            no_number("preco_condominio", "monthlyCondoFee"),
            no_number("iptu", "yearlyIptu"),
            ("reject:totalAreas", self._no_list("totalAreas")),
            no_number("area_terreno", "totalAreas"),
            *(no_whole(column, field) for column, field in ROOMS.items()),
            ("fatal:point", self._broken("listing.address.point")),
            no_line("usage_types", "usageTypes"),
            *(no_whole(column, field) for column, field in FLOORS.items()),
            ("fatal:advertiser", advertiser),
            ("fatal:advertiserContact", self._broken("listing.advertiserContact")),
            no_line("garantias_aluguel", "warranties"),
            no_number("aluguel_total", "rentalTotalPrice"),
        ]

    def outcome(self) -> Column:
        """The first failing check in reading order, NULL for a good item."""
        return F.coalesce(*(F.when(failed, F.lit(name)) for name, failed in self.checks()))


class _Projection(NamedTuple):
    """The columns of a parser, made once: they name what they read and fit any table."""

    exact: Column
    opened: Column
    price: Column
    exact_price: Column
    choices: dict[str, Column]
    checked: dict[str, Column]
    read: dict[str, Column]
    found: Column
    per_m2: Column


@lru_cache(maxsize=16)
def _projection(application: str, item: str, base_url: str) -> _Projection:
    """Some thousand expressions, which take seconds to make, for one running application."""
    reader = _Reader(item, base_url)
    per_m2 = F.when(
        (F.col("preco") != 0) & (F.col("area_construida") > 0) & ~F.isnan("area_construida"),
        round2(F.try_divide("preco", "area_construida")),
    )
    return _Projection(
        held_if_read(F.try_parse_json(F.col(item))),
        held(F.from_json(F.col(item), ITEM, READ_OPTIONS)),
        held_if_read(F.from_json(reader.price_text, PRICING, READ_OPTIONS)),
        held_if_read(F.try_parse_json(reader.price_text)),
        reader.choices(),
        reader.checked_columns(),
        {name: column.alias(name) for name, column in reader.columns().items()},
        reader.outcome().alias("_found"),
        per_m2,
    )


def project_items(df: DataFrame, base_url: str, item: str = "item") -> DataFrame:
    """Parsed columns plus `outcome`, next to the columns `df` already has.

    The opened item, its VARIANT and the outcome are held, so that neither a later
    filter nor any number of columns reads the JSON again or repeats the checks. Checks
    and readings that none of the columns asked for looks at are pruned.
    """
    kept = [name for name in df.columns if name != item]
    own = _projection(df.sparkSession.sparkContext.applicationId, item, base_url)
    return (
        df.withColumn("_exact", own.exact)
        .withColumn("_item", own.opened)
        .withColumns({"_price": own.price, "_exact_price": own.exact_price})
        .withColumns(own.choices)
        .withColumns(own.checked)
        .select(*kept, *own.checked, *own.read.values(), own.found)
        .select(*kept, *own.checked, *own.read, held_if_read(F.col("_found")).alias(OUTCOME))
        .withColumn("preco_por_m2", own.per_m2)
    )


def parse_listings(
    df: DataFrame, base_url: str, item: str = "item"
) -> tuple[DataFrame, DataFrame]:
    """Split items into (good, rejected).

    `good` has the parsed columns; `rejected` keeps the item's text and the
    outcome, so that nothing is lost.
    """
    rows = project_items(df, base_url, item)
    kept = [name for name in df.columns if name != item]
    good = rows.where(F.col(OUTCOME).isNull()).drop(OUTCOME)
    rejected = rows.where(F.col(OUTCOME).isNotNull()).select(*kept, "url", "raw_json", OUTCOME)
    return good, rejected


def is_fatal(outcome: Column | str = OUTCOME) -> Column:
    outcome = F.col(outcome) if isinstance(outcome, str) else outcome
    return F.coalesce(outcome.startswith("fatal:"), F.lit(False))


def stop_at_fatal(rows: DataFrame, walk: list[str], order: list[str], keep_fatal: bool = False) -> DataFrame:
    """Keep, per walk, the rows before its first fatal item; with `keep_fatal`, that one too.

    The stop point is a partial aggregate over narrow rows and is joined back,
    so a walk that holds a large share of all rows is not gathered in one task.
    """
    at = F.struct(*order)
    stops = (
        rows.where(is_fatal())
        .groupBy(*(F.col(name).alias(f"_walk_{name}") for name in walk))
        .agg(F.min(at).alias("_stop"))
    )
    same_walk = [F.col(name).eqNullSafe(F.col(f"_walk_{name}")) for name in walk]
    return (
        rows.join(stops, same_walk, "left")
        .where(F.col("_stop").isNull() | (at <= F.col("_stop") if keep_fatal else at < F.col("_stop")))
        .select(*rows.columns)
    )
