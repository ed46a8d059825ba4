"""Listing items with every odd shape the payload rules speak of."""

import copy
import json

import pytest
from conftest import plan_of

from listingflow.operators.parse import is_fatal, parse_listings, project_items, stop_at_fatal

BASE = "https://b"
ITEM = {
    "listing": {
        "id": "1",
        "link": {"href": "/x/1"},
        "title": "Casa \"boa\" ção",
        "acceptExchange": True,
        "address": {"city": "c", "stateAcronym": "SP", "point": {"lat": -23.5, "lon": 0}},
        "pricingInfos": [{"businessType": "SALE", "price": "949.3", "rentalInfo": {"warranties": ["A", "B"]}}],
        "usableAreas": ["20"],
        "bedrooms": [2],
        "unitTypes": ["APARTMENT"],
        "amenities": ["P", "Q"],
        "advertiserContact": {"name": "cn", "phones": ["000-1"]},
    },
    "medias": [{"url": "a"}, {"url": ""}, {}],
    "account": {},
    "advertiser": {"name": "an"},
}
MISSING = object()


def item(**changes):
    """ITEM with values at dotted paths replaced (`p` for the first price) or left out."""
    changed = copy.deepcopy(ITEM)
    for path, value in changes.items():
        *parents, name = path.replace("p__", "listing__pricingInfos__0__").split("__")
        at = changed
        for parent in parents:
            at = at[int(parent)] if parent.isdigit() else at[parent]
        if value is MISSING:
            at.pop(name)
        else:
            at[name] = value
    return changed


# (item, columns that must come out) — outcome None is a good item.
GOOD = [
    (item(), {"url": "https://b/x/1", "titulo": 'Casa "boa" ção', "preco": 949.3, "preco_por_m2": 47.46}),
    (item(), {"tipo": "apartamento", "latitude": -23.5, "longitude": 0.0, "estado": "SP", "quartos": 2}),
    (item(), {"fotos_urls": "a", "image_count": 3, "amenities": "P|Q", "garantias_aluguel": "A|B"}),
    (item(), {"anunciante_nome": "an", "anunciante_telefone": '["000-1"]', "aceita_permuta": "True"}),
    ({}, {"url": "https://b/imovel/", "finalidade": "venda", "contract_type": None, "image_count": 0}),
    (item(listing__link=MISSING), {"url": "https://b/imovel/1"}),
    (item(listing__link={"href": ""}, listing__id=MISSING), {"url": "https://b/imovel/"}),
    (item(listing__link=MISSING, listing__id=None), {"url": "https://b/imovel/None", "listing_id": None}),
    (item(listing__link=MISSING, listing__id=77), {"url": "https://b/imovel/77", "listing_id": "77"}),
    (item(p__businessType=MISSING), {"finalidade": "venda", "contract_type": None}),
    (item(p__businessType="RENTAL"), {"finalidade": "aluguel"}),
    (item(p__businessType="OTHER"), {"finalidade": "OTHER"}),
    (item(p__businessType=""), {"finalidade": ""}),
    (item(p__price=0, p__rentalTotalPrice=900), {"preco": 900.0, "aluguel_total": 900.0}),
    (item(p__price="0", p__rentalTotalPrice=900), {"preco": 0.0, "preco_por_m2": None}),
    (item(p__price=0.0), {"preco": None}),
    (item(p__price=" 1_000.5 "), {"preco": 1000.5}),
    (item(p__price="1e3"), {"preco": 1000.0}),
    (item(p__price=True), {"preco": 1.0}),
    (item(p__price=""), {"preco": None}),
    (item(p__rentalInfo={"monthlyRentalTotalPrice": "8"}), {"aluguel_total": 8.0, "garantias_aluguel": None}),
    (item(listing__pricingInfos=[]), {"preco": None, "finalidade": "venda"}),
    (item(listing__pricingInfos=None), {"preco": None, "finalidade": "venda"}),
    (item(listing__pricingInfos=[{"price": 5}, 7]), {"preco": 5.0}),
    (item(listing__usableAreas=["0"]), {"area_construida": 0.0, "preco_por_m2": None}),
    (item(listing__usableAreas=[0]), {"area_construida": None}),
    (item(listing__usableAreas=[None]), {"area_construida": None}),
    (item(listing__usableAreas=0), {"area_construida": None}),
    (item(listing__bedrooms=[2.7]), {"quartos": 2}),
    (item(listing__bedrooms=["2"]), {"quartos": 2}),
    (item(listing__bedrooms=[]), {"quartos": None}),
    (item(listing__bedrooms=None), {"quartos": None}),
    (item(listing__bedrooms=[0]), {"quartos": 0}),
    (item(listing__bedrooms=[True]), {"quartos": 1}),
    (item(listing__floors=[3], listing__unitFloor=["9"]), {"andar": 3, "total_andares": 9}),
    (item(listing__unitTypes=["Loft"]), {"tipo": "loft", "property_sub_type": "Loft"}),
    (item(listing__unitTypes=["farm"]), {"tipo": "rural", "property_sub_type": "farm"}),
    (item(listing__unitTypes=["2X"]), {"tipo": "2x", "property_sub_type": "2X"}),
    (item(listing__unitTypes=[""]), {"tipo": None, "property_sub_type": ""}),
    (item(listing__unitTypes=[]), {"tipo": None, "property_sub_type": None}),
    (item(listing__amenities=["2 VAGAS", "true"]), {"amenities": "2 VAGAS|true"}),
    (item(listing__amenities=[]), {"amenities": None}),
    (item(listing__amenities=0), {"amenities": None}),
    (item(listing__complexAmenities=[], listing__condominiumAmenities=["K"]), {"complex_amenities": "K"}),
    (item(listing__complexAmenities=["G"], listing__condominiumAmenities=["K"]), {"complex_amenities": "G"}),
    (item(listing__acceptExchange=False), {"aceita_permuta": "False"}),
    (item(listing__acceptExchange=None), {"aceita_permuta": None}),
    (item(listing__acceptExchange="yes"), {"aceita_permuta": "yes"}),
    (item(account={"name": "ac"}), {"anunciante_nome": "ac"}),
    (item(account={"x": 1}), {"anunciante_nome": "cn"}),
    (item(account=None), {"anunciante_nome": "an"}),
    (item(advertiser=MISSING), {"anunciante_nome": "cn"}),
    (item(listing__advertiserContact={"phones": []}), {"anunciante_telefone": None}),
    (item(medias=[]), {"fotos_urls": None, "image_count": 0}),
    (item(medias=MISSING), {"fotos_urls": None, "image_count": 0}),
    (item(medias=""), {"fotos_urls": None, "image_count": 0}),
    (item(medias=[{"url": 0}, {"url": "b"}, {"url": "a"}, {"url": "b"}]), {"fotos_urls": "b|a|b", "image_count": 4}),
    (item(listing__address=MISSING), {"cidade": None, "latitude": None}),
    (item(listing__address={"point": {"lat": "1.5"}}), {"latitude": 1.5, "longitude": None}),
    (item(listing__description='"link" "address" "rentalInfo"'), {"preco": 949.3}),
]

BAD = [
    (5, "fatal:item"),
    (None, "fatal:item"),
    ([], "fatal:item"),
    (item(listing=None), "fatal:listing"),
    (item(listing="x"), "fatal:listing"),
    (item(listing__pricingInfos="x"), "reject:pricingInfos"),
    (item(listing__pricingInfos={"a": 1}), "reject:pricingInfos"),
    (item(listing__pricingInfos=[None]), "fatal:pricingInfos"),
    (item(listing__pricingInfos=[3]), "fatal:pricingInfos"),
    (item(medias=None), "reject:medias"),
    (item(medias=3), "reject:medias"),
    (item(medias="x"), "fatal:medias"),
    (item(medias=[None]), "fatal:medias"),
    (item(medias=[{"url": "a"}, 3]), "fatal:medias"),
    (item(medias=[{"url": 3}]), "reject:medias"),
    (item(listing__link=None), "fatal:link"),
    (item(listing__address=None), "fatal:address"),
    (item(listing__address=None, p__price="abc"), "fatal:address"),
    (item(listing__address=[1]), "fatal:address"),
    (item(listing__address__point=None), "fatal:point"),
    (item(listing__address__point=None, p__price="abc"), "reject:price"),
    (item(listing__amenities=["A", 1]), "reject:amenities"),
    (item(listing__amenities=["A", None]), "reject:amenities"),
    (item(listing__amenities=[None]), "reject:amenities"),
    (item(listing__amenities="abc"), "reject:amenities"),
    (item(listing__complexAmenities="abc"), "reject:complexAmenities"),
    (item(listing__usableAreas=3), "reject:usableAreas"),
    (item(listing__usableAreas=["x"]), "reject:usableAreas"),
    (item(listing__totalAreas=[[1]]), "reject:totalAreas"),
    (item(p__price="abc"), "reject:price"),
    (item(p__price="1.5d"), "reject:price"),
    (item(p__price=[1]), "reject:price"),
    (item(p__rentalInfo=None), "fatal:rentalInfo"),
    (item(p__rentalInfo={"warranties": [1]}), "reject:warranties"),
    (item(p__rentalInfo={"monthlyRentalTotalPrice": "x"}), "reject:rentalTotalPrice"),
    (item(p__monthlyCondoFee="x"), "reject:monthlyCondoFee"),
    (item(p__yearlyIptu={"a": 1}), "reject:yearlyIptu"),
    (item(p__businessType=None), "fatal:businessType"),
    (item(p__businessType=3), "fatal:businessType"),
    (item(listing__stamps=[True]), "reject:stamps"),
    (item(listing__unitTypes="x"), "reject:unitTypes"),
    (item(listing__unitTypes=[5]), "fatal:unitTypes"),
    (item(listing__bedrooms=[None]), "reject:bedrooms"),
    (item(listing__bedrooms=["2.7"]), "reject:bedrooms"),
    (item(listing__floors=3), "reject:floors"),
    (item(listing__unitFloor=["x"]), "reject:unitFloor"),
    (item(listing__usageTypes=[{}]), "reject:usageTypes"),
    (item(account={}, advertiser=None), "fatal:advertiser"),
    (item(account="x"), "fatal:advertiser"),
    (item(listing__advertiserContact=None), "fatal:advertiserContact"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    items = [good for good, _ in GOOD] + [bad for bad, _ in BAD]
    rows = [(i, json.dumps(value, ensure_ascii=False)) for i, value in enumerate(items)]
    df = spark.createDataFrame(rows, "k int, item string")
    return {row["k"]: row for row in project_items(df, BASE).collect()}


def test_good_items(parsed):
    wrong = []
    for i, (given, wanted) in enumerate(GOOD):
        row = parsed[i]
        for column, value in {**wanted, "outcome": None}.items():
            if row[column] != value:
                wrong.append((given, column, row[column], value))
    assert not wrong


def test_bad_items(parsed):
    wrong = []
    for i, (given, outcome) in enumerate(BAD, len(GOOD)):
        if parsed[i]["outcome"] != outcome:
            wrong.append((given, parsed[i]["outcome"], outcome))
    assert not wrong


def test_text_that_is_no_json_is_set_aside(spark):
    df = spark.createDataFrame([("{oops",), ('{"listing": {"id": "1", "id": "2"}}',)], "item string")
    rows = {row["raw_json"]: row["outcome"] for row in project_items(df, BASE).collect()}
    assert rows["{oops"] == "reject:json"
    assert rows['{"listing": {"id": "1", "id": "2"}}'] is None  # the last one of equal keys counts


def test_last_of_equal_keys_counts_in_exact_look_ups(spark):
    text = '{"listing": {"pricingInfos": [{"price": "1", "price": 0, "rentalTotalPrice": 5}]}}'
    df = spark.createDataFrame([(text,)], "item string")
    row = project_items(df, BASE).first()
    assert (row["preco"], row["outcome"]) == (5.0, None)


def test_good_and_rejected_add_up(spark):
    rows = [(i, json.dumps(v)) for i, (v, _) in enumerate(GOOD + BAD)]
    good, rejected = parse_listings(spark.createDataFrame(rows, "k int, item string"), BASE)
    assert (good.count(), rejected.count()) == (len(GOOD), len(BAD))


def test_walk_ends_at_its_first_fatal_item(spark):
    outcomes = [None, "reject:price", None, "fatal:link", None, "fatal:address", None]
    rows = [("a", 1, i, o) for i, o in enumerate(outcomes)] + [("b", 1, 0, None), (None, 1, 9, None)]
    df = spark.createDataFrame(rows, "walk string, page int, pos int, outcome string")
    kept = stop_at_fatal(df, ["walk"], ["page", "pos"])
    assert sorted((r["walk"] or "", r["pos"]) for r in kept.collect()) == [
        ("", 9), ("a", 0), ("a", 1), ("a", 2), ("b", 0),
    ]
    assert df.where(is_fatal()).count() == 2


def test_filter_on_the_outcome_stays_above_the_reading(spark):
    df = spark.createDataFrame([("{}",)], "item string")
    plan = parse_listings(df, BASE)[0].select("url")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 1
    assert plan.index("Filter") < plan.index("Generate")
    assert "Python" not in plan


def test_columns_nobody_asks_for_are_pruned(spark):
    df = spark.createDataFrame([("{}",)], "item string")
    plan = project_items(df, BASE).select("url")._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_json" not in plan and "descricao" not in plan


def test_id_is_read_not_searched_for(spark):
    """A null id counts however it is written; a text that looks like one does not."""
    items = ['{"listing":{"id" : null}}', '{"listing":{"title":"\\"id\\":null"}}', '{"listing":{"other":{"id":null}}}', '{"listing":{"\\u0069d":null}}']
    rows = spark.createDataFrame([(k, text) for k, text in enumerate(items)], "k int, item string")
    got = {r.k: r.url for r in project_items(rows, BASE).select("k", "url").collect()}
    assert got == {0: f"{BASE}/imovel/None", 1: f"{BASE}/imovel/", 2: f"{BASE}/imovel/", 3: f"{BASE}/imovel/None"}


def test_parser_is_made_once(spark):
    from listingflow.operators import parse

    rows = spark.createDataFrame([(1, "{}")], "k int, item string")
    project_items(rows, "https://once")
    before = parse._projection.cache_info()
    project_items(rows.withColumn("more", rows.k), "https://once")
    assert parse._projection.cache_info().misses == before.misses


def test_an_item_is_read_as_variant_once(spark):
    """However many columns need the JSON type of a value: it was read again for each of them."""
    items = spark.createDataFrame([(1, "{}")], "k int, item string")
    plan = plan_of(project_items(items, BASE).select("preco", "area_construida", "banheiros", "latitude", "outcome"))
    assert plan.count("parseJson(") == 2  # the item and its first price


def test_only_what_is_asked_for_is_read(spark):
    """The checks, and the price with its VARIANT, were worked out for every column."""
    rows = project_items(spark.createDataFrame([(1, json.dumps(ITEM))], "k int, item string"), BASE)
    point, contract = rows.select("latitude"), rows.select("contract_type")
    assert plan_of(point).count("parseJson(") == 1 and "iptuPeriod" not in plan_of(point)
    assert plan_of(contract).count("parseJson(") == 0 and plan_of(contract).count("from_json(") == 2
    assert [r.latitude for r in point.collect()] == [-23.5]
    assert [r.contract_type for r in contract.collect()] == ["SALE"]


def test_a_filter_does_not_read_again(spark):
    rows = project_items(spark.createDataFrame([(1, json.dumps(ITEM))], "k int, item string"), BASE)
    found = rows.where("preco > 1 AND outcome IS NULL AND tipo = 'apartamento'").select("k", "preco")
    plan = plan_of(found)
    assert plan.count("parseJson(") == 2 and plan.count("from_json(") == 2
    assert [tuple(r) for r in found.collect()] == [(1, 949.3)]
