"""Price, area, date and coordinate texts, pages and sitemaps: odd inputs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listingflow.functions import html as H
from listingflow.functions import text as X
from listingflow.sources import sitemaps as S


def apply(spark, function, texts, kind=None):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = function(F.col("t"))
    out = F.to_json(out) if kind == "variant" else out
    return [r["o"] for r in rows.select("i", out.alias("o")).orderBy("i").collect()]


def test_clean_price(spark):
    cases = {
        "R$ 1.234,50": 1234.5, "R$ 1.000": 1000.0, "1234.5": 12345.0, "1e3": 1000.0, "1_000": 1000.0,
        "inf": float("inf"), "R$": None, "0": None, "-5": None, "US$ 10": None, "R$ 10/mês": None, "": None,
        "nan": None, "1,5d": None, "1,2,3": None, "R$ \x1c7": 7.0,
    }
    assert apply(spark, X.clean_price, cases) == list(cases.values())
    assert apply(spark, X.clean_price, [None]) == [None]


def test_clean_area_and_int(spark):
    areas = {
        "3 meses": 3.0, ". m": None, "0 m²": 0.0, "85.5 m2": 855.0, "1.200,5 m²": 1200.5, "m": None,
        "1,2,3 m 5 m": None, "70 a 80 m²": 80.0, "": None,
    }
    assert apply(spark, X.clean_area, areas) == list(areas.values())
    numbers = {"1.200": 1, "-5": 5, "abc": None, "x007y8": 7, "9" * 30: None, "": None}
    assert apply(spark, X.clean_int, numbers) == list(numbers.values())


def test_parse_date(spark):
    cases = {
        "2024-01-02T03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05.25Z": dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
        " 2024-01-02 ": dt.datetime(2024, 1, 2),
        "2024-1-2": dt.datetime(2024, 1, 2),
        "1/2/2024": dt.datetime(2024, 2, 1),
        "01/02/2024  7:08": dt.datetime(2024, 2, 1, 7, 8),
        "31/02/2024": None,
        "2024-02-30": None,
        "2024-01-02T03:04:05-03:00": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05+00:00": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04": dt.datetime(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05.123456789": dt.datetime(2024, 1, 2, 3, 4, 5, 123456),
        "20240102": dt.datetime(2024, 1, 2),
        "20240102T0304": dt.datetime(2024, 1, 2, 3, 4),
        "2024-01-02T25:00:00": None,
        "ontem": None,
        "": None,
        "02/01/24": None,
    }
    assert apply(spark, X.parse_date, cases) == list(cases.values())


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(1, 10**12), min_size=1, max_size=50), days=st.lists(st.dates(min_value=dt.date(1583, 1, 1)), min_size=1, max_size=50))
def test_prices_and_dates_come_back(spark, values, days):
    written = [f"R$ {v // 100:,}".replace(",", ".") + f",{v % 100:02d}" for v in values]
    assert apply(spark, X.clean_price, written) == [float(f"{v // 100}.{v % 100:02d}") for v in values]
    assert apply(spark, X.parse_date, [d.strftime("%d/%m/") + f"{d.year:04d}" for d in days]) == [
        dt.datetime(d.year, d.month, d.day) for d in days
    ]


def test_coordinates(spark):
    cases = {
        "latitude: -23,5": (-23.0, None),
        '{"latitude":"-23.5","longitude" : -46.25}': (-23.5, -46.25),
        "Latitude=1 latitude= 2. latitude=3": (2.0, None),
        "": (None, None),
    }
    assert [tuple(p) for p in apply(spark, X.coordinates, cases)] == list(cases.values())


def test_round2_is_exact(spark):
    values = [949.3 / 20, 2.675, 1.005, 0.125, -2.675, 1e15 + 0.3, float("inf")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in rows.orderBy("i").select(X.round2(F.col("v"))).collect()]
    assert got == [round(v, 2) for v in values]


def test_iso_text(spark):
    row = spark.sql("select timestamp_ntz'2024-01-02 03:04:05' a, timestamp_ntz'2024-01-02 03:04:05.5' b")
    assert tuple(row.select(X.iso_text(F.col("a")), X.iso_text(F.col("b"))).first()) == (
        "2024-01-02T03:04:05", "2024-01-02T03:04:05.500000",
    )


LD = '<script type="application/ld+json">%s</script>'


def test_json_ld(spark):
    cases = {
        LD % '{"@type":"Product","a":1}': '{"@type":"Product","a":1}',
        LD % '{"@type":["Product"]}': None,
        LD % "{broken" + LD % '[{"@type":"Offer"},{"@type":"Residence"}]': '{"@type":"Residence"}',
        LD % '{"@graph":[{"@type":"Product"}]}': None,
        "<script data-type='application/ld+json'>{\"@type\":\"Product\"}</script>": None,
        LD.replace("ld+json", "LD+JSON") % '{"@type":"Product"}': None,
        "<script class=\"a>b\" type='application/ld+json'>{\"@type\":\"Product\"}</script>": '{"@type":"Product"}',
        LD % "[1, null]" + LD % "7": None,
        "": None,
    }
    assert apply(spark, H.json_ld, cases, "variant") == list(cases.values())


def test_next_data_and_initial_state(spark):
    pages = {
        '<script id="__NEXT_DATA__" x>{"a":\n1}</script>': '{"a":1}',
        '<script id="__NEXT_DATA__">{</script><script id="__NEXT_DATA__">{"a":1}</script>': None,
        "<script id='__NEXT_DATA__'>{}</script>": None,
    }
    assert apply(spark, H.next_data, pages, "variant") == list(pages.values())
    states = {
        'window.__INITIAL_STATE__ = {"a":"};"}; window.__DATA__ = {"b":1};': '{"b":1}',
        'window.initialData={"c":\n2};window.__DATA__={"b":1};': '{"b":1}',
        'window.__INITIAL_STATE__ = {"a":1}': None,
    }
    assert apply(spark, H.initial_state, states, "variant") == list(states.values())


def test_photos(spark):
    a = "https://e/photo"
    cases = {
        f'<img src="{a}.jpg"><img src="{a}.jpg">': f"{a}.jpg",
        '<img src="https://e/logo.png">': None,
        '<img src="/photo.png">': None,
        f'<IMG class=x SRC={a}.PNG?w=1>': f"{a}.PNG?w=1",
        f'<img data-src="https://e/logo.webp"><b DATA-SRC="{a}.gif">': "https://e/logo.webp",
        '<meta property="og:image" content=""><meta content="x&amp;y" property="og:image">': "x&y",
        f'<!-- <img src="{a}.jpg"> --><style><img src="{a}.jpg"></style><imgx src="{a}.jpg">': None,
        '<img src="https://e/Photo.jpg">': None,
        "": None,
    }
    assert apply(spark, H.photos, cases) == list(cases.values())


def test_page_dates(spark):
    tag = '<meta property="article:published_time" content="%s">'
    day = dt.datetime(2024, 3, 2)
    cases = {
        tag % "2024-03-02": (day, None),
        tag % "bad" + "Publicado: 02/03/2024": (day, None),
        tag % "bad" + tag % "2024-03-02": (None, None),
        "CRIADO em 02/03/2024, modificado 02/03/2024": (day, day),
        "publicado em 2/3/2024": (None, None),
    }
    assert [tuple(d) for d in apply(spark, H.page_dates, cases)] == list(cases.values())


def test_locs(spark):
    cases = {
        "<loc>a&amp;b</loc>": ["a&amp;b"],
        "<loc>a\nb</loc>": [],
        "<loc>\n x \t</loc><loc></loc><loc>x</loc>": ["x", "", "x"],
        "<loc>a b</loc>": ["a b"],
        "<LOC>a</LOC>": [],
    }
    assert apply(spark, S.locs, cases) == list(cases.values())


def test_index_is_followed_one_level(spark):
    index = "<sitemapindex><loc>child</loc><loc>gone</loc><loc>child</loc></sitemapindex>"
    nested = "<sitemapindex><loc>deep</loc></sitemapindex>"
    roots = spark.createDataFrame([("a", index), ("b", "<loc>own</loc>"), ("c", "none")], "portal string, content string")
    docs = spark.createDataFrame([("child", nested), ("deep", "<loc>never</loc>")], "url string, content string")
    got = S.sitemap_listing_urls(roots, docs).collect()
    assert sorted(tuple(r) for r in got) == [("a", "deep"), ("a", "deep"), ("b", "own")]


@pytest.mark.parametrize("pattern,kept", [(None, 3), ("", 3), ("/sp/", 2), ("^x", 0)])
def test_filter_urls(spark, pattern, kept):
    urls = spark.createDataFrame([("h/SP/1",), ("h/sp/2",), ("h/rj/1",)], "url string")
    assert S.filter_urls(urls, pattern).count() == kept


def test_json_ld_in_odd_tags(spark):
    product = '{"@type": "Product", "name": "%s"}'
    script = '<script type="application/ld+json">%s</script>'
    pages = [
        (1, f'<script type=application/ld+json {"a" * 100_000}>{product % "long"}</script>'),
        (2, f'<!-- {script % (product % "commented")} -->{script % (product % "real")}'),
        (3, '<script type="application/ld+json" ' + "a" * 100_000),
        (4, "<scripted type='application/ld+json'>" + product % "other" + "</script>"),
    ]
    df = spark.createDataFrame(pages, "id int, html string")
    rows = df.select("id", F.try_variant_get(H.json_ld(F.col("html")), "$.name", "string").alias("n")).orderBy("id").collect()
    assert [r.n for r in rows] == ["long", "real", None, None]
