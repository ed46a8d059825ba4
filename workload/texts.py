"""Price, area, date and coordinate texts; HTML pages; sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions import html as H
from listingflow.functions import text as X
from listingflow.session import new_dir
from listingflow.sources.pages import extract_pages, read_pages
from listingflow.sources.sitemaps import (
    filter_urls, read_sitemaps, sitemap_listing_urls, sitemap_urls,
)
from workload.registry import query, table


def comma_number(value: Column) -> Column:
    """1234.5 -> `1.234,50`, the way prices are written in payload texts."""
    return F.translate(F.call_function("format_number", value, F.lit(2)), ",.", ".,")


# --- C: texts ----------------------------------------------------------------


@query(
    "C1_clean_price",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN o_totalprice WHEN o_orderkey % 5 = 3 THEN NULL
        ELSE CAST(o_orderkey + 1 AS DOUBLE) END AS price FROM orders""",
)
def clean_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, amount = F.col("o_orderkey") % 5, comma_number(F.col("o_totalprice"))
    text = (
        F.when(k == 0, F.concat(F.lit("R$ "), amount))
        .when(k == 1, F.concat(F.lit("R$ "), amount, F.lit("\n")))
        .when(k == 2, amount)
        .when(k == 3, F.concat(F.lit("US$ "), amount))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderkey") + 1))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", X.clean_price(text).alias("price"))


@query(
    "C2_clean_area",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 100.5::DOUBLE WHEN 1 THEN p_size::DOUBLE
        WHEN 2 THEN NULL ELSE 0::DOUBLE END AS area FROM part""",
)
def clean_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    text = (
        F.when(k == 0, F.concat(F.lit("Area "), comma_number(size * F.lit(100.5)), F.lit(" m²")))
        .when(k == 1, F.concat(size.cast("string"), F.lit("m2 util, 70 m2 total")))
        .when(k == 2, F.concat(F.lit("sem . m, "), size.cast("string"), F.lit(" m2")))
        .otherwise(F.lit("0 m²"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", X.clean_area(text).alias("area"))


@query("C3_clean_int", "SELECT c_custkey, CAST(c_custkey AS BIGINT) AS number FROM customer")
def clean_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.clean_int(F.concat("c_name", F.lit(".5 x7"))).alias("number")
    )


@query(
    "C4_parse_date",
    """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 8 THEN NULL
        WHEN 5 THEN o_orderdate + INTERVAL 13 HOUR + INTERVAL 5 MINUTE
        WHEN 2 THEN o_orderdate + INTERVAL 250 MILLISECOND
        ELSE o_orderdate END AS parsed FROM orders""",
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 9
    forms = [
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'.25Z'",
        "' 'yyyy-MM-dd' '", "d/M/yyyy", "dd/MM/yyyy' 13:05'", "yyyy-MM-dd'T'HH:mm:ss'-03:00'", "yyyyMMdd",
        "'31/02/'yyyy",
    ]
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(k == i, F.date_format(day, form)).otherwise(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", X.parse_date(text).alias("parsed"))


@query(
    "C5_coordinates",
    "SELECT s_suppkey, s_acctbal AS lat, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE -s_acctbal END AS lng FROM supplier",
)
def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("s_acctbal").cast("decimal(18,2)")
    text = F.concat(
        F.lit('{"latitude": "'), balance, F.lit('", '),
        F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit('"longitude":'), -balance)).otherwise("Longitude: 7"),
        F.lit(', "latitude": 1}'),
    )
    place = X.coordinates(text)
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", place["lat"].alias("lat"), place["lng"].alias("lng")
    )


# --- H: pages ----------------------------------------------------------------


def pages_with(spark: SparkSession, sf_dir: str, *markup: Column | str) -> DataFrame:
    """Whole pages with markup put in at the end of the body."""
    added = [F.lit(m) if isinstance(m, str) else m for m in markup]
    html = F.concat(F.replace("html", F.lit("</body></html>")), *added, F.lit("</body></html>"))
    return table(spark, sf_dir, "pages").withColumn("html", html)


def page() -> Column:
    return F.col("page_id").cast("string")


@query(
    "H1_json_ld",
    "SELECT page_id, CASE WHEN page_id % 4 <> 3 THEN 'n' || page_id END AS name FROM pages",
)
def json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    item = F.concat(F.lit('{"@type":"Product","name":"n'), page(), F.lit('"}'))
    script = (
        F.when(k == 0, F.concat(F.lit('<script type="application/ld+json">[{"@type":"Offer"},\n'), item, F.lit("]</script>")))
        .when(k == 1, F.concat(F.lit("<SCRIPT async TYPE='application/ld+json' id=x>"), item, F.lit("</SCRIPT >")))
        .when(k == 2, F.concat(F.lit("<script type=application/ld+json>"), item, F.lit("</script>")))
        .otherwise(F.lit('<script type="application/ld+json">{"@type":["Product"]}</script>'))
    )
    broken = '<script type="application/ld+json">{broken</script><script type="application/ld+json"></script>'
    pages = pages_with(spark, sf_dir, broken, '<script type="text/x">{"@type":"Product","name":"no"}</script>', script)
    name = F.try_variant_get(H.json_ld(F.col("html")), "$.name", "string")
    return pages.select("page_id", name.alias("name"))


@query(
    "H2_next_data",
    "SELECT page_id, CASE WHEN page_id % 3 <> 2 THEN page_id END AS id, length(url) AS url_length FROM pages",
)
def next_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("page_id") % 3 == 2, F.lit("{oops")).otherwise(
        F.concat(F.lit('{"a":\n{"id":'), page(), F.lit("}}"))
    )
    pages = pages_with(
        spark, sf_dir, F.concat(F.lit('<script id="__NEXT_DATA__" type="x">'), body, F.lit("</script>")),
        '<script id="__NEXT_DATA__">{"a":{"id":-1}}</script>',
    )
    found = F.try_variant_get(H.next_data(F.col("html")), "$.a.id", "bigint")
    return pages.select("page_id", found.alias("id"), F.length("url").cast("bigint").alias("url_length"))


@query(
    "H3_initial_state",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'third' END AS found
    FROM pages""",
)
def initial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    script = (
        F.when(k == 0, '<script>window.__DATA__ = {"x":"no"};\nwindow.__INITIAL_STATE__ =\n{"x":\n"first"};</script>')
        .when(k == 1, '<script>window.__INITIAL_STATE__={"a":"};"}; window.__DATA__ = {"x":"second"};</script>')
        .when(k == 2, '<script>window.initialData = {"x":"third"};</script>')
        .otherwise("<script>window.initialData = {broken};</script>")
    )
    found = F.try_variant_get(H.initial_state(F.col("html")), "$.x", "string")
    return pages_with(spark, sf_dir, script).select("page_id", found.alias("found"))


@query(
    "H4_photos",
    """SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL ELSE
        'http://z.example/lazy.png|https://i.example/o&' || page_id || '.jpg|https://i.example/photo' || page_id || '.JPG'
        END AS fotos_urls FROM pages""",
)
def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    photo = F.concat(F.lit("https://i.example/photo"), page(), F.lit(".JPG"))
    markup = F.concat(
        F.lit('<meta content="https://i.example/o&amp;'), page(), F.lit('.jpg" property="og:image"/><meta property="og:image">'),
        F.lit('<img src="'), photo, F.lit('"><IMG alt="a>b" SRC=\''), photo, F.lit("'>"),
        F.lit('<img src="https://i.example/logo.png"><img src="/photo.png"><img data-src="http://z.example/lazy.png">'),
        F.lit('<!-- <img src="https://i.example/image-hidden.png"> --><script>var t=\'<img src="https://i.example/image2.png">\'</script>'),
    )
    pages = pages_with(spark, sf_dir, F.when(F.col("page_id") % 5 == 4, "").otherwise(markup))
    return pages.select("page_id", H.photos(F.col("html")).alias("fotos_urls"))


@query(
    "H5_page_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate END AS published,
        CASE WHEN o_orderkey % 4 IN (0, 1) THEN o_orderdate + INTERVAL 1 DAY END AS updated FROM orders""",
)
def page_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written, later = F.date_format(day, "dd/MM/yyyy"), F.date_format(F.date_add(day, 1), "dd/MM/yyyy")
    iso_later = F.date_format(F.date_add(day, 1), "yyyy-MM-dd'T'00:00:00'Z'")
    html = (
        F.when(k == 0, F.concat(F.lit("<p>PUBLICADO em "), written, F.lit("</p>Atualizado: "), later))
        .when(k == 1, F.concat(
            F.lit('<meta property="article:published_time" content="'), F.date_format(day, "yyyy-MM-dd"),
            F.lit('"><meta content=\''), iso_later, F.lit("' property='article:modified_time'>Criado em 01/01/1990"),
        ))
        .when(k == 2, F.concat(F.lit('<meta property="article:published_time">anunciado '), written))
        .otherwise(F.lit("publicado em 1/2/2024"))
    )
    dates = H.page_dates(html)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates["published"].alias("published"), dates["updated"].alias("updated")
    )


@query("G6_photo_set", "SELECT page_id, 2 AS n FROM pages")
def photo_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.concat(F.lit('<img src="https://i.example/image'), page(), F.lit('.webp">'))
    pages = pages_with(spark, sf_dir, tag, tag, '<div data-src="https://i.example/x.jpeg"></div>', tag)
    found = F.size(F.split(H.photos(F.col("html")), r"\|"))
    return pages.select("page_id", found.alias("n"))


@query(
    "S5_page_extraction",
    "SELECT page_id, url, page_id AS id, CAST(page_id % 90 AS DOUBLE) AS lat FROM pages",
)
def page_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the page table and run every page function over it in one pass."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    state = F.concat(F.lit('<script>window.__DATA__ = {"id":'), page(), F.lit("};</script>"))
    place = F.concat(F.lit('<i data-x="latitude='), F.col("page_id") % 90, F.lit('"></i>'))
    found = extract_pages(pages.withColumn("html", F.concat("html", state, place)))
    return found.select(
        "page_id", "url",
        F.try_variant_get("initial_state", "$.id", "bigint").alias("id"),
        F.col("place.lat").alias("lat"),
    )


# --- X, S4: sitemaps ---------------------------------------------------------

# Child sitemaps named by one index; a fixed number, so an index stays small.
CHILDREN = 50


def child_name(page_id: Column) -> Column:
    return F.concat(F.lit("https://maps.example/"), page_id.cast("string"), F.lit(".xml.gz"))


def urlset(*urls: Column) -> Column:
    found = [part for url in urls for part in (F.lit("<url><loc>\n "), url, F.lit("\t</loc></url>"))]
    return F.concat(F.lit("<urlset>"), *found, F.lit("<loc>a\nb</loc></urlset>"))


def child_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small sitemap per page: its address twice and one that needs no unescape."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        child_name(F.col("page_id")).alias("url"),
        urlset(url, url, F.concat(url, F.lit("&amp;x=1"))).alias("content"),
    )


def root_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes of 50 children each (the last names some that are not there), and
    one plain root per page."""
    group = F.floor(F.col("page_id") / CHILDREN)
    names = F.transform(
        F.sequence(F.col("g") * CHILDREN, F.col("g") * CHILDREN + CHILDREN),
        lambda i: F.concat(F.lit("<sitemap><loc>"), child_name(i), F.lit("</loc></sitemap>")),
    )
    pages = table(spark, sf_dir, "pages")
    indexes = (
        pages.select(group.alias("g"))
        .distinct()
        .select(
            F.concat(F.lit("index-"), "g").alias("portal"),
            F.concat(F.lit("<sitemapindex>"), F.array_join(names, ""), F.lit("</sitemapindex>")).alias("content"),
        )
    )
    plain = pages.select(
        F.concat(F.lit("plain-"), page()).alias("portal"), urlset(F.col("url")).alias("content")
    )
    return indexes.unionByName(plain)


@query(
    "X1_sitemap_urls",
    "SELECT url FROM pages UNION ALL SELECT url FROM pages UNION ALL SELECT url || '&amp;x=1' FROM pages",
)
def urls_of_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap_urls(child_maps(spark, sf_dir).select("content"))


# A child at the border of two indexes is named by both.
CHILD_URLS_SQL = """
    SELECT 'index-' || g AS portal, found AS url
    FROM (SELECT page_id, unnest([url, url, url || '&amp;x=1']) AS found FROM pages)
        JOIN (SELECT DISTINCT page_id // 50 AS g FROM pages)
        ON page_id // 50 = g OR page_id = g * 50 + 50"""


@query(
    "X2_sitemap_listing_urls",
    CHILD_URLS_SQL + " UNION ALL SELECT 'plain-' || page_id, url FROM pages",
)
def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitemap_listing_urls(root_maps(spark, sf_dir), child_maps(spark, sf_dir))


@query("D1_union_of_children", f"SELECT url, count(*) AS n FROM ({CHILD_URLS_SQL}) GROUP BY url")
def union_of_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexes = root_maps(spark, sf_dir).where(F.col("portal").startswith("index-"))
    found = sitemap_listing_urls(indexes, child_maps(spark, sf_dir))
    return found.groupBy("url").agg(F.count("*").alias("n"))


@query(
    "J6_index_to_child",
    """SELECT 'index-' || g AS portal, count(*) AS children FROM pages, (SELECT DISTINCT page_id // 50 AS g FROM pages)
    WHERE page_id // 50 = g OR page_id = g * 50 + 50 GROUP BY g""",
)
def index_to_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = root_maps(spark, sf_dir).where(F.col("portal").startswith("index-"))
    named = sitemap_urls(roots).join(child_maps(spark, sf_dir).select("url"), "url")
    return named.groupBy("portal").agg(F.count("*").alias("children"))


@query("X3_filter_urls", "SELECT page_id, url FROM pages WHERE url ILIKE '%/en/%' OR url ILIKE '%.html'")
def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), r"/EN/|\.HTML$")


@query("S4_read_sitemaps", "SELECT unnest([url, url || '&amp;x=1']) AS url, 2 AS files FROM pages")
def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the sitemaps out plain and packed, and read both back."""
    maps = child_maps(spark, sf_dir).select("content")
    path = new_dir(spark, "sitemaps")
    maps.write.text(f"{path}/plain")
    maps.write.option("compression", "gzip").text(f"{path}/packed")
    found = sitemap_urls(read_sitemaps(spark, f"{path}/*"))
    packed = F.col("path").endswith(".gz").cast("int")
    return found.groupBy("url").agg(F.countDistinct(packed).cast("int").alias("files"))
