"""HTML pages, plain table reads, and the page extraction projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions import html as H
from listingflow.functions.text import coordinates
from listingflow.functions.variants import held

PAGES = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Everything the page functions find, in one narrow projection; a page is cut into
    its parts once for all of them."""
    body, parts = F.col(html), F.col("_parts")
    others = [name for name in pages.columns if name != html]
    return pages.withColumn("_parts", held(H.page_parts(body))).select(
        *others,
        H.json_ld(body, parts).alias("json_ld"),
        H.next_data(body).alias("next_data"),
        H.initial_state(body).alias("initial_state"),
        H.photos(body, parts).alias("fotos_urls"),
        H.page_dates(body, parts).alias("dates"),
        coordinates(body).alias("place"),
    )
