"""Sitemap documents and the page addresses in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed pattern: an address may have white space around it, no line break in it.
LOC = r"(?Ud)<loc>\s*(.*?)\s*</loc>"
INDEX_TAG = "<sitemapindex"


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of each file; `.gz` files are unpacked on reading."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def locs(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(LOC), 1)


def sitemap_urls(df: DataFrame, content: str = "content") -> DataFrame:
    """One row per address; repeated ones stay, nothing is unescaped."""
    others = [name for name in df.columns if name != content]
    return df.select(*others, F.explode(locs(F.col(content))).alias("url"))


def sitemap_listing_urls(roots: DataFrame, docs: DataFrame) -> DataFrame:
    """Addresses reachable from each root: its children's, or its own.

    `roots` is (portal, content), `docs` is (url, content). An index names child
    documents, one level deep; a child that is not there is left out. Documents
    are cut down to their addresses before they are shuffled by name.
    """
    found = roots.select(
        "portal",
        F.col("content").contains(INDEX_TAG).alias("is_index"),
        F.explode(locs(F.col("content"))).alias("url"),
    )
    children = docs.select(F.col("url").alias("child"), locs(F.col("content")).alias("urls"))
    named = found.where("is_index").select("portal", F.col("url").alias("child"))
    from_children = named.join(children, "child").select("portal", F.explode("urls").alias("url"))
    own = found.where(~F.col("is_index")).select("portal", "url")
    return own.unionByName(from_children)


def filter_urls(df: DataFrame, pattern: str | None = None, column: str = "url") -> DataFrame:
    """Keep addresses a pattern is found in, in any case; no pattern keeps all."""
    if not pattern:
        return df
    return df.where(F.col(column).rlike(f"(?iu){pattern}"))
