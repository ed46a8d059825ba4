"""A listings table of many versions, of which an update rewrites only what it touches.

`data/v=<n>/estado=<state>` holds what version n wrote, and `manifest` names the folders
each version consists of. An update looks for the folders that hold a replaced
address, by reading addresses only; rows of these folders and the new ones go to the
new version, all other folders are taken over by name and not opened. The manifest
is written last: until then readers see the version before.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.operators.upsert import REQUIRED, latest, savable, write_order
from listingflow.session import cut_lineage
from listingflow.sources.tables import conform_listings, stored_listings, write_listings

FOLDER = r"(v=[^/]+/estado=[^/]+)/[^/]+$"
MANIFEST = "version bigint, folder string"


def _manifest(spark: SparkSession, root: str, version: int | None) -> tuple[int, list[str]]:
    """The newest version, or the one asked for, and its folders; none for a new table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return -1, []
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    # A row per state and version that still counts.
    return version, sorted(r.folder for r in rows.where(F.col("version") == version).collect())


def _open(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    paths = [f"{root}/data/{folder}" for folder in folders]
    return stored_listings(spark.read.option("basePath", f"{root}/data"), paths)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of the table, or the one asked for."""
    found, folders = _manifest(spark, root, version)
    if not folders:
        raise ValueError(f"{root} has no version {'' if version is None else found}".rstrip())
    return _open(spark, root, folders).drop("_metadata")


def touched_folders(rows: DataFrame, urls: DataFrame) -> list[str]:
    """The folders that hold any of the addresses; only addresses are read."""
    folder = F.regexp_extract("_metadata.file_path", FOLDER, 1).alias("folder")
    held = rows.select("url", folder).join(urls.select("url"), "url", "left_semi")
    return sorted(unquote(r.folder) for r in held.select("folder").distinct().collect())


def update_listings(spark: SparkSession, root: str, good: DataFrame, order: list[Column] | None = None) -> int:
    """Write the good rows of a run as a new version; its number.

    The last version of each address in `order` is put in place of the stored one, also
    if its state has changed. Rows without address or portal are refused. Versions are
    written one at a time.
    """
    fresh = latest(good.where(savable(good, REQUIRED)), "url", write_order() if order is None else order)
    fresh = cut_lineage(conform_listings(fresh))
    version, folders = _manifest(spark, root, None)
    touched = touched_folders(_open(spark, root, folders), fresh) if folders else []
    rows = fresh
    if touched:
        kept = _open(spark, root, touched).join(fresh.select("url"), "url", "left_anti")
        rows = kept.select(*fresh.columns).unionByName(fresh)
    version += 1
    write_listings(rows, f"{root}/data/v={version}")
    written = spark.read.schema(fresh.schema).parquet(f"{root}/data/v={version}").inputFiles()
    new = {f"v={version}/{unquote(file).rsplit('/', 2)[1]}" for file in written}
    listed = [(version, folder) for folder in sorted(set(folders) - set(touched) | new)]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version
