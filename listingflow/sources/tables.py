"""The listings table on disk: shape, layout, reading and schema growth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.functions.text import iso_text
from listingflow.schema import LISTINGS


def conform_listings(df: DataFrame) -> DataFrame:
    """The listings columns in order and type; absent ones are NULL, others go."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LISTINGS.fields
        )
    )


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; columns only `new` has come last and are NULL for old rows."""
    return old.unionByName(new, allowMissingColumns=True)


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Append the columns (name -> type) that are not there yet."""
    missing = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def stamp(df: DataFrame, portal: str, now: str) -> DataFrame:
    """Mark rows with their portal and collection time; timestamps become ISO text.

    `now` is a parameter, so that a run can be repeated with the same result. A
    collection time that is already there is kept.
    """
    iso = {
        f.name: iso_text(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    df = df.withColumns(iso) if iso else df
    collected = F.coalesce("data_coleta", F.lit(now)) if "data_coleta" in df.columns else F.lit(now)
    return df.withColumns({"portal": F.lit(portal), "data_coleta": collected})


# A folder cannot be named by an empty text: an empty state gets this name, which is no code.
NO_STATE = "(none)"
# Columns that are looked up by single values, with the values a row group may hold of each.
LOOK_UPS = {"url": 100_000, "portal": 100}
ROW_GROUP_BYTES = 16 << 20


def write_listings(df: DataFrame, path: str, files: int | None = None, row_group: int = ROW_GROUP_BYTES) -> None:
    """Write a new snapshot, laid out for queries by state, place, type, purpose, portal or url.

    Rows are spread by ranges of place and address, so a state or a
    neighbourhood with a large share of the rows goes to many files, while a
    query for one place still reads few. Within a file, which holds few places, rows are sorted
    by purpose and type, so that its row groups hold few of either; Bloom filters tell
    which row groups may hold a url or portal. Never write to a path `df` reads from. Spark
    runs `df` once for the bounds of the ranges and once for the rows: one that is costly to
    make, as parsed items are, is better stored first (`session.stored`).
    """
    place = ["estado", "cidade", "bairro", "url"]
    rows = conform_listings(df)
    rows = rows.withColumn("estado", F.when(F.col("estado") == "", NO_STATE).otherwise(F.col("estado")))
    spread = rows.repartitionByRange(files, *place) if files else rows.repartitionByRange(*place)
    placed = spread.sortWithinPartitions("estado", "finalidade", "tipo", "cidade", "bairro", "url")
    writer = placed.write.partitionBy("estado").mode("errorifexists").option("parquet.block.size", row_group)
    for name, values in LOOK_UPS.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", values)
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)


def stored_listings(reader: DataFrameReader, paths: list[str]) -> DataFrame:
    """Rows of folders that `write_listings` has written, empty states by their own name."""
    rows = reader.schema(LISTINGS).parquet(*paths)
    without = F.col("estado").eqNullSafe(NO_STATE)
    named = rows.where(~without)
    named = named.select(*LISTINGS.fieldNames(), "_metadata")
    unnamed = rows.where(without).withColumn("estado", F.lit("")).select(*named.columns)
    return named.unionByName(unnamed)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot; a query for a state reads its folder only."""
    return stored_listings(spark.read, [path]).select(*LISTINGS.fieldNames())


def only_portal(df: DataFrame, portal: str | None = None) -> DataFrame:
    return df.where(F.col("portal") == portal) if portal else df
