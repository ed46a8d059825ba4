"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.session import discard, stored  # noqa: F401  (the operators take them from here)

ROOT = str(Path(__file__).resolve().parents[2])

# Bounds of one Arrow batch, so that a worker holds few long texts.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers find this package, and bound what a batch holds."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{known}".rstrip(":")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_DROPS: list[Callable[[], None]] = []


def hold_alone(drop: Callable[[], None] | None = None) -> None:
    """Let what the last operator remembered in this worker go, as the task of another begins.

    A worker outlives its tasks, and what several operators remember would add up.
    `drop` makes the one that begins forget, if it remembers anything.
    """
    for other in _DROPS:
        if other != drop:
            other()
    _DROPS[:] = [drop] if drop else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, *taken: list[str]) -> str:
    """`name`, longer by as many underscores as it takes to clash with no column taken."""
    known = {column.lower() for columns in taken for column in columns}
    while name.lower() in known:
        name += "_"
    return name


def remainder(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5: the fold that hold-outs are made of."""
    return F.coalesce(F.crc32(id_column.cast("string")), F.lit(0)) % 5


def labels_to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the documents that may be learned from."""
    return table(spark, sf_dir, "labels").where(remainder(F.col("doc_id")) != 0)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8 bytes."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def records(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch, as tuples of the named columns."""
    return zip(*(batch.column(name).to_pylist() for name in names), strict=True)


