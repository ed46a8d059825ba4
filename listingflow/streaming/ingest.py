"""Incremental runs: each takes only the payload files landed since the last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.operators.parse import OUTCOME
from listingflow.operators.upsert import REQUIRED, upsert_latest, write_order
from listingflow.plans.collect import page_outcomes
from listingflow.session import spread
from listingflow.sources.payloads import PAGE_CONTEXT
from listingflow.sources.tables import stamp

Parse = Callable[[DataFrame], DataFrame]


def ingest_incremental(
    spark: SparkSession,
    source: str,
    log: str,
    checkpoint: str,
    parse: Parse,
    schema: str,
    max_files: int | None = None,
    file_glob: str | None = None,
) -> None:
    """Parse newly landed Parquet files and add the rows to the change log.

    Meant to be started on a schedule; it returns when all files are done. Each
    micro-batch writes a folder of its own and replaces it when it is replayed
    after a failure, so a replay changes nothing. The cost is that of the new
    files: the current table is made from the log when it is read, and folded
    into a new snapshot (`current`) as rarely as is convenient.

    `parse` is any DataFrame -> DataFrame function (see `plans.collect`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parse(batch).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    _each_batch(spark, source, checkpoint, write, schema, max_files, file_glob)


def ingest_pages(
    spark: SparkSession,
    source: str,
    log: str,
    checkpoint: str,
    base_url: str,
    portal: str,
    now: str,
    max_files: int | None = None,
    file_glob: str | None = None,
) -> None:
    """Parse newly landed listing pages; all that they hold goes to the log.

    Each page is parsed once, in as many tasks as the cluster works on well, however few
    files a batch has. Good items, rejected ones and pages without items go to
    folders of their own below the micro-batch's (`part=good`, `rejected`, `page`), by
    one write that a replay replaces as a whole: good + rejected + pages is always the
    input. No walk is cut here, for its pages may come in several batches; the stop
    rule is applied to the whole log when it is read (`plans.collect.counted`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = stamp(page_outcomes(spread(batch), base_url), portal, now)
        part = F.when(F.col(OUTCOME).isNull(), "good").otherwise(
            F.when(F.col(OUTCOME).startswith("page:"), "page").otherwise("rejected")
        )
        (
            rows.withColumn("part", part)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")  # a replay leaves nothing of the first attempt
            .partitionBy("part")
            .parquet(f"{log}/batch={batch_id}")
        )

    _each_batch(spark, source, checkpoint, write, PAGE_CONTEXT, max_files, file_glob)


def _each_batch(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    schema: str,
    max_files: int | None,
    file_glob: str | None,
) -> None:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_log(spark: SparkSession, log: str, after_batch: int = -1) -> DataFrame:
    """Rows of the change log with their `batch`, optionally only of later batches."""
    return (
        spark.read.option("basePath", log)
        .option("mergeSchema", "true")  # a later batch may have more columns
        .parquet(f"{log}/batch=*")
        .withColumn("batch", F.col("batch").cast("bigint"))
        .where(F.col("batch") > after_batch)
    )


def current(
    snapshot: DataFrame | None,
    log: DataFrame,
    key: str = "url",
    order: list | None = None,
    required: list[str] = REQUIRED,
) -> DataFrame:
    """Last version of each key: the log's rows over the snapshot's."""
    order = [F.col("batch"), *(write_order() if order is None else order)]
    return upsert_latest(snapshot, log, order, key=key, required=required)
