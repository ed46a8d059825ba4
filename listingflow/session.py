"""Session settings and the shared folder that lineage is cut into."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Tasks per core where costly work on each row is spread.
TASKS_PER_CORE = 4


def build_session(app: str = "listingflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Of equal JSON keys the last counts, as it does for typed JSON reading.
        "spark.sql.variant.allowDuplicateKeys": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names, or its checkpoint folder."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return named.rstrip("/")


def ensure_shared_dir(spark: SparkSession, local: str = "/tmp/checkpoints") -> str:
    """As `shared_dir`; a session of one machine that names none is given `local`."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local"):
        if not spark.sparkContext.master.startswith("local-cluster"):
            spark.conf.set(CHECKPOINT_SETTING, local)
    return shared_dir(spark)


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path of its own below the shared folder (not created yet)."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and read it from there.

    Used where two branches of a plan must see the very same rows in the very
    same partitions, also after an executor is lost.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, which cuts its lineage."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a `stored` table that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to as many tasks as the cluster works on well, by the keys if any.

    Splits go by bytes: rows that are small in their files but costly to work on, as
    one that is parsed, may all be in one task else. Do it while rows are narrow.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, *keys)
