"""From raw documents to token ids: what is bad, repeated or leaked goes, personal data
is covered, and the rest is encoded.

Each stage takes `(spark, docs, sf_dir)` and returns all that it keeps; all but the
last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import quality
from listingflow.llm.bpe import encode_decode
from listingflow.llm.common import free_name, labels_to_learn, stored, table
from listingflow.llm.decontaminate import contaminated
from listingflow.llm.minmax import near_duplicates
from listingflow.llm.pii import redact

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, labels_to_learn(spark, sf_dir))
    return quality.keep_good(docs, model, quality.GOOD)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """`docs` with a column that tells rows apart by id and text, and two free names: that
    of the column and another. Keys sort as ids do, rows without an id last."""
    key = free_name("_key", docs.columns)
    text = F.concat(F.when(F.col("text").isNull(), "0").otherwise("1"), F.coalesce("text", F.lit("")))
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.sha2(text, 256).alias("text"))
    return docs.withColumn(key, own), key, free_name("_found", docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Rows are told apart by id and text: of rows equal in both one stays, and rows that
    share an id, or have none, go or stay each by its own text.
    """
    keyed, key, found = _keyed(docs)
    kept = near_duplicates(keyed.select(key, "text"), size=5, percent=80, id=key).where("kept")
    kept = kept.select(F.to_json(key).alias(found))
    own = keyed.withColumn(key, F.to_json(key))
    return own.join(kept, F.col(key) == F.col(found), "left_semi").dropDuplicates([key]).drop(key)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    keyed, key, found = _keyed(docs)
    keyed = keyed.withColumn(key, F.to_json(key))
    leaks = contaminated(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), id=key)
    leaks = leaks.select(F.col(key).alias(found)).distinct()
    return keyed.join(leaks, F.col(key) == F.col(found), "left_anti").drop(key)


def cover_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    covered = redact(docs)
    return covered.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with digests of the ids and of the decoded texts."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal data", cover_personal_data),
    ("byte-level BPE", encode),
]

# No stage can be told in SQL as a whole; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
