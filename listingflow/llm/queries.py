"""The operators on their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import quality, toxicity
from listingflow.llm.align import align
from listingflow.llm.bpe import encode_decode
from listingflow.llm.chats import SQL as CHATS_SQL
from listingflow.llm.chats import maximal_conversations
from listingflow.llm.common import labels_to_learn, remainder, table
from listingflow.llm.decontaminate import contaminated
from listingflow.llm.lm import score_documents
from listingflow.llm.minmax import near_duplicates
from listingflow.llm.neighbours import nearest
from listingflow.llm.pii import personal_data
from listingflow.llm.projections import near_vectors
from listingflow.llm.repeats import find_runs
from listingflow.llm.urls import judge

Query = Callable[[SparkSession, str], DataFrame]


# The score from which a document is taken as toxic.
TOXIC = 0.5


def pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, labels_to_learn(spark, sf_dir))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        quality.accepted(F.col("score")).cast("int").alias("predicted"),
    )


def toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels have two categories: text of low quality, then toxic text."""
    docs = table(spark, sf_dir, "documents")
    labels = labels_to_learn(spark, sf_dir).select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    models = toxicity.train(docs, labels, ["junk", "toxic"])
    scored = toxicity.score(docs, models, ["junk", "toxic"])
    toxic = F.col("p_toxic") >= TOXIC
    return scored.select("doc_id", "p_junk", "p_toxic", toxic.cast("int").alias("toxic"))


def chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_conversations(table(spark, sf_dir, "conversations"))


def collision_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), remainder(F.col("doc_id")) != 1)


def path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ids=False)


def minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(table(spark, sf_dir, "documents"), a, b, digest=True).withColumnRenamed("groups", "groups_sha256")


def with_cycles(docs: DataFrame) -> DataFrame:
    """The documents; of those whose id says so, the words from one on repeat a cycle.

    With h = crc32(doc_id) and g = h / 10: if h % 10 = 0, each word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8). Documents
    without an id or without words stay.
    """
    space = " \t\n\x0b\f\r"
    trimmed = F.btrim("text", F.lit(space))
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = (h % 10 == 0) & (trimmed != "")
    words = F.when(chosen, F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))
    shaped = docs.select("doc_id", "text", h.alias("h"), words.alias("words"))
    shaped = shaped.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("words").cast("long"))
    shaped = shaped.withColumn("a", F.expr("if(words is null, 0, g % n)"))
    shaped = shaped.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    cycle = "slice(words, int(a + 1), int(p))"
    tail = f"slice(flatten(array_repeat({cycle}, int((n - a + p - 1) div p))), 1, int(n - a))"
    text = F.expr(f"if(words is null, text, array_join(concat(slice(words, 1, int(a)), {tail}), ' '))")
    return shaped.select("doc_id", text.alias("text"))


def repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_cycles(table(spark, sf_dir, "documents")), least=6, times=4)
    # The longest run first; of equal ones the smallest start, then period.
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length as l, r.start as s, r.period as p)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("first"), listed.alias("listed"), "collapsed").select(
        "doc_id",
        "n_runs",
        F.col("first.s").alias("start"),
        (-F.col("first.l")).alias("length"),
        F.col("first.p").alias("period"),
        F.expr("(1000 * -first.l) div first.p").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_pu_quality": pu_quality,
    "op2_toxicity_chain": toxicity_chain,
    "op3_chat_collapse": chat_collapse,
    "op4_collision_near_vectors": collision_near_vectors,
    "op5_gru_scores": gru_scores,
    "op6_path_templates": path_templates,
    "op7_pii_spans": pii_spans,
    "op8_byte_bpe": byte_bpe,
    "op9_minmax_near_dedup": minmax_near_dedup,
    "op10_simhash_decontamination": simhash_decontamination,
    "op11_graph_neighbours": graph_neighbours,
    "op12_token_alignment": token_alignment,
    "op13_repeated_runs": repeated_runs,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op3_chat_collapse": CHATS_SQL}
