"""Logged conversations: those that are a beginning of a longer one are left out, the
others are rendered. Column expressions only.

A chat that is logged after every turn leaves a snapshot of each length. Every turn
has a rolling hash of all turns up to it; a conversation goes if its last such hash
stands at the same place inside another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# How a turn is written out; a null role is UNKNOWN.
TURN = "<|im_start|>%s\n%s<|im_end|>\n"
UNKNOWN = "unknown"


def _turn_hash(role: str, text: str):
    """A digest of a turn; null and empty differ."""
    part = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.hex(F.col(c).cast("string")))) for c in (role, text)]
    return F.sha2(F.concat_ws("/", *part), 256)


def maximal_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The conversations that no other begins with, rendered: `conv`, `n_turns`,
    `n_copies` and `chat`.

    The turns of a conversation are its distinct rows, by turn (nulls first), then
    role, then the digest of the text. Of equal conversations that of the smallest
    id stays and `n_copies` tells how many there are; a null id counts as an id, and
    as the smallest. Null texts are rendered empty, null roles as "unknown". An empty
    table gives none. Other columns are not read.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).withColumn("digest", _turn_hash("role", "text"))
    narrow = rows.select("conv", "turn", "role", "digest").distinct()
    order = Window.partitionBy("conv").orderBy("turn", "role", "digest")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = narrow.withColumn("at", F.row_number().over(order))
    # Each turn's hash holds its place, so their combination tells their order.
    placed = placed.select(
        "conv",
        "at",
        F.bit_xor(F.xxhash64("at", "digest")).over(sofar).alias("h1"),
        F.bit_xor(F.xxhash64("digest", "at", F.lit("second"))).over(sofar).alias("h2"),
        F.lead("at").over(order).isNull().alias("last"),
    )
    # Copies count once before anything is compared.
    prefixes = placed.groupBy("at", "h1", "h2").agg(
        F.min(F.when(F.col("last"), F.struct("conv"))).alias("first"),
        F.sum(F.col("last").cast("long")).alias("n_copies"),
        F.max(~F.col("last")).alias("inside"),
    )
    kept = prefixes.where("n_copies > 0 and not inside").select(F.col("first.conv").alias("k"), F.col("at").alias("n_turns"), "n_copies")
    own = rows.distinct().join(kept, F.col("conv").eqNullSafe(F.col("k")))
    said = F.struct("turn", "role", "digest", "text")
    out = own.groupBy("conv", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(said)).alias("turns"))
    shown = F.transform(
        "turns", lambda t: F.format_string(TURN, F.coalesce(t["role"], F.lit(UNKNOWN)), F.coalesce(t["text"], F.lit("")))
    )
    return out.select(F.col("conv").alias(conv), F.col("n_turns").cast("long").alias("n_turns"), "n_copies", F.array_join(shown, "").alias("chat"))


# The same rows in DuckDB, by comparing lists of turns.
SQL = r"""
with t as (
  select distinct conv_id, turn, coalesce(role, 'unknown') r, coalesce(text, '') x, role, text from conversations
), c as (
  select conv_id, list({'r': role, 'x': text} order by turn nulls first, role nulls first, sha256(text)) l,
         string_agg('<|im_start|>' || r || chr(10) || x || '<|im_end|>' || chr(10), '' order by turn nulls first, role nulls first, sha256(text)) chat
  from t group by conv_id
), u as (
  select l, min(conv_id) conv_id, count(*) n_copies, any_value(chat) chat from c group by l
), p as (
  select distinct list_slice(l, 1, k) l from (select l, unnest(range(1, len(l))) k from c)
)
select conv_id, cast(len(l) as bigint) n_turns, n_copies, chat from u where l not in (select l from p)
"""
