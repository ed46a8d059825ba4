"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to the smallest among them and itself.

    The large star moves the larger neighbours of a node, the small star the
    smaller ones and the node. The smallest is found by an aggregate and joined
    back, so that a node of very many neighbours can be split.
    """
    ends = edges.select(F.col("u").alias("n"), F.col("v").alias("m"))
    if large:
        ends = ends.unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    else:
        ends = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m"))
    least = ends.groupBy(F.col("n").alias("n_")).agg(F.min("m").alias("least"))
    least = least.withColumn("least", F.least("least", "n_"))
    moved = ends.join(least, F.col("n") == F.col("n_"))
    if large:
        out = moved.where("m > n").select(F.col("m").alias("u"), F.col("least").alias("v"))
    else:
        out = moved.where("m <> least").select(F.col("m").alias("u"), F.col("least").alias("v"))
        out = out.unionByName(least.select(F.col("n_").alias("u"), F.col("least").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    `edges` has two columns of one orderable type, in any direction and number;
    loops and edges with a null end do not count. Large and small stars take turns
    until nothing changes, which takes about log2 of the longest path; each turn is
    written to the shared folder, so that a lost executor costs that turn only.
    Without edges the result is empty.
    """
    u, v = edges.columns
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct()
    now = stored(now, "edges")
    state = None
    while True:
        now = stored(_star(_star(now, large=True), large=False), "edges")
        mark = F.bit_xor(F.xxhash64("u", "v"))
        before, state = state, tuple(now.agg(F.count("*"), mark).first())
        if state == before or not state[0]:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
