"""Graph search against comparing all vectors."""

import math
from collections import defaultdict

import numpy as np
from conftest import SF_DIR
from pyspark.sql import functions as F

from listingflow.llm import neighbours
from listingflow.llm import queries as llm


def brute(rows, asked, k):
    out = {}
    for q, v in rows:
        if asked(q):
            scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def listed(frame):
    got = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def recall(got, want, slack=1e-9):
    """Share of the wanted results that were found, or others as near."""
    hit = total = 0
    for q, best in want.items():
        total += len(best)
        own = got.get(q, [])
        assert all(a >= b - slack for (_, a), (_, b) in zip(own, own[1:], strict=False)) and len({i for i, _ in own}) == len(own)
        if best:
            hit += sum(s >= best[-1][1] - slack for _, s in own)
    return hit / total


def test_vectors_of_any_length_and_norm(spark):
    draw = np.random.default_rng(3)
    rows = [(k, (draw.standard_normal(16) * 2.0 ** draw.integers(-6, 7)).tolist()) for k in range(700)]
    rows += [(1000 + k, draw.standard_normal(5).tolist()) for k in range(60)]
    rows += [(2000 + k, rows[0][1]) for k in range(40)]  # copies
    rows += [(3000, [1e300, 1e300, 0.0]), (3020, [1e-300, 1e-300, 0.0]), (3040, [4.0, 2.0])]
    bad = [(5000, None), (5020, []), (5040, [0.0] * 16), (5060, [math.nan] * 16), (5080, [math.inf] * 16), (5100, [None] * 16)]
    frame = spark.createDataFrame([*rows, rows[5], *bad, (None, [1.0] * 16)], "vec_id long, embedding array<double>")
    frame = frame.selectExpr("*", "1 as node", "2 as query", "'x' as code")
    result = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=10)
    assert dict(result.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    got = listed(result)
    vectors = [(i, np.array(v)) for i, v in rows]
    want = brute(vectors, lambda q: q % 20 == 0, 10)
    assert set(got) == {q for q, best in want.items() if best} and all(len(got[q]) == len(want[q]) for q in got)
    by_id = dict(vectors)
    assert all(math.isclose(s, float(by_id[q] @ by_id[i]), rel_tol=1e-12) for q in got for i, s in got[q])
    small = {q: best for q, best in want.items() if q < 3000}
    assert recall(got, small) >= 0.9
    # Of equal vectors the smaller ids come first.
    copies = [i for i, _ in got[2000] if i >= 2000 or i == 0]
    assert len(copies) > 1 and copies == [0, *range(2001, 2000 + len(copies))]
    assert neighbours.nearest(frame.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(frame.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_crowded_groups_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    draw = np.random.default_rng(4)
    centre = draw.standard_normal(12)
    rows = [(k, (centre + 0.01 * draw.standard_normal(12)).tolist()) for k in range(300)]  # all near copies
    rows += [(1000 + k, draw.standard_normal(12).tolist()) for k in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = listed(neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=10))
    vectors = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    assert recall(got, brute(vectors, lambda q: q % 20 == 0, 10)) >= 0.9


def test_query_finds_what_all_comparisons_find(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = listed(llm.QUERIES["op11_graph_neighbours"](spark, SF_DIR))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
