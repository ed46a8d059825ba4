"""Stop rules, limits and positions against brute force, also across piece borders."""

import random

import pytest
from pyspark.sql import functions as F

from listingflow.operators import positions, rules
from listingflow.operators.counts import listings_per_state
from listingflow.operators.positions import sum_before, with_position
from listingflow.sources.payloads import unreadable


@pytest.fixture(params=[3, 4096])
def piece(request, monkeypatch):
    """Run once with pieces so short that every walk crosses several."""
    monkeypatch.setattr(positions, "PIECE", request.param)
    monkeypatch.setattr(rules, "PIECE", request.param)


def brute_walk(pages, k):
    """Pages kept: (page, empty, error) in page order, until k empties in a row or an error."""
    kept, run = [], 0
    for page, empty, error in sorted(pages):
        if error:
            break
        run = run + 1 if empty else 0
        if run >= k:
            break
        if not empty:
            kept.append(page)
    return kept


@pytest.mark.parametrize("k", [1, 2, 5])
def test_stop_rule(spark, piece, k):
    rng = random.Random(k)
    walks = {}
    for walk in range(40):
        numbers = sorted(rng.sample(range(1, 90), rng.randint(1, 60)))
        share = rng.random()
        walks[walk] = [(p, rng.random() < share, rng.random() < 0.02) for p in numbers]
    rows = [(w, *p) for w, pages in walks.items() for p in pages]
    df = spark.createDataFrame(rows, "w int, page int, empty boolean, error boolean").repartition(3)
    got = rules.truncate_after_empty(df, ["w"], k, error="error")
    found = {w: [] for w in walks}
    for r in got.where("NOT error").collect():
        found[r["w"]].append(r["page"])
    assert {w: sorted(p) for w, p in found.items()} == {w: brute_walk(p, k) for w, p in walks.items()}


def test_stop_rule_beyond_the_last_page_keeps_all(spark, piece):
    df = spark.createDataFrame([(1, p, False) for p in range(1, 9)], "w int, page int, empty boolean")
    assert rules.truncate_after_empty(df, ["w"], 9).count() == 8


def test_example_walk(spark, piece):
    empty = [False, True, False, True, True, False]
    df = spark.createDataFrame([(1, i, e) for i, e in enumerate(empty, 1)], "w int, page int, empty boolean")
    assert sorted(r["page"] for r in rules.truncate_after_empty(df, ["w"], 2).collect()) == [1, 3]


def test_positions_with_one_group_of_most_rows(spark):
    rng = random.Random(1)
    rows = [("hot", f"n{rng.random()}") for _ in range(2000)] + [(None, "x"), ("a", "b"), ("a", "á"), ("a", "B")]
    df = spark.createDataFrame(rows, "uf string, city string")
    got = {}
    for r in with_position(df, ["uf"], ["city"], "at", partitions=7).collect():
        got.setdefault(r["uf"], []).append((r["at"], r["city"]))
    for uf, found in got.items():
        names = sorted(city for u, city in rows if u == uf)
        assert sorted(found) == list(enumerate(names))


def test_sum_before(spark, piece):
    rng = random.Random(2)
    rows = [(g, at, rng.randint(0, 9)) for g in "ab" for at in rng.sample(range(100), 40)]
    df = spark.createDataFrame(rows, "g string, at int, v int")
    got = {(r["g"], r["at"]): r["before"] for r in sum_before(df, ["g"], "at", "v").collect()}
    assert got == {(g, at): sum(v for h, b, v in rows if h == g and b < at) for g, at, _ in rows}


def test_limit_groups_keeps_the_crossing_city(spark, piece):
    df = spark.createDataFrame([("a", i, 5) for i in range(3)] + [("b", 0, 0)], "uf string, city_idx int, saved int")
    got = rules.limit_groups(df, 6).collect()
    assert sorted((r["uf"], r["city_idx"]) for r in got) == [("a", 0), ("a", 1), ("b", 0)]
    assert rules.limit_groups(df, None).count() == 4


@pytest.mark.parametrize("n,kept", [(None, 300), (0, 300), (1, 2), (7, 14), (120, 240), (150, 300), (900, 300)])
def test_limit_rows_per_group(spark, n, kept):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), "id").repartition(7)
    got = rules.limit_rows(df, n, ["id"], by=["g"])
    assert got.count() == kept and got.columns == ["g", "id"]
    assert got.agg(F.max("id")).first()[0] == kept - 1


def test_limit_rows_in_all(spark):
    df = spark.range(300).select("id").repartition(7)
    for n in (1, 7, 120, 300, 500):
        got = rules.limit_rows(df, n, ["id"])
        assert sorted(r["id"] for r in got.collect()) == list(range(min(n, 300)))
    assert rules.limit_rows(df.where("false"), 5, ["id"]).count() == 0


def test_limit_rows_with_ties_and_nulls(spark):
    """Exactly n rows, also where many are equal in order or in all; nulls come first."""
    rows = [(g, None if k % 5 == 0 else k % 3, "same" if k % 2 else f"t{k}") for k in range(60) for g in (None, "a")]
    df = spark.createDataFrame([*rows, ("b", 1, "x")], "g string, at int, text string").repartition(5)
    for n in (1, 12, 13, 29, 60, 61):
        got = rules.limit_rows(df, n, ["at"], by=["g"])
        sizes = {r["g"]: r["count"] for r in got.groupBy("g").count().collect()}
        assert sizes == {None: min(n, 60), "a": min(n, 60), "b": 1}
        want = sorted(-1 if r[1] is None else r[1] for r in rows if r[0] == "a")[:n]
        assert sorted(-1 if r.at is None else r.at for r in got.where("g = 'a'").collect()) == want
        assert rows_sorted(got) == rows_sorted(rules.limit_rows(df.repartition(3), n, ["at"], by=["g"]))
        assert rules.limit_rows(df, n, ["at"]).count() == n
    same = spark.createDataFrame([(1, 2.5)] * 40, "k int, v double")
    assert rules.limit_rows(same, 7, ["k"]).count() == 7


def rows_sorted(df):
    return sorted(map(str, df.collect()))


def test_copies_of_a_page_count_once(spark, piece):
    rows = [(1, 1, False)] + [(1, 2, True)] * 50 + [(1, 3, False)]
    df = spark.createDataFrame(rows, "w int, page int, empty boolean")
    assert rules.truncate_after_empty(df, ["w"], 2).count() == 2


def test_page_budget(spark):
    df = spark.createDataFrame([(50, 1, 100), (3, 1, 100), (50, 1, 0), (50, 10, 19)], "total int, start int, n int")
    c = F.col
    rows = df.select(rules.last_page(c("total"), c("start"), c("n")).alias("last")).collect()
    assert [r["last"] for r in rows] == [7, 3, 50, 11]


def test_unreadable_payloads_are_set_aside(spark):
    texts = ['{"a":1}', ' {"a":1} ', "[1,2]", '{"a":1} x', '{"a":1}{', '{"a":', "", None, '1,2', "null", '{"a":1},"end"', '{"a":1},{"end":"x"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    got = {r["id"]: r["reason"] for r in unreadable(rows).collect()}
    assert got == {3: "not JSON", 4: "not JSON", 5: "not JSON", 6: "not JSON", 7: "missing", 8: "not JSON", 10: "not JSON", 11: "not JSON"}
    assert unreadable(rows.limit(0)).collect() == []


def test_mean_price_leaves_out_what_is_no_price(spark):
    prices = [("AC", 0.004), ("AC", 0.004), ("AC", float("inf")), ("AC", 1e30), ("RJ", 1e17), ("SP", None)]
    rows = spark.createDataFrame(prices, "estado string, preco double")
    got = {tuple(r) for r in listings_per_state(rows).collect()}
    assert got == {("AC", 4, 2, 0.004), ("RJ", 1, 1, 1e17), ("SP", 1, 0, None)}
