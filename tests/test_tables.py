"""Upsert, table layout, progress, work lists, discovery and incremental runs."""

import json
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from listingflow.operators import discovery, progress
from listingflow.operators.counts import batch_metrics, count_listings, outcome_totals, saved_totals
from listingflow.operators.upsert import latest, upsert_latest, write_order
from listingflow.plans import worklist
from listingflow.plans.collect import counted, current_listings, parse_pages, split_outcomes
from listingflow.schema import CITY_PROGRESS, LISTINGS
from listingflow.sources import versions as table_versions
from listingflow.sources.payloads import PAGE_CONTEXT, read_pages, read_payloads
from listingflow.sources.tables import (
    add_columns, conform_listings, evolve, read_listings, stamp, write_listings,
)
from listingflow.streaming.ingest import current, ingest_incremental, ingest_pages, read_log

NOW = "2024-06-01T12:00:00"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- upsert ---


def versions(spark, rows):
    return spark.createDataFrame(rows, "url string, portal string, seq int, preco double")


def test_new_version_replaces_the_whole_row(spark):
    old = spark.createDataFrame(
        [("a", "p", 0, 1.0, "sim"), ("b", "p", 0, 2.0, "sim")],
        "url string, portal string, seq int, preco double, imovel_disponivel string",
    )
    new = versions(spark, [("a", "p", 1, None), ("a", "p", 2, 3.0), ("c", "p", 1, 4.0), (None, "p", 1, 5.0), ("d", None, 1, 6.0)])
    order = [F.col("seq")]
    got = upsert_latest(old, new, order)
    assert got.columns == old.columns
    assert rows_of(got.select("url", "preco", "imovel_disponivel").na.fill("-")) == [
        ("a", 3.0, "-"), ("b", 2.0, "sim"), ("c", 4.0, "-"),
    ]
    kept = upsert_latest(old, new, order, preserve=["imovel_disponivel"])
    assert rows_of(kept.select("url", "preco", "imovel_disponivel").na.fill("-")) == [
        ("a", 3.0, "sim"), ("b", 2.0, "sim"), ("c", 4.0, "-"),
    ]
    assert rows_of(upsert_latest(got, new, order).na.fill("-")) == rows_of(got.na.fill("-"))
    assert batch_metrics(new).first().asDict() == {"offered": 5, "saved": 3, "refused": 2}


def test_upsert_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 9 + list("abcdef")), "p", i, float(i)) for i in range(3000)]
    wanted = {}
    for url, _, seq, _ in rows:
        wanted[url] = max(wanted.get(url, -1), seq)
    rng.shuffle(rows)
    for parts in (1, 7):
        got = latest(versions(spark, rows).repartition(parts), "url", [F.col("seq")])
        assert {r["url"]: r["seq"] for r in got.collect()} == wanted


def test_latest_ranks_before_the_shuffle(spark):
    plan = plan_of(latest(versions(spark, [("a", "p", 1, 1.0)]), "url", [F.col("seq")]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_stored_rows_are_not_shuffled_for_few_new_ones(spark, tmp_path):
    versions(spark, [(str(i), "p", 0, 1.0) for i in range(100)]).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    got = upsert_latest(stored, versions(spark, [("5", "p", 1, 2.0)]), [F.col("seq")])
    got.collect()
    plan = plan_of(got)
    final = plan.split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert got.count() == 100


def test_write_order(spark):
    schema = "run int, uf string, city_idx int, neighbourhood string, neighbourhood_pos int, listing_type string, page int, pos int"
    in_order = [
        (0, "SP", 0, "A", 0, "USED", 1, 0), (0, "SP", 0, "A", 0, "USED", 1, 1), (0, "SP", 0, "A", 0, "USED", 2, 0),
        (0, "SP", 0, "A", 0, "DEVELOPMENT", 1, 0), (0, "SP", 0, "B", 1, "USED", 1, 0), (0, "SP", 0, "", None, "USED", 1, 0),
        (0, "SP", 1, "A", 0, "USED", 1, 0), (0, "AC", 0, "A", 0, "USED", 1, 0), (0, "RR", 0, "A", 0, "USED", 1, 0),
        (1, "SP", 0, "A", 0, "USED", 1, 0),
    ]
    df = spark.createDataFrame(random.Random(1).sample(in_order, len(in_order)), schema)
    assert [tuple(r) for r in df.orderBy(*write_order()).collect()] == in_order


# --- table ---


def test_conform_and_evolve(spark):
    df = spark.createDataFrame([("u", "5", 1)], "url string, preco string, extra int")
    got = conform_listings(df)
    assert got.schema == LISTINGS and len(got.columns) == 49
    assert got.first()["preco"] == 5.0
    old = spark.createDataFrame([(1, "a")], "k int, s string")
    new = spark.createDataFrame([(2, "b", 7)], "k int, s string, n int")
    assert rows_of(evolve(old, new).na.fill(-1)) == [(1, "a", -1), (2, "b", 7)]
    assert add_columns(new, {"n": "int", "z": "double"}).dtypes[-1] == ("z", "double")


def test_table_layout(spark, tmp_path):
    rows = [(f"u{i}", ["SP", "SP", "RJ"][i % 3], f"c{i % 5}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "url string, estado string, cidade string, preco double")
    path = str(tmp_path / "listings")
    write_listings(stamp(df, "p", NOW), path, files=4)
    back = read_listings(spark, path)
    assert back.columns == LISTINGS.fieldNames() and back.count() == 300
    found = back.where("estado = 'RJ' AND cidade = 'c1'").select("url", "preco")
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(estado" in plan and "EqualTo(cidade,c1)" in plan
    assert "raw_json" not in plan
    assert found.count() == sum(1 for r in rows if r[1] == "RJ" and r[2] == "c1")
    # The state with most rows is spread over several files.
    state = spark.read.parquet(f"{path}/estado=SP")
    assert state.select("_metadata.file_path").distinct().count() > 1
    with pytest.raises(Exception, match="exists"):
        write_listings(df, path)


def scanned_rows(df):
    """Rows that the scan of a collected query has read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k).metrics() for k in range(leaves.size())]
    return sum(m.apply("numOutputRows").value() for m in scans if m.contains("numFiles"))


def test_row_groups_are_skipped_for_every_look_up(spark, tmp_path):
    """Each column that is looked up by value: most rows are never read."""
    rows = [
        (f"https://p/{i * 7919 % 6000:05d}", f"c{i % 40:02d}", f"b{i % 400:03d}", ["casa", "flat", "terreno", None][i // 40 % 4],
         ["venda", "aluguel"][i // 160 % 2], ["", "SP", "RJ", None][i // 320 % 4], f"portal{i * 31 % 9}", "x" * 300)
        for i in range(6000)
    ]
    names = "url string, cidade string, bairro string, tipo string, finalidade string, estado string, portal string, raw_json string"
    path = str(tmp_path / "listings")
    write_listings(spark.createDataFrame(rows, names).repartition(3), path, files=12, row_group=1 << 14)
    back = read_listings(spark, path)
    key = lambda r: tuple("" if v is None else "=" + v for v in r)
    assert sorted(map(key, back.select(*[n.split()[0] for n in names.split(", ")]).collect())) == sorted(map(key, rows))
    counts = {tuple(r) for r in back.groupBy("estado").count().collect()}
    assert {s for s, _ in counts} == {"", "SP", "RJ", None}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    read, limits = {}, {}
    try:
        for condition, most in {
            "url = 'https://p/01234'": 0.2, "url = 'https://p/01234x'": 0.05, "portal = 'other'": 0.05, "cidade = 'c07'": 0.6,
            "bairro = 'b007'": 0.6, "estado = 'SP'": 0.3, "estado = ''": 0.3, "tipo = 'flat'": 0.7, "finalidade = 'venda'": 0.9,
            "tipo = 'flat' and finalidade = 'venda' and estado = 'SP'": 0.2,
        }.items():
            read[condition] = scanned_rows(back.where(condition).select("url")) / len(rows)
            limits[condition] = most
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {c: part for c, part in read.items() if part > limits[c]} == {}, read


def test_stamp_keeps_what_is_there(spark):
    df = spark.createDataFrame([("u", "x"), ("v", None)], "url string, data_coleta string")
    assert rows_of(stamp(df, "p", NOW).select("url", "data_coleta", "portal")) == [("u", "x", "p"), ("v", NOW, "p")]


def test_counts(spark):
    df = spark.createDataFrame([("u", "SP", "a"), ("u", "SP", "a"), ("v", "SP", "b")], "url string, uf string, city string")
    assert count_listings(df.withColumn("portal", F.lit("x")), "y").first()["n"] == 0
    got = {(r["uf"], r["city"], r["level"]): r["saved"] for r in saved_totals(df).collect()}
    assert got == {("SP", "a", 0): 2, ("SP", "b", 0): 1, ("SP", None, 1): 3, (None, None, 3): 3}


# --- pages ---


def test_read_pages(spark):
    cases = {
        '{"search":{"result":{"listings":[{}]}}}': "items",
        ' {"search":{"result":{"listings":[null]}}} ': "items",
        '{"search":{"result":{"listings":[]}}}': "empty",
        '{"search":{"result":{"listings":null}}}': "empty",
        '{"search":{}}': "empty", "{}": "empty",
        '{"search":null}': "shape", '{"search":{"result":null}}': "shape", "[]": "shape", "null": "shape",
        '{"search":{"result":{"listings":5}}}': "shape", '{"search":{"result":{"listings":"x"}}}': "shape",
        "<html>": "not JSON", "": "not JSON", '{"search":{"result":{"listings":[{}': "not JSON",
        '{"search":{"result":{"listings":[{}]}}} x': "not JSON", '{"search":{"result":{"listings":[{}]}}},"end"': "not JSON",
        '{"search":{"result":{"listings":[{}]}}},{"end":"end"}': "not JSON",
        '{"search":{"result":{"listings":[{}]}}}],[{}': "not JSON", None: "missing",
    }
    df = spark.createDataFrame([(c, 200) for c in cases], "payload string, status int")
    got = {r.payload: r.reason or r.state for r in read_pages(df).collect()}
    assert got == cases
    assert {r.reason for r in read_pages(df.withColumn("status", F.lit(404))).collect()} == {"status"}
    states = {(r.state, r.reason is None) for r in read_pages(df, status=None).collect()}
    assert states == {("items", True), ("empty", True), ("error", False)}


def page(run, number, *urls, status=200, kind="USED"):
    items = [{"listing": {"link": {"href": u}, "address": {"stateAcronym": "SP"}}} if u else None for u in urls]
    body = json.dumps({"search": {"result": {"listings": items}}})
    return (run, "SP", "c", 0, "n", 0, kind, number, status, body)


@pytest.mark.parametrize("on_fatal,urls", [("quarantine", ["/a", "/b", "/c", "/d"]), ("truncate", ["/a", "/d"])])
def test_broken_item_in_a_walk(spark, on_fatal, urls):
    rows = [page(0, 1, "/a", None, "/b"), page(0, 2, "/c"), page(0, 1, "/d", kind="DEVELOPMENT")]
    good, rejected = parse_pages(spark.createDataFrame(rows, PAGE_CONTEXT), "", "p", NOW, on_fatal)
    assert sorted(r["url"] for r in good.collect()) == urls
    assert [r["outcome"] for r in rejected.collect()] == ["fatal:item"]


def test_rejects_behind_a_fatal_item_do_not_count(spark):
    rows = [page(0, 1, "/a", None, "/b", None), page(0, 2, None), page(0, 3, status=500)]
    pages = spark.createDataFrame(rows, PAGE_CONTEXT)
    _, rejected = parse_pages(pages, "", "p", NOW, "truncate")
    assert [(r.page, r.pos, r.outcome) for r in rejected.collect()] == [(1, 1, "fatal:item")]
    _, rejected = parse_pages(pages, "", "p", NOW)
    assert rows_of(rejected.select("page", "pos", "outcome")) == [
        (1, 1, "fatal:item"), (1, 3, "fatal:item"), (2, 0, "fatal:item"), (3, None, "page:status"),
    ]


def test_unreadable_pages_end_their_walk(spark):
    whole = page(0, 1, "/a")
    behind = (*page(0, 2, "/b")[:-1], page(0, 2, "/b")[-1] + ',"end"')
    cut = (*page(0, 2, "/c", kind="DEVELOPMENT")[:-1], '{"search":{"result":{"listings":[{"listing":')
    later = [page(0, 3, "/d"), page(0, 3, "/e", kind="DEVELOPMENT"), page(0, 1, "/f", kind="DEVELOPMENT")]
    pages = spark.createDataFrame([whole, behind, cut, *later], PAGE_CONTEXT)
    good, rejected = parse_pages(pages, "", "p", NOW)
    assert sorted(r.url for r in good.collect()) == ["/a", "/f"]
    got = sorted((r.listing_type, r.page, r.pos, r.outcome, r.raw_json) for r in rejected.collect())
    assert got == [("DEVELOPMENT", 2, None, "page:not JSON", cut[-1]), ("USED", 2, None, "page:not JSON", behind[-1])]


def test_current_listings_from_two_runs(spark):
    first = spark.createDataFrame([page(0, 1, "/a", "/b"), page(0, 2), page(0, 3, "/c"), page(0, 4), page(0, 5), page(0, 6, "/x")], PAGE_CONTEXT)
    table = current_listings(None, parse_pages(first, "", "p", "t1")[0])
    second = spark.createDataFrame([page(1, 1, "/b"), page(1, 2, "/y", status=500)], PAGE_CONTEXT)
    table = current_listings(table, parse_pages(second, "", "p", "t2")[0])
    assert rows_of(table.select("url", "data_coleta")) == [("/a", "t1"), ("/b", "t2"), ("/c", "t1")]


def test_read_payloads(spark, tmp_path):
    df = spark.createDataFrame([page(0, 1, "/a")], PAGE_CONTEXT)
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "p.json"))
    for name in ("p", "p.json"):
        assert rows_of(read_payloads(spark, str(tmp_path / name))) == rows_of(df)


# --- progress and work lists ---


def test_resume(spark):
    work = spark.createDataFrame([(u, i) for u in "ABCD" for i in range(4)], "uf string, city_idx int")
    stored = spark.createDataFrame([("A", -1), ("C", 2001), ("D", 1)], "estado string, last_page long")
    got = rows_of(worklist.resume(work, stored))
    assert got == [(u, i) for u in "ABCD" for i in range(4) if u in "BD" or (u == "C" and i >= 2)]


def test_next_progress(spark):
    done = spark.createDataFrame([("A", 0, 5), ("A", 1, 5), ("B", 0, 1), ("C", 0, 0), ("C", 1, 1)], "uf string, city_idx int, saved int")
    totals = spark.createDataFrame([("A", 2), ("B", 3), ("C", 2)], "uf string, n_cities int")
    assert rows_of(progress.next_progress(done, totals)) == [("A", -1), ("B", 1001), ("C", -1)]
    assert rows_of(progress.next_progress(done, totals, limit=10)) == [("A", 2001), ("B", 1001), ("C", -1)]


def test_progress_of_cities_done_out_of_order(spark):
    done = spark.createDataFrame([("A", 4, 1), ("B", 0, 1), ("B", 2, 1), ("B", 2, 1)], "uf string, city_idx int, saved int")
    totals = spark.createDataFrame([("A", 5), ("B", 3)], "uf string, n_cities int")
    assert rows_of(progress.next_progress(done, totals)) == [("A", 1), ("B", 1001)]


def test_all_pages_asked_for(spark):
    assert worklist.expand_pages(spark.range(1), 500).count() == 500
    assert worklist.expand_pages(spark.range(1)).count() == 420


def test_columns_of_a_later_batch(spark, tmp_path):
    spark.range(1).selectExpr("'x' as a").write.parquet(str(tmp_path / "batch=0"))
    spark.range(1).selectExpr("'y' as a", "'z' as b").write.parquet(str(tmp_path / "batch=1"))
    rows = read_log(spark, str(tmp_path)).orderBy("batch").collect()
    assert [(r.a, r.b) for r in rows] == [("x", None), ("y", "z")]


def test_progress_table(spark):
    stored = spark.createDataFrame([("SP", 5, "t0"), ("RJ", 6, "t0")], "estado string, last_page long, updated_at string")
    updates = spark.createDataFrame([("SP", 9, 1), ("SP", 7, 2)], "estado string, last_page long, seq int")
    assert rows_of(progress.save_progress(stored, updates, NOW)) == [("RJ", 6, "t0"), ("SP", 7, NOW)]
    assert progress.reset_progress(spark, NOW).where("last_page = 1").count() == 27


def test_generic_progress(spark):
    rows = [(1, 1, False), (1, 2, False), (1, 3, True), (2, 1, True), (3, 3, False)]
    pages = spark.createDataFrame(rows, "w int, page int, empty boolean")
    assert rows_of(progress.generic_progress(pages, ["w"], F.lit(3))) == [(1, 3), (2, 1), (3, -1)]


def test_select_states_and_names(spark):
    assert [r["name"] for r in worklist.select_states(spark, "sp").collect()] == ["São Paulo"]
    assert worklist.select_states(spark, all_states=True).count() == 27
    assert worklist.select_states(spark).count() == 0
    df = spark.createDataFrame([("sp",), ("zz",)], "uf string")
    assert rows_of(discovery.with_state_name(df)) == [("sp", "São Paulo"), ("zz", "zz")]


def test_worklist(spark):
    cities = spark.createDataFrame([("SP", "a", 0), ("SP", "b", 1)], "uf string, city string, city_idx int")
    near = spark.createDataFrame([("SP", "a", "x", 0)], "uf string, city string, neighbourhood string, neighbourhood_pos int")
    got = worklist.expand_worklist(cities, near)
    assert got.count() == 6 and "Cartesian" not in plan_of(got) and "NestedLoop" not in plan_of(got)
    assert worklist.expand_pages(got, 999).groupBy("city", "neighbourhood", "listing_type").count().first()["count"] == 999
    assert worklist.expand_pages(got, 0).count() == 0
    assert worklist.expand_terms(cities).count() == 76


def test_empty_look_up_is_not_repeated(spark):
    wanted = spark.createDataFrame([("SP", "a"), ("SP", "b")], "uf string, city string")
    looked_up = spark.createDataFrame([("SP", "a")], "uf string, city string")
    assert rows_of(discovery.pending(wanted, looked_up, ["uf", "city"])) == [("SP", "b")]


def test_city_index_keeps_repeated_names(spark):
    names = ["b"] * 500 + ["a", "c", "á", "a"]
    listed = spark.createDataFrame([("SP", n) for n in names] + [("RJ", "x")], "uf string, city string")
    got = rows_of(discovery.city_index(listed.repartition(5)))
    assert got == sorted([("SP", n, i) for i, n in enumerate(sorted(names))] + [("RJ", "x", 0)])
    totals = {(r["uf"], r["n_cities"], r["n_states"]) for r in discovery.city_counts(listed).collect()}
    assert totals == {("SP", 504, 1), ("RJ", 1, 1), (None, 505, 2)}


def test_capital_fallback(spark):
    wanted = spark.createDataFrame([("AC",), ("SP",), ("XX",)], "uf string")
    cities = spark.createDataFrame([("SP", "Campinas", 0), ("RJ", "Niterói", 0)], "uf string, city string, city_idx int")
    assert rows_of(discovery.with_capital_fallback(wanted, cities)) == [("AC", "Rio Branco", 0), ("SP", "Campinas", 0)]


# --- incremental runs ---


def test_incremental_runs(spark, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))

    def parse(batch):
        return parse_pages(batch, "", "p", NOW)[0]

    def land(*pages):
        spark.createDataFrame(list(pages), PAGE_CONTEXT).write.mode("append").parquet(source)

    land(page(0, 1, "/a", "/b"))
    ingest_incremental(spark, source, log, state, parse, PAGE_CONTEXT)
    ingest_incremental(spark, source, log, state, parse, PAGE_CONTEXT)
    assert read_log(spark, log).count() == 2
    land(page(1, 1, "/b", "/c"))
    ingest_incremental(spark, source, log, state, parse, PAGE_CONTEXT)
    rows = read_log(spark, log)
    assert rows.count() == 4
    newest = current(None, rows)
    assert rows_of(newest.select("url", "batch")) == [("/a", 0), ("/b", 1), ("/c", 1)]
    # Folding batch 0 into a snapshot first gives the same table.
    snapshot = current(None, rows.where("batch = 0"))
    later = current(snapshot, read_log(spark, log, after_batch=0))
    assert rows_of(later.select("url", "batch")) == rows_of(newest.select("url", "batch"))


def test_walks_across_batches(spark, tmp_path):
    """One batch or many give the same rows, and nothing of the input is lost."""
    pages = [page(0, 1, "/a", None), page(0, 2), page(0, 3, "/b"), page(0, 4), page(0, 5), page(0, 6, "/no")]
    pages += [page(0, 1, "/c", kind="DEVELOPMENT"), page(0, 2, status=500, kind="DEVELOPMENT"), page(0, 3, "/no", kind="DEVELOPMENT")]
    found = []
    for name, size in (("many", 1), ("one", len(pages))):
        source, log, state = (str(tmp_path / f"{n}-{name}") for n in ("in", "log", "state"))
        for at in range(0, len(pages), size):
            spark.createDataFrame(pages[at : at + size], PAGE_CONTEXT).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            ingest_pages(spark, source, log, state, "", "p", NOW, max_files=1 if size == 1 else None)
        rows = read_log(spark, log)
        parts = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}
        assert parts == {"good": 5, "rejected": 1, "page": 4}
        assert rows.select("batch").distinct().count() == len(pages) / size
        good, rejected = split_outcomes(counted(rows))
        found.append((rows_of(good.select("url", "page", "portal")), rows_of(rejected.select("page", "pos", "outcome"))))
    assert found[0] == found[1]
    assert [r[0] for r in found[0][0]] == ["/a", "/b", "/c"]
    assert found[0][1] == [(1, 1, "fatal:item"), (2, None, "page:status")]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    spark.createDataFrame([page(0, 1, "/a", None), page(0, 2, status=500)], PAGE_CONTEXT).write.parquet(source)
    for attempt in range(2):  # a new checkpoint forgets that batch 0 was written
        ingest_pages(spark, source, log, str(tmp_path / f"state{attempt}"), "", "p", NOW)
        assert rows_of(read_log(spark, log).select("batch", "part")) == [(0, "good"), (0, "page"), (0, "rejected")]


def test_one_file_of_pages_is_parsed_by_many_tasks(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    pages = [page(0, number, f"/{number}") for number in range(400)]
    spark.createDataFrame(pages, PAGE_CONTEXT).coalesce(1).write.parquet(source)
    ingest_pages(spark, source, log, str(tmp_path / "state"), "", "p", NOW)
    rows = read_log(spark, log)
    assert rows.count() == 400 and len(rows.inputFiles()) >= spark.sparkContext.defaultParallelism


# --- progress per city ---


def test_ranges_of_finished_cities(spark):
    empty = spark.createDataFrame([], CITY_PROGRESS)
    done = lambda *c: spark.createDataFrame(list(c), "uf string, city_idx int")
    first = progress.save_cities(empty, done(("SP", 0), ("SP", 2), ("SP", 1), ("SP", 7), ("SP", 7), ("RJ", 3), ("RJ", None)), "t1")
    assert rows_of(first) == [("RJ", 3, 3, "t1"), ("SP", 0, 2, "t1"), ("SP", 7, 7, "t1")]
    # A run for one city joins two ranges; the other state is as it was.
    second = progress.save_cities(first, done(("SP", 4), ("SP", 5), ("SP", 6), ("SP", 1)), "t2")
    assert rows_of(second) == [("RJ", 3, 3, "t1"), ("SP", 0, 2, "t1"), ("SP", 4, 7, "t2")]
    third = progress.save_cities(second, done(("SP", 3)), "t3")
    assert rows_of(third) == [("RJ", 3, 3, "t1"), ("SP", 0, 7, "t3")]
    assert rows_of(progress.save_cities(third, done(), "t4")) == rows_of(third)
    totals = spark.createDataFrame([("SP", 8), ("RJ", 4), ("AC", 2)], "uf string, n_cities int")
    assert rows_of(progress.state_progress(third, totals)) == [("AC", 1), ("RJ", 1), ("SP", -1)]
    assert rows_of(progress.state_progress(second, totals)) == [("AC", 1), ("RJ", 1), ("SP", 3001)]
    work = spark.createDataFrame([("SP", str(i), i) for i in range(8)] + [("SP", "?", None), ("RJ", "3", 3)], "uf string, city string, city_idx int")
    left = worklist.resume_cities(work, second)
    assert sorted(r.city for r in left.collect()) == ["3", "?"] and "NestedLoop" not in plan_of(left)


def test_one_city(spark):
    cities = spark.createDataFrame([("SP", "Campinas", 4), ("RJ", "Campinas", 1)], "uf string, city string, city_idx int")
    assert rows_of(worklist.select_city(cities, "sp", "CAMPINAS")) == [("SP", "Campinas", 4)]
    assert rows_of(worklist.select_city(cities, "SP", "Nenhuma")) == [("SP", "Nenhuma", None)]
    assert rows_of(worklist.select_city(cities, "XX", "Campinas")) == []


def test_outcome_totals(spark):
    rows = [(0, "SP", "a", "u", None), (0, "SP", "a", None, None), (0, "SP", "b", "u", "reject:price"), (0, None, None, "u", None),
            (1, "SP", "a", None, "page:empty"), (1, "SP", "a", None, "page:not JSON")]
    df = spark.createDataFrame(rows, "run int, uf string, city string, url string, outcome string")
    got = {(r.run, r.uf, r.city, r.level): (r.saved, r.refused, r.failed_pages, r.empty_pages, r.errors) for r in outcome_totals(df).collect()}
    assert got[0, "SP", "a", 0] == (1, 1, 0, 0, 1) and got[0, "SP", None, 1] == (1, 2, 0, 0, 2)
    assert got[0, None, None, 0] == got[0, None, None, 1] == (1, 0, 0, 0, 0)
    assert got[0, None, None, 3] == (2, 2, 0, 0, 2) and got[1, None, None, 3] == (0, 0, 1, 1, 1)
    assert got[None, None, None, 7] == (2, 2, 1, 1, 3) and len(got) == 10


# --- versions ---


def test_an_update_opens_only_what_it_touches(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    names = "url string, estado string, cidade string, preco double, portal string"
    first = [(f"u{k}", ["SP", "RJ", "", None, "A/B %20"][k % 5], "c", float(k), "p") for k in range(50)]
    order = [F.col("preco")]
    assert table_versions.update_listings(spark, root, spark.createDataFrame(first, names), order) == 0
    opened = []
    own = table_versions._open
    monkeypatch.setattr(table_versions, "_open", lambda s, r, folders: opened.append(list(folders)) or own(s, r, folders))
    # One address of RJ changes, one of SP moves to the empty state, one is new, one is refused.
    second = [("u1", "RJ", "c", 101.0, "p"), ("u1", "RJ", "c", 100.0, "p"), ("u5", "", "c", 105.0, "p"), ("new", "SP", "c", 1.0, "p"), (None, "AC", "c", 1.0, "p")]
    assert table_versions.update_listings(spark, root, spark.createDataFrame(second, names), order) == 1
    assert opened[1] == ["v=0/estado=RJ", "v=0/estado=SP"]  # whole rows; the first look reads addresses only
    want = {r[0]: r[1:4] for r in first} | {"u1": ("RJ", "c", 101.0), "u5": ("", "c", 105.0), "new": ("SP", "c", 1.0)}
    got = table_versions.read_version(spark, root)
    assert got.columns == LISTINGS.fieldNames()
    assert {r.url: (r.estado, r.cidade, r.preco) for r in got.collect()} == want and got.count() == len(want)
    _, folders = table_versions._manifest(spark, root, None)
    assert sum(f.startswith("v=0/") for f in folders) == 3 and {f for f in folders if f.startswith("v=1/")} == {
        "v=1/estado=RJ", "v=1/estado=SP", "v=1/estado=(none)",
    }
    before = table_versions.read_version(spark, root, 0)
    assert {r.url: (r.estado, r.cidade, r.preco) for r in before.collect()} == {r[0]: r[1:4] for r in first}
    plan = plan_of(own(spark, root, folders).select("url", "_metadata.file_path"))
    assert "raw_json" not in plan and "cidade" not in plan
    with pytest.raises(ValueError):
        table_versions.read_version(spark, root, 9)
