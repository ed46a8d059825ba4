"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_REPEATS the timed
runs after a warm-up; the median counts. Every query runs over whole tables and
its result is counted through a sink that reads every row and column.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import workload
from listingflow.operators.parse import parse_listings
from listingflow.operators.upsert import latest
from listingflow.session import build_session, ensure_shared_dir
from listingflow.sources.pages import extract_pages, read_pages
from workload.fixtures import BASE_URL, arr, js, num, obj, uf_of
from workload.registry import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

REGISTERED = [
    "listings_per_state", "L26_rejects", "S1_explode_listings", "U1_upsert", "U2_write_order",
    "W1_listing_walk", "W1_walked_pages", "W3_limit_groups", "W5_city_index", "G2_saved_totals",
    "G4_neighbourhoods", "C1_clean_price", "C4_parse_date", "H4_photos", "H5_page_dates",
    "X2_sitemap_listing_urls", "X3_filter_urls", "J3_worklist", "S10_pending", "P2_save_progress",
    "T1_incremental_ingest",
]


def line_items(spark: SparkSession) -> DataFrame:
    """One ordinary listing item per line item, with no odd shapes in it.

    The table is one row group, so one task; landed payloads are many files.
    """
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    item = obj(
        listing=obj(
            id=js(key), title=js("Apartamento"), description=js(F.repeat(F.col("l_returnflag"), 200)),
            status=js("ACTIVE"), createdAt=js(F.date_format("l_shipdate", "yyyy-MM-dd")),
            link=obj(href=js(F.concat(F.lit("/imovel/"), key, F.lit("/")))),
            address=obj(
                city=js(F.concat(F.lit("Cidade "), F.col("l_suppkey"))), stateAcronym=js(uf_of(F.col("l_partkey"))),
                point=obj(lat=num(-F.col("l_quantity")), lon=num(-F.col("l_quantity") - 1)),
            ),
            pricingInfos=arr(obj(businessType=js("SALE"), price=js(num(F.col("l_extendedprice"))))),
            usableAreas=arr(js(num(F.col("l_quantity")))), bedrooms=arr(num(F.col("l_linenumber"))),
            unitTypes=arr(js("APARTMENT")), amenities=arr(js("POOL"), js("GYM")), acceptExchange=F.lit("false"),
            advertiserContact=obj(name=js("Contact")),
        ),
        medias=arr(*(obj(url=js(F.concat(F.lit(f"https://img.example/{i}/"), key))) for i in range(4))),
        account=obj(name=js("Agency")),
    )
    lines = table(spark, SF_DIR, "lineitem").repartition(int(CPUS))
    return lines.select(F.col("l_suppkey").alias("run"), item.alias("item"))


def parse_line_items(spark: SparkSession, _: str) -> DataFrame:
    return parse_listings(line_items(spark), BASE_URL)[0]


def parse_and_upsert(spark: SparkSession, _: str) -> DataFrame:
    good = parse_listings(line_items(spark), BASE_URL)[0]
    return latest(good, "url", [F.col("run"), F.col("preco")])


def upsert_by_max(spark: SparkSession, _: str) -> DataFrame:
    """The other way to keep the last version of each key, for comparison."""
    lines = table(spark, SF_DIR, "lineitem")
    newest = F.max_by(F.struct(*lines.columns), F.struct("l_shipdate", "l_partkey", "l_suppkey"))
    return lines.groupBy("l_orderkey", "l_linenumber").agg(newest.alias("v")).select("v.*")


def upsert_by_rank(spark: SparkSession, _: str) -> DataFrame:
    order = [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey")]
    return latest(table(spark, SF_DIR, "lineitem"), ["l_orderkey", "l_linenumber"], order)


def extract_all_pages(spark: SparkSession, _: str) -> DataFrame:
    found = extract_pages(read_pages(spark, f"{SF_DIR}/pages.parquet"))
    return found.withColumns({n: F.to_json(n) for n in ("json_ld", "next_data", "initial_state")})


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    runs = {name: workload.QUERIES[name] for name in REGISTERED}
    for extra in (parse_line_items, parse_and_upsert, upsert_by_rank, upsert_by_max, extract_all_pages):
        runs[extra.__name__] = extra
    seconds = {}
    for name, run in runs.items():
        times = []
        for _ in range(REPEATS + 1):
            begun = time.perf_counter()
            run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:]), 4)
    n_items = table(spark, SF_DIR, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "parsed_items_per_sec": round(n_items / seconds["parse_line_items"]),
            }
        )
    )


if __name__ == "__main__":
    main()
