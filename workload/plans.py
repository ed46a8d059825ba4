"""Discovery, work lists, stop rules, limits, positions and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.dims import DISCOVERY_TERMS, STATES
from listingflow.functions.variants import truthy
from listingflow.operators import discovery, progress, rules
from listingflow.operators.positions import with_position
from listingflow.plans import worklist
from listingflow.schema import CITY_PROGRESS
from listingflow.sources.payloads import explode_locations, explode_municipalities
from workload.fixtures import NOW, arr, js, num, obj, uf_of, uf_sql
from workload.registry import query, table

# Cities of a state in these queries: customers of a nation by the last digits of their key.
CITIES = 20


def city_of(key: Column) -> Column:
    return F.concat(F.lit("Cidade "), key % CITIES)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumns(
        {"uf": uf_of(F.col("c_nationkey")), "city": city_of(F.col("c_custkey"))}
    )


CUSTOMERS_SQL = f"""(SELECT *, {uf_sql("c_nationkey")} AS uf, 'Cidade ' || c_custkey % {CITIES} AS city
    FROM customer)"""
CITIES_SQL = f"""(SELECT uf, city, row_number() OVER (PARTITION BY uf ORDER BY city) - 1 AS city_idx
    FROM (SELECT DISTINCT uf, city FROM {CUSTOMERS_SQL}))"""


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.city_index(customers(spark, sf_dir).select("uf", "city").distinct())


# --- S2, S3, F1, F2, G4, G5, D2, W5, O1: discovery ---------------------------


def location_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per customer: a place in the city, one elsewhere, one without a name."""
    segment, k = F.col("c_mktsegment"), F.col("c_custkey")

    def place(**address: Column | None) -> Column:
        return obj(address=obj(**address))

    found = arr(
        place(neighborhood=js(F.concat(segment, F.lit(" "), k % 7)), city=js(F.upper("city"))),
        place(neighborhood=js(segment), city=js("Outra")),
        place(neighborhood=js(""), city=js(F.col("city"))),
        place(city=js(F.col("city"))),
        place(neighborhood=js(segment)),
        F.lit("{}"),
    )
    body = F.when(k % 10 == 8, F.lit('{"neighborhood":{"result":{}}}')).otherwise(
        obj(neighborhood=obj(result=obj(locations=found)))
    )
    status = F.when(k % 10 == 9, 404).otherwise(200)
    return customers(spark, sf_dir).select(
        "c_custkey", "uf", "city", status.alias("status"), body.alias("payload")
    )


MATCHED_SQL = f"""(SELECT c_custkey, uf, city, c_mktsegment || ' ' || c_custkey % 7 AS neighbourhood
    FROM {CUSTOMERS_SQL} WHERE c_custkey % 10 < 8)"""


@query(
    "S2_explode_locations",
    f"""SELECT c_custkey, i, CASE i WHEN 0 THEN c_mktsegment || ' ' || c_custkey % 7 WHEN 2 THEN ''
        WHEN 1 THEN c_mktsegment WHEN 4 THEN c_mktsegment END AS neighbourhood,
        CASE i WHEN 0 THEN upper(city) WHEN 1 THEN 'Outra' WHEN 2 THEN city WHEN 3 THEN city ELSE '' END AS n_city
    FROM (SELECT *, unnest(range(6)) AS i FROM {CUSTOMERS_SQL}) WHERE c_custkey % 10 < 8""",
)
def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = explode_locations(location_payloads(spark, sf_dir))
    name, place, city = F.col("neighbourhood"), F.col("n_city"), F.col("city")
    i = (
        F.when(place == F.upper(city), 0).when(place == "Outra", 1).when(name == "", 2)
        .when(place == city, 3).when(name.isNotNull(), 4).otherwise(5)
    )
    return found.select("c_custkey", i.cast("bigint").alias("i"), "neighbourhood", "n_city")


@query("F1_match_city", f"SELECT * FROM {MATCHED_SQL}")
def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discovery.match_city(explode_locations(location_payloads(spark, sf_dir)))
    return found.select("c_custkey", "uf", "city", "neighbourhood")


@query("D2_distinct_results", f"SELECT DISTINCT uf, city, neighbourhood FROM {MATCHED_SQL}")
def distinct_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of all queries for a city, put together without repeats."""
    found = discovery.match_city(explode_locations(location_payloads(spark, sf_dir)))
    halves = [found.where(F.col("c_custkey") % 2 == i) for i in (0, 1)]
    return halves[0].unionByName(halves[1]).select("uf", "city", "neighbourhood").distinct()


@query(
    "G4_neighbourhoods",
    f"""SELECT *, CAST(row_number() OVER (PARTITION BY uf, city ORDER BY neighbourhood) - 1 AS INTEGER)
        AS neighbourhood_pos FROM (SELECT DISTINCT uf, city, neighbourhood FROM {MATCHED_SQL})""",
)
def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discovery.match_city(explode_locations(location_payloads(spark, sf_dir)))
    return discovery.distinct_neighbourhoods(found)


def municipality_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per customer with two names, an empty one and one without."""
    k = F.col("c_custkey")
    names = arr(
        obj(nome=js(F.col("c_name"))), obj(nome=js("")), F.lit('{"id":7}'),
        obj(nome=js(F.concat(F.lit("Ávila "), num(k)))),
    )
    return customers(spark, sf_dir).select(
        "uf", F.when(k % 9 == 0, 500).otherwise(200).alias("status"), names.alias("payload")
    )


MUNICIPALITIES_SQL = f"""(SELECT uf, unnest([c_name, 'Ávila ' || c_custkey]) AS city
    FROM {CUSTOMERS_SQL} WHERE c_custkey % 9 <> 0)"""


@query("S3_municipalities", f"SELECT * FROM {MUNICIPALITIES_SQL}")
def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_municipalities(municipality_payloads(spark, sf_dir))


@query(
    "W5_city_index",
    f"""SELECT uf, city, CAST(row_number() OVER (PARTITION BY uf ORDER BY city) - 1 AS INTEGER) AS city_idx
    FROM {MUNICIPALITIES_SQL}""",
)
def city_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.city_index(explode_municipalities(municipality_payloads(spark, sf_dir)))


@query(
    "O1_sorted_cities",
    "SELECT c_name AS city, row_number() OVER (ORDER BY c_name) AS place FROM customer",
)
def sorted_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ascending order over the whole table, as a position per row."""
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("city"))
    return with_position(names, [], ["city"], "place", start=1)


@query(
    "G5_city_counts",
    f"""SELECT uf, CAST(count(*) AS BIGINT) AS n_cities, CAST(count(DISTINCT uf) AS BIGINT) AS n_states,
        CAST(grouping(uf) AS BIGINT) AS level
    FROM {MUNICIPALITIES_SQL} GROUP BY ROLLUP (uf)""",
)
def city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.city_counts(explode_municipalities(municipality_payloads(spark, sf_dir)))


@query(
    "F2_truthy",
    """SELECT p_partkey, p_partkey % 8 IN (1, 3, 5, 7) AS given FROM part""",
)
def truthiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = ["0", '"0"', '""', "[0]", "null", '{"a":null}', "{}", "-1.5"]
    text = F.get(F.array(*(F.lit(s) for s in shapes)), (F.col("p_partkey") % 8).cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", truthy(F.parse_json(text)).alias("given")
    )


# --- S10, D4, J1, J2, J7: look-ups -------------------------------------------


@query(
    "S10_pending",
    """SELECT c_custkey, c_nationkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 3 = c_nationkey % 3)""",
)
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), (F.col("o_custkey") % 3).alias("part")
    )
    wanted = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_nationkey") % 3).alias("part")
    )
    keyed = discovery.pending(wanted.withColumn("part", F.col("part").cast("bigint")), done, ["c_custkey", "part"])
    return keyed.select("c_custkey", "c_nationkey")


@query(
    "D4_difference",
    """SELECT c_custkey FROM customer EXCEPT
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -o_custkey END FROM orders""",
)
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order; the key of any other order fits none."""
    key = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).otherwise(-F.col("o_custkey"))
    done = table(spark, sf_dir, "orders").select(key.alias("c_custkey"))
    return discovery.pending(table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


STATES_SQL = "(VALUES " + ", ".join(f"('{u}', '{n}', '{c}')" for u, n, c, _ in STATES) + ") s(code, name, capital)"


@query(
    "J1_state_name",
    f"""SELECT c_custkey, w.uf, coalesce(name, w.uf) AS state_name FROM (SELECT c_custkey,
        CASE WHEN c_custkey % 30 < 27 THEN lower({uf_sql("c_custkey % 30")}) ELSE 'x' || c_custkey % 30 END AS uf
        FROM customer) w LEFT JOIN {STATES_SQL} ON upper(w.uf) = code""",
)
def state_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 30
    uf = F.when(k < 27, F.lower(uf_of(k))).otherwise(F.concat(F.lit("x"), k))
    return discovery.with_state_name(table(spark, sf_dir, "customer").select("c_custkey", uf.alias("uf")))


@query(
    "J2_capital_fallback",
    f"""SELECT w.uf, city, CAST(city_idx AS INTEGER) AS city_idx
    FROM (SELECT DISTINCT {uf_sql("s_suppkey")} AS uf FROM supplier) w JOIN {CITIES_SQL} c USING (uf)
    UNION ALL SELECT w.uf, capital, 0 FROM (SELECT DISTINCT {uf_sql("s_suppkey")} AS uf FROM supplier) w
    JOIN {STATES_SQL} ON w.uf = code WHERE w.uf NOT IN (SELECT uf FROM {CITIES_SQL})""",
)
def capital_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work for the states of all suppliers and an unknown one; two states have no customers."""
    known = table(spark, sf_dir, "supplier").select(uf_of(F.col("s_suppkey")).alias("uf"))
    unknown = table(spark, sf_dir, "supplier").select(F.concat(F.lit("X"), "s_nationkey").alias("uf"))
    return discovery.with_capital_fallback(known.union(unknown), cities(spark, sf_dir))


@query(
    "J7_already_done",
    f"""SELECT uf, city, CAST(city_idx AS INTEGER) AS city_idx FROM {CITIES_SQL}
    WHERE (uf, city) NOT IN (SELECT ({uf_sql("s_nationkey")}, 'Cidade ' || s_suppkey % {CITIES}) FROM supplier)""",
)
def already_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "supplier").select(
        uf_of(F.col("s_nationkey")).alias("uf"), city_of(F.col("s_suppkey")).alias("city")
    )
    return discovery.pending(cities(spark, sf_dir), done, ["uf", "city"])


# --- F4, F5, J3, J4, J5: work lists ------------------------------------------


@query(
    "F4_resume",
    f"""SELECT uf, city, CAST(city_idx AS INTEGER) AS city_idx FROM {CITIES_SQL} c
    LEFT JOIN (SELECT {uf_sql("n_nationkey")} AS uf, n_nationkey AS n FROM nation) USING (uf)
    WHERE n % 4 <> 0 AND city_idx >= CASE n % 4 WHEN 2 THEN 2 WHEN 3 THEN 5 ELSE 0 END""",
)
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    stored = table(spark, sf_dir, "nation").select(
        uf_of(F.col("n_nationkey")).alias("estado"),
        F.when(k == 0, -1).when(k == 2, 2001).when(k == 3, 5999).cast("bigint").alias("last_page"),
    )
    return worklist.resume(cities(spark, sf_dir), stored.where("last_page IS NOT NULL"))


@query(
    "F5_select_states",
    f"""SELECT 'one' AS wanted, c_custkey FROM {CUSTOMERS_SQL} WHERE uf = 'AM'
    UNION ALL SELECT 'all', c_custkey FROM {CUSTOMERS_SQL}""",
)
def selected_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = customers(spark, sf_dir).select("uf", "c_custkey")
    choices = {
        "one": worklist.select_states(spark, "am"),
        "all": worklist.select_states(spark, "am", all_states=True),
        "none": worklist.select_states(spark),
    }
    parts = [
        work.join(F.broadcast(chosen.select("uf")), "uf").select(F.lit(name).alias("wanted"), "c_custkey")
        for name, chosen in choices.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "J3_worklist",
    f"""WITH named AS (SELECT *, row_number() OVER (PARTITION BY uf, city ORDER BY neighbourhood) - 1 AS pos
        FROM (SELECT DISTINCT uf, city, neighbourhood FROM {MATCHED_SQL})),
    walks AS (SELECT uf, city, neighbourhood, pos FROM named UNION ALL SELECT uf, city, '', NULL FROM {CITIES_SQL})
    SELECT uf, city, CAST(city_idx AS INTEGER) AS city_idx, neighbourhood, CAST(pos AS INTEGER) AS neighbourhood_pos,
        unnest(['USED', 'DEVELOPMENT']) AS listing_type FROM walks JOIN {CITIES_SQL} USING (uf, city)""",
)
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.expand_worklist(cities(spark, sf_dir), neighbourhoods(spark, sf_dir))


@query(
    "J4_pages",
    """SELECT c_custkey, CAST(page AS INTEGER) AS page, CAST((page - 1) * 24 AS INTEGER) AS "offset"
    FROM (SELECT c_custkey, unnest(range(1, c_custkey % 501 + 1)) AS page FROM customer)""",
)
def pages_of_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    walks = table(spark, sf_dir, "customer").select("c_custkey")
    return worklist.expand_pages(walks, F.col("c_custkey") % 501)


TERMS_SQL = "[" + ", ".join(f"'{term}'" for term in DISCOVERY_TERMS) + "]"


@query(
    "J5_query_terms",
    f"""SELECT *, term || ' ' || city AS query FROM (SELECT uf, city, unnest({TERMS_SQL}) AS term
        FROM {MUNICIPALITIES_SQL})""",
)
def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.expand_terms(explode_municipalities(municipality_payloads(spark, sf_dir)))


# --- W: stop rules and limits ------------------------------------------------


def stop_rule_sql(k: int) -> str:
    return f"""
    WITH runs AS (SELECT user_id, event_id, event_type, sum(CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS empties FROM events),
    stops AS (SELECT user_id, min(event_id) AS stop FROM runs WHERE empties = {k} GROUP BY user_id)
    SELECT user_id, event_id FROM runs LEFT JOIN stops USING (user_id)
    WHERE event_type NOT IN ('error', 'view') AND (stop IS NULL OR event_id < stop)"""


def stopped_walks(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    pages = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("event_type").isin("error", "view").alias("empty")
    )
    return rules.truncate_after_empty(pages, ["user_id"], k, page="event_id").select("user_id", "event_id")


@query("W1_listing_walk", stop_rule_sql(rules.LISTING_WALK_EMPTIES))
def listing_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stopped_walks(spark, sf_dir, rules.LISTING_WALK_EMPTIES)


@query("W1_generic_walk", stop_rule_sql(rules.GENERIC_WALK_EMPTIES))
def generic_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stopped_walks(spark, sf_dir, rules.GENERIC_WALK_EMPTIES)


ARRIVAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ARRIVAL_SQL = ", ".join(ARRIVAL)


@query(
    "W2_limit_rows",
    f"SELECT {ARRIVAL_SQL} FROM lineitem ORDER BY {ARRIVAL_SQL} LIMIT 100",
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.limit_rows(table(spark, sf_dir, "lineitem").select(*ARRIVAL), 100, ARRIVAL)


@query(
    "W2_limit_rows_per_state",
    f"""SELECT l_returnflag, {ARRIVAL_SQL} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {ARRIVAL_SQL}) <= 50""",
)
def first_rows_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", *ARRIVAL)
    return rules.limit_rows(rows, 50, ARRIVAL, by=["l_returnflag"])


@query(
    "W2_long_limit_per_state",
    f"""SELECT l_returnflag, {ARRIVAL_SQL} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {ARRIVAL_SQL}) <= 5000""",
)
def many_rows_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", *ARRIVAL)
    return rules.limit_rows(rows, 5000, ARRIVAL, by=["l_returnflag"])


SAVED_SQL = f"""(SELECT uf, c_custkey % {CITIES} AS city_idx, count(*) AS saved
    FROM orders JOIN {CUSTOMERS_SQL} ON o_custkey = c_custkey GROUP BY ALL)"""


def saved_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = customers(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), "uf", (F.col("c_custkey") % CITIES).alias("city_idx")
    )
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    return orders.join(owners, "o_custkey").groupBy("uf", "city_idx").agg(F.count("*").alias("saved"))


@query(
    "W3_limit_groups",
    f"""SELECT uf, city_idx, saved FROM (SELECT *, coalesce(sum(saved) OVER (PARTITION BY uf ORDER BY city_idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM {SAVED_SQL}) WHERE before < 200""",
)
def whole_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.limit_groups(saved_per_city(spark, sf_dir), 200)


@query(
    "W4_page_budget",
    """SELECT c_custkey, least(c_custkey % 90, c_custkey % 4 + (c_custkey % 700) // 20 + 1) AS limited,
        c_custkey % 90 AS unlimited FROM customer WHERE c_custkey % 700 > 0
    UNION ALL SELECT c_custkey, c_custkey % 90, c_custkey % 90 FROM customer WHERE c_custkey % 700 = 0""",
)
def page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        rules.last_page(k % 90, k % 4, k % 700).alias("limited"),
        rules.last_page(k % 90, k % 4).alias("unlimited"),
    )


# --- P: progress -------------------------------------------------------------


def stored_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of every third state, as stored progress."""
    orders = table(spark, sf_dir, "orders").select(
        uf_of(F.col("o_orderkey") % 9 * 3).alias("estado"), "o_orderkey"
    )
    return orders.groupBy("estado").agg(
        F.max("o_orderkey").alias("last_page"), F.lit("2024-01-01T00:00:00").alias("updated_at")
    )


STORED_SQL = f"""(SELECT {uf_sql("o_orderkey % 9 * 3")} AS estado, max(o_orderkey) AS last_page,
    '2024-01-01T00:00:00' AS updated_at FROM orders GROUP BY ALL)"""


@query(
    "P1_get_progress",
    f"""SELECT c_custkey, uf, coalesce(last_page, 1) AS last_page FROM {CUSTOMERS_SQL}
    LEFT JOIN {STORED_SQL} ON uf = estado""",
)
def get_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = customers(spark, sf_dir).select("c_custkey", "uf")
    return progress.get_progress(wanted, stored_progress(spark, sf_dir))


@query(
    "P2_save_progress",
    f"""WITH updates AS (SELECT {uf_sql("o_custkey % 20")} AS estado, arg_max(o_custkey, o_orderkey) AS last_page
        FROM orders GROUP BY ALL)
    SELECT estado, last_page, '{NOW}' AS updated_at FROM updates
    UNION ALL SELECT * FROM {STORED_SQL} WHERE estado NOT IN (SELECT estado FROM updates)""",
)
def save_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many updates per state; states past the 20th get none and keep what is stored."""
    updates = (
        table(spark, sf_dir, "orders")
        .select(
            uf_of(F.col("o_custkey") % 20).alias("estado"),
            F.col("o_custkey").alias("last_page"),
            F.col("o_orderkey").alias("seq"),
        )
    )
    return progress.save_progress(stored_progress(spark, sf_dir), updates, NOW)


@query(
    "P3_next_progress",
    f"""WITH done AS (SELECT uf, city_idx + CAST(city_idx >= ascii(uf) % 13 AS INTEGER) AS city_idx, saved FROM {SAVED_SQL}),
    states AS (SELECT uf, sum(saved) >= 650 AS at_limit, list(city_idx) AS cities FROM done GROUP BY uf),
    gaps AS (SELECT *, list_min(list_filter(range(0, {CITIES} + 2), lambda i: NOT list_contains(cities, i))) AS gap FROM states)
    SELECT uf AS estado, CASE WHEN gap >= {CITIES} + ascii(uf) % 2 AND NOT at_limit THEN -1 ELSE gap * 1000 + 1 END AS last_page
    FROM gaps""",
)
def next_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cities are done but one in most states, which have one more or not."""
    left_out = F.ascii("uf") % 13
    done = saved_per_city(spark, sf_dir)
    done = done.withColumn("city_idx", F.col("city_idx") + (F.col("city_idx") >= left_out).cast("int"))
    totals = customers(spark, sf_dir).groupBy("uf").agg((F.lit(CITIES) + F.ascii("uf") % 2).alias("n_cities"))
    return progress.next_progress(done, totals, limit=650)


# Cities finished in two runs: the first did those of the suppliers, in whatever order
# they came, the second some in the middle; several states have gaps.
FIRST_RUN_SQL = f"""(SELECT DISTINCT {uf_sql("s_nationkey")} AS uf, s_suppkey % {CITIES} AS city_idx FROM supplier)"""
SECOND_RUN_SQL = f"""(SELECT DISTINCT {uf_sql("c_nationkey")} AS uf, c_custkey % 7 + 5 AS city_idx FROM customer
    WHERE c_custkey % 3 = 0)"""
RANGES_SQL = """(SELECT uf, min(city_idx) AS first_city, max(city_idx) AS last_city, bool_or(fresh) AS grown FROM (
    SELECT *, city_idx - row_number() OVER (PARTITION BY uf ORDER BY city_idx) AS island FROM (
        SELECT uf, city_idx, bool_and(run = 2) AS fresh FROM (SELECT *, 1 AS run FROM {first}
        UNION ALL SELECT *, 2 AS run FROM {second}) GROUP BY uf, city_idx)) GROUP BY uf, island)"""
BOTH_RANGES_SQL = RANGES_SQL.format(first=FIRST_RUN_SQL, second=SECOND_RUN_SQL)


def finished_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of finished cities after both runs."""
    first = table(spark, sf_dir, "supplier").select(
        uf_of(F.col("s_nationkey")).alias("uf"), (F.col("s_suppkey") % CITIES).alias("city_idx")
    )
    second = customers(spark, sf_dir).where("c_custkey % 3 = 0")
    second = second.select("uf", (F.col("c_custkey") % 7 + 5).alias("city_idx"))
    ranges = spark.createDataFrame([], CITY_PROGRESS)
    for done, now in ((first, "2024-01-01T00:00:00"), (second, NOW)):
        ranges = progress.save_cities(ranges, done, now)
    return ranges


# A run that adds cities to a range marks it as its own; else the first run's mark stays.
@query(
    "P2_city_ranges",
    f"""SELECT uf AS estado, CAST(first_city AS INTEGER) AS first_city, CAST(last_city AS INTEGER) AS last_city,
        CASE WHEN grown THEN '{NOW}' ELSE '2024-01-01T00:00:00' END AS updated_at FROM {BOTH_RANGES_SQL}""",
)
def city_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished_cities(spark, sf_dir)


@query(
    "P3_state_progress",
    f"""SELECT c.uf AS estado, CASE WHEN coalesce(last_city, -1) + 1 >= n_cities THEN -1
        ELSE (coalesce(last_city, -1) + 1) * 1000 + 1 END AS last_page
    FROM (SELECT uf, count(*) AS n_cities FROM {CITIES_SQL} GROUP BY uf) c
    LEFT JOIN {BOTH_RANGES_SQL} r ON c.uf = r.uf AND first_city = 0""",
)
def progress_of_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = cities(spark, sf_dir).groupBy("uf").agg(F.count("*").alias("n_cities"))
    return progress.state_progress(finished_cities(spark, sf_dir), totals)


@query(
    "F4_resume_cities",
    f"""SELECT uf, city, CAST(city_idx AS INTEGER) AS city_idx FROM {CITIES_SQL} c
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {FIRST_RUN_SQL} UNION SELECT * FROM {SECOND_RUN_SQL}) d
        WHERE d.uf = c.uf AND d.city_idx = c.city_idx)""",
)
def resume_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities that neither run has finished, wherever in the state they are."""
    return worklist.resume_cities(cities(spark, sf_dir), finished_cities(spark, sf_dir))


@query(
    "F4_one_city",
    f"""SELECT {uf_sql("3")} AS uf, coalesce(city, asked) AS city, CAST(city_idx AS INTEGER) AS city_idx, asked
    FROM (VALUES ('cidade 7'), ('nenhuma')) wanted(asked)
    LEFT JOIN (SELECT * FROM {CITIES_SQL} WHERE uf = {uf_sql("3")}) ON lower(city) = asked""",
)
def one_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs for one city each, in small letters; one of the cities is never in the list."""
    listed, uf = cities(spark, sf_dir), STATES[3][0].lower()
    runs = [worklist.select_city(listed, uf, name).withColumn("asked", F.lit(name)) for name in ("cidade 7", "nenhuma")]
    return runs[0].unionByName(runs[1])


@query(
    "P4_generic_progress",
    """SELECT user_id, CASE WHEN last > user_id * 100 THEN -1 ELSE last END AS last_page FROM (
        SELECT user_id, coalesce(max(event_id) FILTER (event_type NOT IN ('error', 'view')) + 1, 1) AS last
        FROM events GROUP BY user_id)""",
)
def generic_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("page"), F.col("event_type").isin("error", "view").alias("empty")
    )
    return progress.generic_progress(pages, ["user_id"], F.col("user_id") * 100)


@query(
    "P5_reset_progress",
    f"""SELECT code AS estado, CAST(1 AS BIGINT) AS last_page, '{NOW}' AS updated_at FROM {STATES_SQL}
    UNION ALL SELECT 'old-' || o_custkey, max(o_orderkey), '2024-01-01T00:00:00' FROM orders GROUP BY o_custkey""",
)
def reset_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reset over stored progress; rows of other keys stay as they are."""
    stored = stored_progress(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    others = orders.groupBy(F.concat(F.lit("old-"), "o_custkey").alias("estado")).agg(
        F.max("o_orderkey").alias("last_page"), F.lit("2024-01-01T00:00:00").alias("updated_at")
    )
    fresh = progress.reset_progress(spark, NOW)
    return progress.save_progress(stored.unionByName(others), fresh.drop("updated_at"), NOW)
