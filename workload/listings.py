"""Listing payloads: sources, the projection of each field, sinks, upsert, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.operators.counts import (
    batch_metrics, count_listings, listings_per_state, outcome_totals, saved_totals,
)
from listingflow.operators.parse import OUTCOME, parse_listings, project_items
from listingflow.operators.upsert import latest, upsert_latest, write_order
from listingflow.plans.collect import (
    counted, current_listings, parse_pages, split_outcomes, walked_pages,
)
from listingflow.schema import LISTINGS
from listingflow.session import discard, new_dir, stored
from listingflow.sources.payloads import explode_listings, unreadable
from listingflow.sources.tables import (
    add_columns, conform_listings, evolve, only_portal, read_listings, stamp, write_listings,
)
from listingflow.sources.versions import read_version, update_listings
from listingflow.streaming.ingest import current, ingest_incremental, ingest_pages, read_log
from workload.fixtures import (
    AREA_SQL, BASE_URL, ID_SQL, K, NOW, PORTAL, PRICE_SQL, STATE_SQL, URL_SQL,
    js, num, obj, part_items, part_pages, uf_of, uf_sql,
)
from workload.registry import query, table


def parsed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return project_items(part_items(spark, sf_dir), BASE_URL).select("k", *columns)


FIELD_SQL: dict[str, str] = {}


def field_query(name: str, **columns: str) -> None:
    """Register the projection of some columns of every part's listing item."""
    FIELD_SQL.update(columns)
    listed = ", ".join(f"{sql} AS {column}" for column, sql in columns.items())

    @query(name, f"SELECT {K} AS k, {listed} FROM part")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parsed(spark, sf_dir, *columns)


def cases(n: int, *values: str) -> str:
    listed = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {K} % {n} {listed} END"


# --- L: item to row ----------------------------------------------------------

field_query("L1_url", url=URL_SQL)
field_query(
    "L2_plain_fields",
    titulo="p_name",
    descricao="p_type || ' \"' || p_brand || '\"' || chr(10)",
    status_anuncio=cases(3, "'ACTIVE'", "NULL", "NULL"),
    listing_id=ID_SQL,
)
field_query(
    "L3_type",
    tipo=cases(10, "'apartamento'", "'casa'", "'casa'", "'terreno'", "'cobertura'", "'flat'", "'comercial'",
               "'rural'", "'loft'", "NULL"),
)
field_query(
    "L4_sub_type",
    property_sub_type=cases(10, "'APARTMENT'", "'HOME'", "'CONDOMINIUM'", "'LAND'", "'Penthouse'", "'FLAT'",
                            "'COMMERCIAL'", "'FARM'", "'Loft'", "NULL"),
)
field_query("L5_purpose", finalidade=cases(5, "'venda'", "'venda'", "'aluguel'", "'venda_aluguel'", "'OTHER'"))
field_query("L6_contract", contract_type=cases(5, "NULL", "'SALE'", "'RENTAL'", "'SALE_RENTAL'", "'OTHER'"))
field_query("L7_price", preco=PRICE_SQL)
field_query(
    "L8_fees",
    preco_condominio=f"CAST({cases(4, 'p_size', 'p_size', 'NULL', 'NULL')} AS DOUBLE)",
    iptu=f"CAST({cases(4, 'NULL', 'NULL', '0', 'p_size * 1.5')} AS DOUBLE)",
)
field_query(
    "L9_areas",
    area_construida=AREA_SQL,
    area_terreno=f"CAST({cases(3, 'p_size * 2.5', 'NULL', 'NULL')} AS DOUBLE)",
)
field_query(
    "L10_price_per_m2",
    preco_por_m2=f"""CASE WHEN {PRICE_SQL} <> 0 AND {AREA_SQL} > 0
        THEN CAST(printf('%.2f', {PRICE_SQL} / {AREA_SQL}) AS DOUBLE) END""",
)
field_query(
    "L11_rooms",
    quartos=f"CAST({K} % 5 AS BIGINT)",
    suites=f"CAST({K} % 4 AS BIGINT)",
    banheiros=f"CAST({K} % 3 AS BIGINT)",
    vagas=f"CAST({cases(3, 'NULL', 'NULL', f'{K} % 9')} AS BIGINT)",
)
field_query(
    "L12_address",
    rua="'Rua ' || p_name",
    bairro=f"'Bairro ' || {K} % 40",
    cidade=f"'Cidade ' || {K} % 200",
    estado=STATE_SQL,
    cep=f"lpad(CAST({K} % 100000 AS VARCHAR), 8, '0')",
    zona=cases(3, "'Zona Sul'", "NULL", "NULL"),
)
field_query(
    "L13_point",
    latitude=f"CAST({cases(4, f'-({K} % 30)', '0', 'NULL', 'NULL')} AS DOUBLE)",
    longitude=f"CAST({cases(4, f'({K} % 60) * -0.5', f'({K} % 60) * -0.5', 'NULL', 'NULL')} AS DOUBLE)",
)
IMG = "'https://img.example/"
field_query(
    "L14_photos",
    fotos_urls=cases(4, "NULL", f"{IMG}a' || {K}", f"{IMG}a' || {K}",
                     f"{IMG}b' || {K} || '|https://img.example/a' || {K} || '|https://img.example/b' || {K}"),
)
field_query("L15_image_count", image_count=f"CAST({cases(4, '0', '1', '3', '3')} AS BIGINT)")
field_query(
    "L16_dates",
    data_publicacao=f"'2024-01-' || lpad(CAST({K} % 28 + 1 AS VARCHAR), 2, '0') || 'T10:00:00Z'",
    data_ultima_atualizacao=cases(2, "'2024-02-01T00:00:00Z'", "NULL"),
)
field_query(
    "L17_joined_lists",
    amenities=cases(4, "'POOL|' || p_brand", "NULL", "NULL", "NULL"),
    usage_types="'RESIDENTIAL'",
    stamps=cases(2, "'A|B|C'", "NULL"),
    garantias_aluguel=cases(3, "'GUARANTOR|' || p_brand", "NULL", "NULL"),
)
field_query(
    "L18_complex_amenities",
    complex_amenities=f"CASE WHEN {K} % 3 = 0 THEN 'GYM' WHEN {K} % 2 = 0 THEN 'GATE|PARK' END",
)
field_query(
    "L19_floors",
    andar=f"CAST({cases(2, f'{K} % 30', 'NULL')} AS BIGINT)",
    total_andares=f"CAST({cases(2, 'NULL', f'{K} % 20')} AS BIGINT)",
)
field_query("L20_exchange", aceita_permuta=cases(4, "'True'", "'False'", "NULL", "NULL"))
field_query(
    "L21_advertiser",
    anunciante_nome=f"""CASE WHEN {K} % 3 = 0 THEN 'Account ' || {K} % 5
        WHEN {K} % 2 = 0 THEN 'Advertiser ' || {K} % 5 ELSE 'Contact ' || {K} % 9 END""",
)
field_query("L22_phones", anunciante_telefone=cases(2, f"""'["000-1","000-' || {K} % 10 || '"]'""", "NULL"))
field_query("L23_iptu_period", periodo_iptu=cases(3, "'MONTHLY'", "'YEARLY'", "NULL"))
field_query(
    "L24_rent",
    aluguel_total=f"""CAST(CASE {K} % 6 WHEN 1 THEN p_size WHEN 2 THEN p_size * 10 WHEN 3 THEN p_size
        WHEN 0 THEN p_size END AS DOUBLE)""",
)


@query(
    "L25_raw_json",
    f"""SELECT {K} AS k, '{{"medias":[],"listing":{{"title":"' || p_name || ' ção","id":"P' || {K} || '"}}}}' AS raw_json
    FROM part""",
)
def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = obj(
        medias=F.lit("[]"),
        listing=obj(
            title=js(F.concat(F.col("p_name"), F.lit(" ção"))),
            id=js(F.concat(F.lit("P"), num(F.col("p_partkey")))),
        ),
    )
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), item.alias("item")
    )
    return project_items(items, BASE_URL).select("k", "raw_json")


BAD_SQL = f"""CASE WHEN {K} % 17 = 0 THEN 'reject:medias' WHEN {K} % 11 = 0 THEN 'fatal:address'
    WHEN {K} % 7 = 0 THEN 'reject:price' WHEN {K} % 13 = 0 THEN 'reject:bedrooms' END"""


@query("L26_rejects", f"SELECT {K} AS k, {BAD_SQL} AS outcome FROM part")
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejected = parse_listings(part_items(spark, sf_dir, bad=True), BASE_URL)
    kept = good.select("k", F.lit(None).cast("string").alias(OUTCOME))
    return kept.unionByName(rejected.select("k", OUTCOME))


@query(
    "L27_fatal_quarantine",
    f"SELECT {K} AS k, {URL_SQL} AS url, {PRICE_SQL} AS preco FROM part WHERE {BAD_SQL} IS NULL",
)
def fatal_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_listings(part_items(spark, sf_dir, bad=True), BASE_URL)
    return good.select("k", "url", "preco")


# Parts come 24 to a page and 4 pages to a walk.
@query(
    "L27_fatal_truncate",
    f"""WITH items AS (SELECT {K} AS k, {K} // 96 AS walk, {BAD_SQL} AS outcome FROM part),
    stops AS (SELECT walk, min(k) AS stop FROM items WHERE outcome LIKE 'fatal:%' GROUP BY walk)
    SELECT k // 96 AS city_idx, k % 96 // 24 + 1 AS page, k % 24 AS pos
    FROM items LEFT JOIN stops USING (walk)
    WHERE outcome IS NULL AND (stop IS NULL OR k < stop)""",
)
def fatal_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_pages(part_pages(spark, sf_dir, bad=True), BASE_URL, PORTAL, NOW, "truncate")
    return good.select(*(F.col(c).cast("bigint").alias(c) for c in ("city_idx", "page", "pos")))


# --- S: sources and sinks ----------------------------------------------------


@query(
    "S1_unreadable",
    f"""SELECT DISTINCT {K} // 24 AS n, CASE {K} // 24 % 5 WHEN 3 THEN 'missing' ELSE 'not JSON' END AS reason
    FROM part WHERE {K} // 24 % 5 IN (0, 2, 3)""",
)
def unreadable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which some are cut off, some hold text behind the JSON, and some are missing."""
    n = F.col("city_idx") * 4 + F.col("page") - 1
    pages = part_pages(spark, sf_dir).withColumn("n", n.cast("bigint"))
    whole = F.col("payload")
    spoilt = (
        F.when(F.col("n") % 5 == 0, F.expr("left(payload, length(payload) - 2)"))
        .when(F.col("n") % 5 == 2, F.concat(whole, F.lit(" x")))
        .when(F.col("n") % 5 != 3, whole)
    )
    return unreadable(pages.withColumn("payload", spoilt)).select("n", "reason")


@query(
    "S1_explode_listings",
    f"SELECT {K} // 24 AS n, {K} % 24 AS pos, {ID_SQL} AS id FROM part",
)
def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = explode_listings(part_pages(spark, sf_dir))
    n = F.col("city_idx") * 4 + F.col("page") - 1
    return items.select(
        n.cast("bigint").alias("n"),
        F.col("pos").cast("bigint").alias("pos"),
        F.get_json_object("item", "$.listing.id").alias("id"),
    )


@query(
    "S6_conform",
    f"""SELECT url, '{PORTAL}' AS portal, preco, area_construida, CAST(NULL AS VARCHAR) AS imovel_disponivel,
        CAST(49 AS BIGINT) AS n_columns
    FROM (SELECT {URL_SQL} AS url, {PRICE_SQL} AS preco, {AREA_SQL} AS area_construida FROM part)""",
)
def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_listings(part_items(spark, sf_dir), BASE_URL)
    listings = conform_listings(stamp(good, PORTAL, NOW))
    return listings.select(
        "url", "portal", "preco", "area_construida", "imovel_disponivel",
        F.lit(len(listings.columns)).cast("bigint").alias("n_columns"),
    )


SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}


def all_columns_sql() -> str:
    """All columns as the queries of single fields have them; those no payload fills are NULL."""
    known = FIELD_SQL | {"portal": f"'{PORTAL}'", "data_coleta": f"'{NOW}'"}
    known["raw_json"] = f"lpad(CAST({K} % 100000 AS VARCHAR), 8, '0')"
    return ", ".join(
        f"CAST({known.get(f.name, 'NULL')} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in LISTINGS.fields
    )


@query("S6_all_columns", f"SELECT {all_columns_sql()} FROM part")
def all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the table; for the item's text one value that is read from it."""
    good, _ = parse_listings(part_items(spark, sf_dir), BASE_URL)
    text = F.get_json_object("raw_json", "$.listing.address.zipCode")
    return conform_listings(stamp(good, PORTAL, NOW)).withColumn("raw_json", text)


@query(
    "S7_schema_growth",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS amenities,
        CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS preco_por_m2, CAST(NULL AS BIGINT) AS image_count
    FROM customer""",
)
def schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    old = customers.where("c_custkey % 2 = 0").select("c_custkey", "c_name")
    new = customers.where("c_custkey % 2 = 1").select(
        "c_custkey", "c_name", F.col("c_mktsegment").alias("amenities"), F.col("c_acctbal").alias("preco_por_m2")
    )
    return add_columns(evolve(old, new), {"amenities": "string", "image_count": "bigint"})


@query(
    "S8_partitioned_table",
    f"""SELECT estado, cidade, bairro, count(*) AS n, max(preco) AS max_price FROM (
        SELECT {STATE_SQL} AS estado, 'Cidade ' || {K} % 200 AS cidade, 'Bairro ' || {K} % 40 AS bairro,
        {PRICE_SQL} AS preco FROM part) WHERE estado IN ('SP', 'RJ') GROUP BY ALL""",
)
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_listings(part_items(spark, sf_dir), BASE_URL)
    path = new_dir(spark, "listings")
    parsed_once = stored(conform_listings(stamp(good, PORTAL, NOW)), "parsed")
    write_listings(parsed_once, path)
    discard(parsed_once)
    found = read_listings(spark, path).where(F.col("estado").isin("SP", "RJ"))
    return found.groupBy("estado", "cidade", "bairro").agg(
        F.count("*").alias("n"), F.max("preco").alias("max_price")
    )


@query(
    "S9_stamp",
    f"""SELECT event_id, '{PORTAL}' AS portal, '{NOW}' AS data_coleta,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
        ELSE strftime(ts, '.%f') END AS ts FROM events""",
)
def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(table(spark, sf_dir, "events").select("event_id", "ts"), PORTAL, NOW)


@query(
    "E1_custom_parse",
    f"""SELECT 'https://portal.example/s/' || s_suppkey AS url, s_acctbal AS preco, {uf_sql("s_nationkey")} AS estado,
        CAST(NULL AS VARCHAR) AS titulo FROM supplier""",
)
def custom_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another source joins in as a DataFrame -> DataFrame function."""

    def parse(suppliers: DataFrame) -> DataFrame:
        return suppliers.select(
            F.concat(F.lit("https://portal.example/s/"), "s_suppkey").alias("url"),
            F.col("s_acctbal").alias("preco"),
            uf_of(F.col("s_nationkey")).alias("estado"),
        )

    listings = table(spark, sf_dir, "supplier").transform(parse).transform(conform_listings)
    return listings.select("url", "preco", "estado", "titulo")


# --- U: upsert ---------------------------------------------------------------


def _event_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored versions (even ids, with `props`) and new ones (odd ids, without)."""
    events = table(spark, sf_dir, "events")
    order = [F.col("event_id")]
    stored = events.where("event_id % 2 = 0").select("user_id", "event_id", "value", "props")
    before = upsert_latest(None, stored, order, key="user_id", required=["user_id"])
    return before, events.where("event_id % 2 = 1").select("user_id", "event_id", "value")


UPSERT_SQL = """
    SELECT user_id, coalesce(new_id, old_id) AS event_id, coalesce(new_value, old_value) AS value, {props} AS props
    FROM (SELECT user_id,
        max(event_id) FILTER (event_id % 2 = 1) AS new_id, arg_max(value, event_id) FILTER (event_id % 2 = 1) AS new_value,
        max(event_id) FILTER (event_id % 2 = 0) AS old_id, arg_max(value, event_id) FILTER (event_id % 2 = 0) AS old_value,
        arg_max(props, event_id) FILTER (event_id % 2 = 0) AS old_props
    FROM events GROUP BY user_id)"""


@query("U1_upsert", UPSERT_SQL.format(props="CASE WHEN new_id IS NULL THEN old_props END"))
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, incoming = _event_versions(spark, sf_dir)
    return upsert_latest(before, incoming, [F.col("event_id")], key="user_id", required=["user_id"])


@query("U1_upsert_preserve", UPSERT_SQL.format(props="old_props"))
def upsert_preserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, incoming = _event_versions(spark, sf_dir)
    return upsert_latest(
        before, incoming, [F.col("event_id")], key="user_id", required=["user_id"], preserve=["props"]
    )


@query(
    "U1_versions",
    f"""WITH writes AS (SELECT {URL_SQL} AS url, {PRICE_SQL} AS preco, {STATE_SQL} AS estado, {K} AS k,
        CASE WHEN {K} % 2 = 0 THEN 0 ELSE 1 END AS run FROM part WHERE {K} % 2 = 0 OR {K} % 5 = 1)
    SELECT url, preco, estado FROM writes QUALIFY row_number() OVER (PARTITION BY url ORDER BY run DESC, k DESC) = 1""",
)
def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; the second replaces listings of a few states and rewrites only those."""
    root = new_dir(spark, "versions")
    for condition in ("k % 2 = 0", "k % 2 = 1 AND k % 5 = 1"):
        good, _ = parse_listings(part_items(spark, sf_dir).where(condition), BASE_URL)
        update_listings(spark, root, stamp(good, PORTAL, NOW), [F.col("k")])
    return read_version(spark, root).select("url", "preco", "estado")


@query(
    "U2_write_order",
    """WITH writes AS (SELECT CAST(l_orderkey % 5000 AS VARCHAR) AS url, l_suppkey % 7 AS city_idx,
        ['SP', 'AC', 'RJ', 'MG', 'RR', 'DF'][1 + l_partkey % 6] AS uf,
        CASE WHEN l_linestatus = 'O' THEN '' ELSE 'N' || l_partkey % 5 END AS neighbourhood,
        CASE WHEN l_returnflag = 'A' THEN 'DEVELOPMENT' ELSE 'USED' END AS listing_type,
        l_suppkey AS page, l_partkey AS pos FROM lineitem)
    SELECT DISTINCT url, uf, neighbourhood, listing_type, pos FROM writes
    QUALIFY rank() OVER (PARTITION BY url ORDER BY
        list_position(['SP', 'RJ', 'MG', 'DF', 'AC', 'RR'], uf) DESC, city_idx DESC, neighbourhood = '' DESC,
        neighbourhood DESC, listing_type = 'DEVELOPMENT' DESC, page DESC, pos DESC) = 1""",
)
def written_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    passes = F.col("l_linestatus") == "O"
    writes = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 5000).cast("string").alias("url"),
        F.lit(0).alias("run"),
        F.element_at(F.array(*map(F.lit, ["SP", "AC", "RJ", "MG", "RR", "DF"])), (F.col("l_partkey") % 6 + 1).cast("int")).alias("uf"),
        (F.col("l_suppkey") % 7).alias("city_idx"),
        F.when(passes, "").otherwise(F.concat(F.lit("N"), F.col("l_partkey") % 5)).alias("neighbourhood"),
        F.when(~passes, F.col("l_partkey") % 5).alias("neighbourhood_pos"),
        F.when(F.col("l_returnflag") == "A", "DEVELOPMENT").otherwise("USED").alias("listing_type"),
        F.col("l_suppkey").alias("page"),
        F.col("l_partkey").alias("pos"),
    )
    return latest(writes, "url", write_order()).select("url", "uf", "neighbourhood", "listing_type", "pos")


@query(
    "D3_union_of_passes",
    """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
        arg_max(value, event_id) AS value FROM events GROUP BY user_id""",
)
def union_of_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    used = events.where("event_type IN ('view', 'click')")
    developments = events.where("event_type IN ('signup', 'purchase')")
    fallback = events.where("event_type NOT IN ('view', 'click', 'signup', 'purchase')")
    passes = used.unionByName(developments).unionByName(fallback)
    return latest(passes, "user_id", [F.col("event_id")])


# --- G, F3: counts -----------------------------------------------------------


@query(
    "G1_count_listings",
    """SELECT 'all' AS portal, count(*) AS n FROM events
    UNION ALL SELECT 'click', count(*) FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'absent', count(*) FROM events WHERE event_type = 'absent'""",
)
def listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = table(spark, sf_dir, "events").withColumnRenamed("event_type", "portal")
    counts = count_listings(listings).select(F.lit("all").alias("portal"), "n")
    for portal in ("click", "absent"):
        counts = counts.unionByName(
            count_listings(listings, portal).select(F.lit(portal).alias("portal"), "n")
        )
    return counts


@query("F3_only_portal", "SELECT event_id, event_type AS portal FROM events WHERE event_type = 'purchase'")
def portal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("portal"))
    return only_portal(listings, "purchase")


@query(
    "G2_saved_totals",
    f"""SELECT uf, city, count(*) AS saved, grouping(uf) * 2 + grouping(city) AS level FROM (
        SELECT {uf_sql("c_nationkey")} AS uf, 'Cidade ' || c_custkey % 20 AS city
        FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY ROLLUP (uf, city)""",
)
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        uf_of(F.col("c_nationkey")).alias("uf"),
        F.concat(F.lit("Cidade "), F.col("c_custkey") % 20).alias("city"),
    )
    return saved_totals(table(spark, sf_dir, "orders").join(customers, "o_custkey"))


@query(
    "G3_batch_metrics",
    """SELECT count(*) AS offered, count(*) FILTER (l_linenumber <> 7 AND l_returnflag <> 'R') AS saved,
        count(*) FILTER (l_linenumber = 7 OR l_returnflag = 'R') AS refused FROM lineitem""",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey").cast("string")).alias("url"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("portal"),
    )
    return batch_metrics(batch)


# --- end to end --------------------------------------------------------------

# Rows with one address are written state by state, in the order that a run walks
# the states, and within a state in the order of their parts. Four pages make a walk.
PER_STATE_SQL = f"""
    WITH items AS (SELECT {K} AS k, {URL_SQL} AS url, {STATE_SQL} AS estado, {PRICE_SQL} AS preco FROM part),
    current_rows AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY url ORDER BY
        list_position(['SP', 'RJ', 'MG', 'PR', 'RS', 'SC', 'BA', 'PE', 'CE', 'DF', 'GO', 'PA', 'AM', 'MA', 'ES', 'MT',
        'MS', 'PB', 'RN', 'AL', 'PI', 'SE', 'TO', 'RO', 'AC', 'AP', 'RR'], {uf_sql("k // 96")}) DESC, k DESC) = 1)
    SELECT estado, count(*) AS n_listings,
        count(preco) AS n_priced,
        CAST(sum(CAST(preco AS DECIMAL(28, 6))) AS DOUBLE) / count(preco) AS mean_price
    FROM current_rows GROUP BY estado"""


@query("listings_per_state", PER_STATE_SQL)
def per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages -> items -> rows -> last version per address -> per state."""
    good, _ = parse_pages(part_pages(spark, sf_dir), BASE_URL, PORTAL, NOW)
    return listings_per_state(current_listings(None, good))


@query(
    "W1_walked_pages",
    """WITH pages AS (SELECT event_id // 420 AS walk, event_id % 420 + 1 AS page, event_type FROM events),
    runs AS (SELECT *, sum(CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END)
        OVER (PARTITION BY walk ORDER BY page ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS empties FROM pages),
    stops AS (SELECT walk, min(page) AS stop FROM runs WHERE empties = 2 OR (event_type = 'purchase' AND page % 5 = 0)
        GROUP BY walk)
    SELECT walk, page, event_type AS listing_type FROM pages LEFT JOIN stops USING (walk)
    WHERE event_type NOT IN ('error', 'signup') AND (stop IS NULL OR page < stop)""",
)
def walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload pages, some without listings and some that failed, cut at their stop."""
    page = F.col("event_id") % 420 + 1
    failed = (F.col("event_type") == "purchase") & (page % 5 == 0)
    body = (
        F.when(F.col("event_type") == "error", F.lit('{"search":{"result":{"listings":[]}}}'))
        .when(F.col("event_type") == "signup", F.lit('{"search":{}}'))
        .when(failed & (page % 2 == 0), F.lit('{"search":null}'))
        .otherwise(F.lit('{"search":{"result":{"listings":[{}]}}}'))
    )
    pages = table(spark, sf_dir, "events").select(
        F.lit(0).alias("run"),
        F.lit("SP").alias("uf"),
        F.lit("Cidade").alias("city"),
        F.floor(F.col("event_id") / 420).alias("neighbourhood"),
        F.lit("USED").alias("listing_type"),
        "event_type",
        page.alias("page"),
        F.when(failed & (page % 2 == 1), 500).otherwise(200).alias("status"),
        body.alias("payload"),
    )
    return walked_pages(pages).select(
        F.col("neighbourhood").alias("walk"), "page", F.col("event_type").alias("listing_type")
    )


@query(
    "T1_incremental_ingest",
    """SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value,
        (SELECT count(*) FROM events) AS logged FROM events GROUP BY user_id""",
)
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the table as a stream of files; the second run finds nothing new."""
    log, checkpoint = new_dir(spark, "log"), new_dir(spark, "stream")

    def parse(batch: DataFrame) -> DataFrame:
        return batch.select("user_id", "event_id", "value")

    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    for _ in range(2):
        ingest_incremental(spark, sf_dir, log, checkpoint, parse, schema, file_glob="events.parquet")
    rows = read_log(spark, log)
    newest = current(None, rows, key="user_id", order=[F.col("event_id")], required=["user_id"])
    return newest.select("user_id", "event_id", "value", F.lit(rows.count()).cast("bigint").alias("logged"))


# Pages of twelve to a walk, of which some are empty, cut off, followed by other text,
# or failed; which they are follows from their number.
SPOILT_SQL = f"""
    items AS (SELECT {K} AS k, {K} // 24 AS n, {BAD_SQL} AS bad FROM part),
    pages AS (SELECT DISTINCT n, n // 12 AS walk, n % 12 + 1 AS page, CASE
        WHEN n // 12 % 4 = 0 AND n % 12 IN (6, 7) THEN 'page:empty'
        WHEN n // 12 % 4 = 1 AND n % 12 IN (2, 5) THEN 'page:empty'
        WHEN n // 12 % 4 = 1 AND n % 12 = 9 THEN 'page:not JSON'
        WHEN n // 12 % 4 = 2 AND n % 12 = 4 THEN 'page:not JSON'
        WHEN n // 12 % 4 = 2 AND n % 12 = 8 THEN 'page:shape'
        WHEN n // 12 % 4 = 3 AND n % 12 = 10 THEN 'page:status'
        WHEN n // 12 % 4 = 3 AND n % 12 = 11 THEN 'page:missing' END AS lost FROM items),
    marked AS (SELECT *, lost IS NOT NULL AND lag(lost) OVER (PARTITION BY walk ORDER BY page) = 'page:empty'
        OR lost <> 'page:empty' AS stops FROM pages),
    ends AS (SELECT walk, min(page) AS stop FROM marked WHERE stops GROUP BY walk),
    walked AS (SELECT * FROM pages LEFT JOIN ends USING (walk) WHERE stop IS NULL OR page <= stop)"""


def spoilt_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("city_idx") * 4 + F.col("page") - 1
    walk, at = F.floor(F.col("n") / 12), F.col("n") % 12
    kind = (
        F.when((walk % 4 == 0) & at.isin(6, 7), "empty")
        .when((walk % 4 == 1) & at.isin(2, 5), "empty")
        .when((walk % 4 == 1) & (at == 9), "cut")
        .when((walk % 4 == 2) & (at == 4), "behind")
        .when((walk % 4 == 2) & (at == 8), "shape")
        .when((walk % 4 == 3) & (at == 10), "status")
        .when((walk % 4 == 3) & (at == 11), "missing")
    )
    payload = (
        F.when(kind == "empty", '{"search":{"result":{"listings":[]}}}')
        .when(kind == "cut", F.expr("left(payload, length(payload) - 2)"))
        .when(kind == "behind", F.concat("payload", F.lit(',"end"')))
        .when(kind == "shape", '{"search":null}')
        .when(F.coalesce(kind, F.lit("")) != "missing", F.col("payload"))
    )
    pages = part_pages(spark, sf_dir, bad=True).withColumn("n", n.cast("bigint"))
    return pages.select(
        "run", "uf", F.concat(F.lit("Cidade "), walk).alias("city"), walk.cast("int").alias("city_idx"),
        "neighbourhood", "neighbourhood_pos", "listing_type", (at + 1).cast("int").alias("page"),
        F.when(kind == "status", 503).otherwise(200).alias("status"), payload.alias("payload"), "n",
    ).withColumn("uf", F.lit("SP"))


def in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the spoilt pages, landed as files that cut walks, two files to a batch;
    a second run finds nothing new."""
    source, log, checkpoint = (new_dir(spark, name) for name in ("landed", "log", "stream"))
    spoilt_pages(spark, sf_dir).repartition(6, "n").drop("n").write.parquet(source)
    for _ in range(2):
        ingest_pages(spark, source, log, checkpoint, BASE_URL, PORTAL, NOW, max_files=2)
    return read_log(spark, log)


WALKED_ITEMS_SQL = """walked_items AS (SELECT items.* FROM items JOIN walked USING (n)
        WHERE lost IS NULL AND (stop IS NULL OR page < stop))"""


@query(
    "T1_outcomes_in_batches",
    f"""WITH {SPOILT_SQL}, {WALKED_ITEMS_SQL}
    SELECT n, k % 24 AS pos, bad AS outcome FROM walked_items
    UNION ALL SELECT n, -1 AS pos, lost AS outcome FROM walked WHERE lost IS NOT NULL""",
)
def outcomes_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and pages without items, up to the stop of their walks across all batches."""
    rows = counted(in_batches(spark, sf_dir))
    n = F.col("city_idx") * 12 + F.col("page") - 1
    return rows.select(
        n.cast("bigint").alias("n"), F.coalesce("pos", F.lit(-1)).cast("bigint").alias("pos"), OUTCOME
    )


@query(
    "T1_listings_in_batches",
    f"""WITH {SPOILT_SQL}, {WALKED_ITEMS_SQL}
    SELECT url, preco, estado FROM (SELECT n, k, {URL_SQL.replace(K, "k")} AS url, bad FROM walked_items)
    JOIN (SELECT {K} AS k, {PRICE_SQL} AS preco, {STATE_SQL} AS estado FROM part) USING (k)
    WHERE bad IS NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY k DESC) = 1""",
)
def listings_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current table of walks that came in several batches."""
    good, _ = split_outcomes(counted(in_batches(spark, sf_dir)))
    return current_listings(None, good).select("url", "preco", "estado")


@query(
    "T1_input_is_whole",
    f"""WITH {SPOILT_SQL}
    SELECT part, count(*) AS n FROM (
        SELECT CASE WHEN bad IS NULL THEN 'good' ELSE 'rejected' END AS part
        FROM items JOIN pages USING (n) WHERE lost IS NULL
        UNION ALL SELECT 'page' FROM pages WHERE lost IS NOT NULL) GROUP BY part""",
)
def input_is_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log holds in each of its parts: together they are the input."""
    return in_batches(spark, sf_dir).groupBy("part").agg(F.count("*").alias("n"))


@query(
    "G2_outcome_totals",
    f"""WITH {SPOILT_SQL}, {WALKED_ITEMS_SQL},
    found AS (SELECT n, CASE WHEN bad IS NULL THEN 'saved' ELSE 'refused' END AS what FROM walked_items
        UNION ALL SELECT n, CASE lost WHEN 'page:empty' THEN 'empty' ELSE 'failed' END FROM walked WHERE lost IS NOT NULL)
    SELECT run, uf, city, saved, refused, failed_pages, empty_pages, level, refused + failed_pages AS errors FROM (
        SELECT run, uf, city, count(*) FILTER (what = 'saved') AS saved, count(*) FILTER (what = 'refused') AS refused,
            count(*) FILTER (what = 'failed') AS failed_pages, count(*) FILTER (what = 'empty') AS empty_pages,
            CAST(grouping(run) * 4 + grouping(uf) * 2 + grouping(city) AS BIGINT) AS level
        FROM (SELECT CAST(0 AS BIGINT) AS run, 'SP' AS uf, 'Cidade ' || n // 12 AS city, what FROM found)
        GROUP BY ROLLUP (run, uf, city))""",
)
def totals_of_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved, refused and failed, by city, state, run and in all, from one run log."""
    return outcome_totals(counted(in_batches(spark, sf_dir)))


@query(
    "S1_pages_in_the_walk",
    f"""WITH {SPOILT_SQL}
    SELECT walk AS city_idx, page, lost AS outcome FROM walked WHERE lost <> 'page:empty'""",
)
def pages_in_the_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that cannot be read come out rejected, with their walk and reason, and end it."""
    _, rejected = parse_pages(spoilt_pages(spark, sf_dir).drop("n"), BASE_URL, PORTAL, NOW)
    return rejected.where("pos IS NULL").select(
        F.col("city_idx").cast("bigint").alias("city_idx"), F.col("page").cast("bigint").alias("page"), OUTCOME
    )


