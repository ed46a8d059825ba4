"""Column order and types of the listings table."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and order of the listings table. The
# storage-only surrogate id is left out; `url` identifies a listing.
LISTING_COLUMNS = """
    portal string, url string,
    preco double, area_construida double, area_terreno double,
    quartos bigint, banheiros bigint, vagas bigint, tipo string,
    rua string, bairro string, cidade string, estado string,
    data_publicacao string, data_ultima_atualizacao string,
    descricao string, fotos_urls string,
    preco_condominio double, iptu double, latitude double, longitude double,
    finalidade string, titulo string, suites bigint, cep string,
    data_coleta string, data_atualizacao_scraper string,
    amenities string, complex_amenities string, preco_por_m2 double,
    image_count bigint, raw_json string, usage_types string,
    property_sub_type string, andar bigint, total_andares bigint,
    aceita_permuta string, status_anuncio string,
    anunciante_nome string, anunciante_telefone string,
    listing_id string, stamps string, contract_type string, zona string,
    periodo_iptu string, garantias_aluguel string, aluguel_total double,
    imovel_disponivel string, imovel_atualizado string
"""


def _to_struct(columns: str) -> T.StructType:
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


LISTINGS = _to_struct(LISTING_COLUMNS)

PROGRESS = T.StructType(
    [
        T.StructField("estado", T.StringType()),
        T.StructField("last_page", T.LongType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

# Finished cities of a state, as ranges of their numbers, both ends included.
CITY_PROGRESS = T.StructType(
    [
        T.StructField("estado", T.StringType()),
        T.StructField("first_city", T.IntegerType()),
        T.StructField("last_city", T.IntegerType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

# Columns only later jobs fill; see `upsert_latest(preserve=...)`.
CONTROL_COLUMNS = ["imovel_disponivel", "imovel_atualizado"]
