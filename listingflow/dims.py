"""Fixed reference data: the 27 Brazilian states and the small lookup lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (state code, state name, capital, statistics-office code).
STATES = [
    ("RO", "Rondônia", "Porto Velho", 11),
    ("AC", "Acre", "Rio Branco", 12),
    ("AM", "Amazonas", "Manaus", 13),
    ("RR", "Roraima", "Boa Vista", 14),
    ("PA", "Pará", "Belém", 15),
    ("AP", "Amapá", "Macapá", 16),
    ("TO", "Tocantins", "Palmas", 17),
    ("MA", "Maranhão", "São Luís", 21),
    ("PI", "Piauí", "Teresina", 22),
    ("CE", "Ceará", "Fortaleza", 23),
    ("RN", "Rio Grande do Norte", "Natal", 24),
    ("PB", "Paraíba", "João Pessoa", 25),
    ("PE", "Pernambuco", "Recife", 26),
    ("AL", "Alagoas", "Maceió", 27),
    ("SE", "Sergipe", "Aracaju", 28),
    ("BA", "Bahia", "Salvador", 29),
    ("MG", "Minas Gerais", "Belo Horizonte", 31),
    ("ES", "Espírito Santo", "Vitória", 32),
    ("RJ", "Rio de Janeiro", "Rio de Janeiro", 33),
    ("SP", "São Paulo", "São Paulo", 35),
    ("PR", "Paraná", "Curitiba", 41),
    ("SC", "Santa Catarina", "Florianópolis", 42),
    ("RS", "Rio Grande do Sul", "Porto Alegre", 43),
    ("MS", "Mato Grosso do Sul", "Campo Grande", 50),
    ("MT", "Mato Grosso", "Cuiabá", 51),
    ("GO", "Goiás", "Goiânia", 52),
    ("DF", "Distrito Federal", "Brasília", 53),
]

# The states in the order a run walks them.
STATE_WALK = [
    "SP", "RJ", "MG", "PR", "RS", "SC", "BA", "PE", "CE", "DF", "GO", "PA", "AM", "MA", "ES", "MT", "MS", "PB", "RN", "AL",
    "PI", "SE", "TO", "RO", "AC", "AP", "RR",
]

# Unit type of the payload -> listing type of the table.
UNIT_TYPES = {
    "APARTMENT": "apartamento",
    "HOME": "casa",
    "CONDOMINIUM": "casa",
    "LAND": "terreno",
    "PENTHOUSE": "cobertura",
    "FLAT": "flat",
    "COMMERCIAL": "comercial",
    "FARM": "rural",
}

# The listing types one neighbourhood is walked for, in walk order.
LISTING_TYPES = ["USED", "DEVELOPMENT"]

# Name fragments that neighbourhood discovery asks for per city.
DISCOVERY_TERMS = [chr(c) for c in range(ord("A"), ord("Z") + 1)] + [
    "Vila", "Jardim", "Parque", "Centro", "Santa", "São",
    "Bela", "Nova", "Alto", "Barra", "Campo", "Cidade",
]

# Listings per page, and pages per (neighbourhood, listing type).
PAGE_SIZE = 24
MAX_PAGES = 420

# Fixed value: width of one city in the packed per-state progress number.
CITY_STRIDE = 1000


def states(spark: SparkSession) -> DataFrame:
    """The 27 states as a table; small enough by definition to broadcast."""
    return spark.createDataFrame(STATES, "uf string, name string, capital string, code int")
