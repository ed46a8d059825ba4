"""Registered queries: inputs derived from the test tables, and SQL to check them."""

from workload import listings, plans, texts  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
