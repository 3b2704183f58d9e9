"""Registered queries over the given tables, and the SQL that checks them."""

from footfall.catalog.oracle import ORACLE_SQL
from footfall.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
