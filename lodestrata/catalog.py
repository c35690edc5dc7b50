"""All queries of the library, by operator."""

from __future__ import annotations

from .plans import aggregates, functions, governance, ingestion, joins, metrics, modelling, objects, quality, sources, tables
from .plans.registry import QUERIES, SQL

MODULES = (sources, objects, joins, aggregates, metrics, functions, tables, ingestion, modelling, quality, governance)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
