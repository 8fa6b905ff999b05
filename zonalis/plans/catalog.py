"""All registered queries with their SQL counterparts."""

from zonalis.plans import catalog_aggregates, catalog_models, catalog_scalar, catalog_windows

PARTS = [catalog_scalar, catalog_aggregates, catalog_windows, catalog_models]


def queries() -> dict:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.ORACLE.items()}
