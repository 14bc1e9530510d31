"""All registered queries and their SQL twins."""

from periodledger.plans import (
    audit_queries, catalog_queries, clean_queries, flatten_queries, io_queries, resolve_queries, time_queries)

_MODULES = [resolve_queries, time_queries, clean_queries, flatten_queries, catalog_queries, audit_queries, io_queries]

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
