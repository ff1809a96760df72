"""Registered queries: each reads the given tables and, where SQL can say it, carries the
same query as DuckDB text for checking."""

from hirelake.catalog import boards, fields, frontier, integration, links, normalise, streams, surface  # noqa: F401
from hirelake.catalog.registry import ORACLES, QUERIES  # noqa: F401
