"""All registered queries."""

from corpusflow.catalog import (  # noqa: F401
    classify, code, files, graphs, joins, logs, ordering, rollups, state, trees,
)
from corpusflow.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
